"""Code lists, geography, countries, codebook and transfer of older metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import codebook as cb
from ..operators import codelists as cl
from ..operators import countries, geography, legacy
from ..operators.geography import MergedVersion
from .inputs import oracle
from .registry import query

# ---------------------------------------------------------------- code lists

_LISTS = ["a", "b", "c", "d"]
_MEMBERS = "\nUNION ALL ".join(f"SELECT valuen, value, 'cl_{c}' AS codelist, {c} AS member FROM skeleton" for c in _LISTS)
_PAIRS = "\nUNION ALL ".join(
    f"SELECT 'cl_{a}' AS codelist, 'cl_{b}' AS target FROM skeleton HAVING BOOL_AND({a} OR NOT {b})" for a in _LISTS for b in _LISTS if a != b)


@query("skeleton_orphans", oracle("""
SELECT 'type' AS source, p_brand AS value FROM part WHERE p_brand NOT IN (SELECT value FROM code_values)
UNION ALL SELECT 'name', p_name FROM part WHERE p_name NOT IN (SELECT value FROM code_values)"""))
def orphans(x):
    used = x.sql("SELECT 'type' AS source, p_brand AS value FROM part UNION ALL SELECT 'name', p_name FROM part")
    return cl.skeleton_orphans(used, x.view("code_values"))


@query("membership_long", oracle(f"SELECT valuen, value, codelist, CAST(member AS INT) AS member FROM ({_MEMBERS}) m"))
def members(x):
    return cl.membership_long(x.view("skeleton")).withColumn("member", F.col("member").cast("int"))


@query("codelist_containment", oracle(f"""
WITH m AS ({_MEMBERS}), p AS ({_PAIRS})
SELECT p.codelist, m.value, p.target, m.value AS target_value FROM p JOIN m ON m.codelist = p.target WHERE m.member"""))
def containment(x):
    return cl.containment_maps(x.view("skeleton"))


@query("codelist_assembly", oracle(f"""
SELECT m.codelist, m.value, valuen, label_nl, label_fr FROM ({_MEMBERS}) m LEFT JOIN code_values v ON v.value = m.value WHERE member"""))
def assembly(x):
    return cl.assemble_codelists(x.view("skeleton"), x.view("code_values"))


@query("codelist_wide", oracle(f"""
WITH m AS ({_MEMBERS}), p AS ({_PAIRS})
SELECT s.value, s.valuen, label_nl, CASE WHEN c THEN s.value END AS cl_c, CASE WHEN d THEN s.value END AS cl_d
FROM skeleton s LEFT JOIN code_values v ON v.value = s.value WHERE a AND (SELECT COUNT(*) FROM p WHERE codelist = 'cl_a') >= 0"""))
def wide(x):
    skeleton = x.view("skeleton")
    maps = cl.containment_maps(skeleton)
    out = cl.codelist_wide(cl.assemble_codelists(skeleton, x.view("code_values")), maps, "cl_a")
    for c in ("cl_c", "cl_d"):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out.select("value", "valuen", "label_nl", "cl_c", "cl_d")


# ---------------------------------------------------------------- geography

@query("hierarchy_flatten", oracle("""
WITH a AS (SELECT level, id, MAX(CASE WHEN level = 0 THEN id END) OVER (PARTITION BY pos // 1000000000000000) AS l0,
  CASE WHEN level > 0 THEN MAX(CASE WHEN level = 1 THEN id END) OVER (PARTITION BY pos // 1000000000000) END AS l1 FROM hierarchy)
SELECT level, id, l0 AS geolvl0, l1 AS geolvl1, CASE WHEN level = 2 THEN id END AS geolvl2,
  CASE WHEN level = 2 THEN l1 WHEN level = 1 THEN l0 END AS parent_id FROM a"""))
def flatten(x):
    return geography.hierarchy_flatten(x.view("hierarchy"), "geo", range(3)).drop("pos")


# three versions of a hierarchy of region (0), nation (1) and customer (2), numbered as the finest but one level
_FLAT = """SELECT CONCAT('{v}r', CAST(r_regionkey AS VARCHAR(4))) AS id, 0 AS level, CAST(NULL AS VARCHAR(30)) AS parent_id, r_name AS label_nl, r_name AS label_fr,
  CONCAT('{v}r', CAST(r_regionkey AS VARCHAR(4))) AS {v}lvl0, CAST(NULL AS VARCHAR(30)) AS {v}lvl1, CAST(NULL AS VARCHAR(30)) AS {v}lvl2, CAST(NULL AS VARCHAR(30)) AS {v}lvl3, CAST(NULL AS VARCHAR(30)) AS {v}lvl4 FROM region
UNION ALL SELECT CONCAT('{v}n', CAST(n_nationkey AS VARCHAR(4))), 1, CONCAT('{v}r', CAST(n_regionkey AS VARCHAR(4))), n_name, n_name,
  CONCAT('{v}r', CAST(n_regionkey AS VARCHAR(4))), CONCAT('{v}n', CAST(n_nationkey AS VARCHAR(4))), NULL, NULL, NULL FROM nation
UNION ALL SELECT LPAD(CAST(c_custkey AS VARCHAR(12)), 12, '0'), 4, CONCAT('{v}n', CAST(n AS VARCHAR(4))), c_name, c_name,
  CONCAT('{v}r', CAST(n_regionkey AS VARCHAR(4))), CONCAT('{v}n', CAST(n AS VARCHAR(4))), NULL, NULL, LPAD(CAST(c_custkey AS VARCHAR(12)), 12, '0')
FROM (SELECT customer.*, CASE WHEN c_custkey % 97 = {m} THEN (c_nationkey + 5) % 25 ELSE c_nationkey END AS n FROM customer) c JOIN nation ON n = n_nationkey WHERE c_nationkey <> {gone} OR c_custkey % 2 = 0"""
_OLD, _NEW = _FLAT.format(v="x", m=200, gone=99), _FLAT.format(v="y", m=5, gone=3)
# municipalities of nation 3 with an odd number merge into their even neighbour
_RECODES = """SELECT LPAD(CAST(c_custkey AS VARCHAR(12)), 12, '0') AS xlvl4, LPAD(CAST(c_custkey - 1 AS VARCHAR(12)), 12, '0') AS ylvl4
FROM customer WHERE c_nationkey = 3 AND c_custkey % 2 = 1"""
_SUCC = f"""SELECT o.id, o.xlvl0, o.xlvl1, o.xlvl4, COALESCE(r.ylvl4, o.id) AS ylvl4, n.ylvl0, n.ylvl1
FROM ({_OLD}) o LEFT JOIN ({_RECODES}) r ON r.xlvl4 = o.id LEFT JOIN ({_NEW}) n ON n.level = 4 AND n.ylvl4 = COALESCE(r.ylvl4, o.id) WHERE o.level = 4"""


@query("merger_recodes", """
SELECT REGEXP_EXTRACT(part, '[0-9]{5}') AS old, LPAD(CAST(c_custkey AS VARCHAR), 5, '0') AS new
FROM (SELECT c_custkey, UNNEST(STRING_SPLIT(CONCAT('A (', LPAD(CAST(c_custkey AS VARCHAR), 5, '0'), ')+B (', LPAD(CAST(c_custkey + 1 AS VARCHAR), 5, '0'), ')'), '+')) AS part
      FROM customer) t""")
def recodes(x):
    df = x.sql("""SELECT CONCAT('A (', LPAD(CAST(c_custkey AS VARCHAR(12)), 5, '0'), ')+B (', LPAD(CAST(c_custkey + 1 AS VARCHAR(12)), 5, '0'), ')') AS merging,
        CONCAT('C ', LPAD(CAST(c_custkey AS VARCHAR(12)), 5, '0')) AS result FROM customer""")
    return geography.merger_recodes(df, "merging", "result", "old", "new")


def _successors(x):
    return geography.successor_map(x.sql(_OLD), x.sql(_RECODES), x.sql(_NEW), "x", "y")


@query("successor_map", f"SELECT id, xlvl0, xlvl1, xlvl4, ylvl0, ylvl1, ylvl4, ylvl4 AS y FROM ({_SUCC}) s")
def successors(x):
    return _successors(x).select("id", "xlvl0", "xlvl1", "xlvl4", "ylvl0", "ylvl1", "ylvl4", "y")


@query("set_equality_crosswalk", oracle("""
WITH l AS (SELECT 0 AS level, 'old' AS side, v1lvl0 AS area, id FROM area_members UNION ALL SELECT 1, 'old', v1lvl1, id FROM area_members
  UNION ALL SELECT 0, 'new', v2lvl0, id FROM area_members UNION ALL SELECT 1, 'new', v2lvl1, id FROM area_members),
g AS (SELECT level, side, area, STRING_AGG(CAST(id AS VARCHAR), ';' ORDER BY id) AS ids FROM l WHERE area IS NOT NULL GROUP BY level, side, area)
SELECT o.level, o.area AS old, n.area AS new FROM g o LEFT JOIN g n ON n.side = 'new' AND n.level = o.level AND n.ids = o.ids WHERE o.side = 'old'"""))
def crosswalk(x):
    return geography.set_equality_crosswalk(x.view("area_members"), [0, 1], "v1", "v2")


_CROSS = f"""s AS ({_SUCC}), l AS (SELECT 0 AS level, 'o' AS side, xlvl0 AS area, id FROM s UNION ALL SELECT 1, 'o', xlvl1, id FROM s
  UNION ALL SELECT 0, 'n', ylvl0, id FROM s UNION ALL SELECT 1, 'n', ylvl1, id FROM s),
g AS (SELECT level, side, area, STRING_AGG(id, ';' ORDER BY id) AS ids FROM l WHERE area IS NOT NULL GROUP BY level, side, area),
x AS (SELECT o.area AS old, n.area AS new FROM g o LEFT JOIN g n ON n.side = 'n' AND n.level = o.level AND n.ids = o.ids WHERE o.side = 'o')"""


@query("version_map", f"""
WITH {_CROSS}, f AS ({_OLD})
SELECT f.id, f.level, x0.new AS ylvl0, x1.new AS ylvl1, CAST(NULL AS VARCHAR) AS ylvl4, xi.new AS y FROM f LEFT JOIN x x0 ON x0.old = f.xlvl0
  LEFT JOIN x x1 ON x1.old = f.xlvl1 LEFT JOIN x xi ON xi.old = f.id WHERE f.level < 4
UNION ALL SELECT id, 4, ylvl0, ylvl1, ylvl4, ylvl4 FROM s""")
def mapped(x):
    return geography.version_map(x.sql(_OLD), x.sql(_RECODES), x.sql(_NEW), "x", "y").select("id", "level", "ylvl0", "ylvl1", "ylvl4", "y")


_DETAIL = """SELECT CONCAT('d', CAST(o_orderkey AS VARCHAR(20))) AS id, LPAD(CAST(o_custkey AS VARCHAR(12)), 12, '0') AS parent_id,
  CONCAT('SECTOR ', LOWER(o_orderpriority), ' l''EAU') AS label_nl, o_orderstatus AS label_fr FROM orders"""
_FIXED_LABEL = """CASE SUBSTRING(o_orderpriority, 1, 1) WHEN '1' THEN 'Sector 1-Urgent L''eau' WHEN '2' THEN 'Sector 2-High L''eau' WHEN '3' THEN 'Sector 3-Medium L''eau'
  WHEN '4' THEN 'Sector 4-Not Specified L''eau' ELSE 'Sector 5-Low L''eau' END"""


@query("attach_deepest", f"""
SELECT id, level, label_nl, label_fr, label_fr AS label_en, parent_id, xlvl0, xlvl1, xlvl4, CAST(NULL AS VARCHAR) AS xlvl5 FROM ({_OLD}) o
UNION ALL SELECT CONCAT('d', CAST(o_orderkey AS VARCHAR)), 5, {_FIXED_LABEL}, o_orderstatus, o_orderstatus, LPAD(CAST(o_custkey AS VARCHAR), 12, '0'),
  xlvl0, xlvl1, xlvl4, CONCAT('d', CAST(o_orderkey AS VARCHAR)) FROM orders LEFT JOIN ({_OLD}) o ON o.level = 4 AND o.xlvl4 = LPAD(CAST(o_custkey AS VARCHAR), 12, '0')""")
def deepest(x):
    out = geography.attach_deepest(x.sql(_OLD), x.sql(_DETAIL), "x")
    return out.select("id", "level", "label_nl", "label_fr", "label_en", "parent_id", "xlvl0", "xlvl1", "xlvl4", "xlvl5")


@query("deepest_level_map", f"""
SELECT CONCAT('d', CAST(o_orderkey AS VARCHAR)) AS id, s.xlvl4, s.ylvl0, s.ylvl1, s.ylvl4, CONCAT('d', CAST(o_orderkey AS VARCHAR)) AS ylvl5,
  CONCAT('d', CAST(o_orderkey AS VARCHAR)) AS y FROM orders LEFT JOIN ({_SUCC}) s ON s.xlvl4 = LPAD(CAST(o_custkey AS VARCHAR), 12, '0')""")
def level_map(x):
    flat = geography.attach_deepest(x.sql(_OLD), x.sql(_DETAIL), "x")
    return geography.deepest_level_map(flat, _successors(x), "x", "y").select("id", "xlvl4", "ylvl0", "ylvl1", "ylvl4", "ylvl5", "y")


@query("chained_map", f"""
SELECT s.id, s.ylvl4 AS y, CASE WHEN c.c_custkey % 4 = 0 THEN NULL ELSE CONCAT('z', CAST(c.c_nationkey AS VARCHAR)) END AS zlvl1, CONCAT('z', s.ylvl4) AS z
FROM ({_SUCC}) s LEFT JOIN customer c ON LPAD(CAST(c.c_custkey AS VARCHAR), 12, '0') = s.ylvl4""")
def chained(x):
    second = x.sql("""SELECT LPAD(CAST(c_custkey AS VARCHAR(12)), 12, '0') AS id, CONCAT('z', LPAD(CAST(c_custkey AS VARCHAR(12)), 12, '0')) AS z,
        CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CONCAT('z', CAST(c_nationkey AS VARCHAR(4))) END AS zlvl1 FROM customer""")
    return geography.chained_map(_successors(x).select("id", "y"), second, "y", "z")


# six versions of areas: in every version some merge into their neighbour and some end
_CHAIN_YEARS = [1977, 1995, 2003, 2011, 2019, 2025]
_STEP = "\nUNION ALL ".join(
    f"SELECT {v} AS version, c_custkey AS id, CASE WHEN (c_custkey + {i}) % 11 = 0 THEN NULL WHEN c_custkey % {i + 2} = 1 THEN c_custkey - 1 ELSE c_custkey END AS next_id FROM customer"
    for i, v in enumerate(_CHAIN_YEARS[:-1]))
_NEXT = " ".join(f"WHEN {a} THEN {b}" for a, b in zip(_CHAIN_YEARS, _CHAIN_YEARS[1:]))


@query("version_chains", f"""
WITH RECURSIVE s AS ({_STEP}),
r AS (SELECT version, id, CASE version {_NEXT} END AS target, next_id AS target_id FROM s WHERE next_id IS NOT NULL
  UNION ALL SELECT r.version, r.id, CASE r.target {_NEXT} END, s.next_id FROM r JOIN s ON s.version = r.target AND s.id = r.target_id WHERE s.next_id IS NOT NULL)
SELECT version, id, target, target_id FROM r""")
def chains(x):
    """What every area of six versions is in each later one."""
    return geography.version_chains(x.sql(_STEP), _CHAIN_YEARS)


# regions at level 1 and nations at level 2: nations 2 and 3 were one before
_VERSION = """SELECT CONCAT('r', CAST(r_regionkey AS VARCHAR(4))) AS id, 1 AS level, 'top' AS parent_id, r_name AS label_nl, r_name AS label_fr, r_name AS label_en,
  'top' AS Blvl0, CONCAT('r', CAST(r_regionkey AS VARCHAR(4))) AS Blvl1, CAST(NULL AS VARCHAR(20)) AS Blvl2, CAST(NULL AS VARCHAR(20)) AS Blvl3, r_name AS Clvl1, CAST(NULL AS VARCHAR(20)) AS Clvl2, r_name AS C FROM region
UNION ALL SELECT CONCAT('n', CAST(n_nationkey AS VARCHAR(4))), 2, CONCAT('r', CAST(n_regionkey AS VARCHAR(4))), n_name, n_name, n_name, 'top', CONCAT('r', CAST(n_regionkey AS VARCHAR(4))),
  CONCAT('n', CAST(n_nationkey AS VARCHAR(4))), NULL, 'c', n_name, n_name FROM nation
UNION ALL SELECT c_name, 3, CONCAT('n', CAST(n_nationkey AS VARCHAR(4))), c_name, c_name, c_name, 'top', CONCAT('r', CAST(n_regionkey AS VARCHAR(4))),
  CONCAT('n', CAST(n_nationkey AS VARCHAR(4))), c_name, 'c', n_name, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey"""
_SPEC = MergedVersion(members=("n2", "n3"), code="n23", label_nl="samen", label_fr="ensemble", region="r4", parent="top")


@query("derive_earlier_version", f"""
WITH v AS ({_VERSION}), m AS (SELECT v.*, CASE WHEN id IN ('n2', 'n3') THEN 'n23' ELSE id END AS nid FROM v WHERE level <> 1)
SELECT DISTINCT nid AS id, level, CASE WHEN level = 2 THEN 'top' WHEN parent_id IN ('n2', 'n3', 'r4') THEN 'n23' ELSE parent_id END AS parent_id,
  CASE WHEN nid = 'n23' THEN 'samen' ELSE label_nl END AS label_nl, CASE WHEN nid = 'n23' THEN 'ensemble' ELSE label_fr END AS label_fr,
  Blvl0 AS Alvl0, CASE WHEN Blvl1 = 'r4' THEN 'n23' WHEN Blvl2 IN ('n2', 'n3') THEN 'n23' ELSE Blvl2 END AS Alvl2, Blvl3 AS Alvl3,
  CASE WHEN level <> 2 THEN Blvl2 END AS Blvl2, CASE WHEN level <> 2 THEN C END AS C, CASE WHEN level <> 2 THEN nid END AS B FROM m""")
def earlier(x):
    out = geography.derive_earlier_version(x.sql(_VERSION), _SPEC, "A", "B", ["C"])
    return out.select("id", "level", "parent_id", "label_nl", "label_fr", "Alvl0", "Alvl2", "Alvl3", "Blvl2", "C", "B")


@query("level_table", f"""
SELECT id AS value, label_nl, label_fr, parent_id AS cl_refnis2019lvl1, CONCAT('xr', SUBSTRING(xlvl0, 3)) AS cl_refnis2019lvl0 FROM ({_OLD}) o WHERE level = 4""")
def one_level(x):
    names = {f"xlvl{i}": f"NIS2019lvl{i}" for i in range(5)}
    return geography.level_table(x.sql(_OLD).withColumnsRenamed(names), 2019, 4)


# ---------------------------------------------------------------- countries

_CAT1 = """SELECT CAST(r_regionkey AS DOUBLE) AS valuen, r_name AS value, CASE WHEN r_regionkey = 3 THEN 'home' ELSE 'abroad' END AS cl_belgium, r_name AS label_nl FROM region"""
_CAT2 = """SELECT CAST(n_nationkey AS DOUBLE) AS valuen, n_name AS value, r_name AS cl_countrycat1, n_name AS label_nl FROM nation JOIN region ON n_regionkey = r_regionkey"""
_ISO = """SELECT c_custkey AS valuen, CONCAT('i2-', CAST(c_custkey AS VARCHAR(12))) AS value2, CONCAT('i3-', CAST(c_custkey AS VARCHAR(12))) AS value3, c_mktsegment AS cl_worldregion,
  CASE WHEN c_custkey % 5 <> 0 THEN n_name END AS cl_countrycat2, c_name AS label_nl FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey <> 4"""


@query("country_chain", f"""
WITH c2 AS (SELECT b.*, a.cl_belgium FROM ({_CAT2}) b LEFT JOIN ({_CAT1}) a ON a.value = b.cl_countrycat1)
SELECT i.valuen, i.value3 AS value, i.cl_worldregion, COALESCE(i.cl_countrycat2, c2.value) AS cl_countrycat2, i.label_nl, c2.cl_countrycat1, c2.cl_belgium, i.value2 AS cl_countryISO2
FROM ({_ISO}) i FULL OUTER JOIN c2 ON c2.value IS NOT DISTINCT FROM i.cl_countrycat2""")
def chain(x):
    return countries.by_code(countries.country_chain(x.sql(_CAT1), x.sql(_CAT2), x.sql(_ISO)), "value3", "value2", "cl_countryISO2")


@query("multi_code_enrich", oracle("""
WITH e AS (SELECT valuen, UNNEST(STRING_SPLIT(codes, ';')) AS code, GENERATE_SUBSCRIPTS(STRING_SPLIT(codes, ';'), 1) AS pos FROM multicode),
j AS (SELECT e.*, cat, len FROM e LEFT JOIN code_lookup l ON l.code = e.code),
u AS (SELECT valuen, 'codes' AS col, code AS v, MIN(pos) AS pos FROM j GROUP BY valuen, code UNION ALL SELECT valuen, 'cat', cat, MIN(pos) FROM j GROUP BY valuen, cat
  UNION ALL SELECT valuen, 'len', len, MIN(pos) FROM j GROUP BY valuen, len),
t AS (SELECT valuen, col, CASE WHEN COUNT(*) = COUNT(v) THEN STRING_AGG(v, ';' ORDER BY pos) END AS txt FROM u GROUP BY valuen, col)
SELECT valuen, MAX(CASE WHEN col = 'codes' THEN txt END) AS codes, COALESCE(MAX(CASE WHEN col = 'cat' THEN txt END), CASE WHEN valuen >= 700 THEN 'other' END) AS cat,
  MAX(CASE WHEN col = 'len' THEN txt END) AS len FROM t GROUP BY valuen"""))
def enriched(x):
    out = countries.multi_code_enrich(x.view("multicode"), ["valuen"], "codes", x.view("code_lookup"), "code", ["cat", "len"])
    return countries.defaults_above(out, "valuen", countries.FIRST_NO_COUNTRY["country"], {"cat": "other"})


# ---------------------------------------------------------------- codebook

_VARIABLES = "SELECT p_partkey AS pos, CONCAT('v', CAST(p_partkey AS VARCHAR(20))) AS variable, CONCAT('c', CAST(p_partkey AS VARCHAR(20))) AS concept_id FROM part"
_CONCEPTS = """SELECT CONCAT('c', CAST(p_partkey AS VARCHAR(20))) AS concept_id, CASE WHEN p_size % 3 = 0 THEN 'integer' ELSE 'codelist' END AS constraint_type,
  CASE WHEN p_size % 3 <> 0 THEN CONCAT('cl_', p_type) END AS constraint_codelist FROM part"""
_ASKED = """SELECT CONCAT('c', CAST(p_partkey AS VARCHAR(20))) AS concept_id, p_name AS varlabel, CONCAT('Q ', p_name) AS question,
  CASE WHEN p_size > 25 THEN CONCAT('item ', p_brand) END AS question_item FROM part WHERE p_partkey % 50 <> 0"""
_SAID = "SELECT DISTINCT p_brand AS value, CONCAT('answer ', p_brand) AS vallabel FROM part WHERE p_brand <> 'Brand#9'"


@query("codebook", oracle(f"""
WITH e AS (SELECT v.pos, v.variable, v.concept_id, c.constraint_type, q.varlabel, q.question, q.question_item, l.pos AS code_pos, l.valuen, l.value, a.vallabel
  FROM ({_VARIABLES}) v LEFT JOIN ({_CONCEPTS}) c ON c.concept_id = v.concept_id LEFT JOIN ({_ASKED}) q ON q.concept_id = v.concept_id
  LEFT JOIN dsd_codelists l ON l.codelist = c.constraint_codelist LEFT JOIN ({_SAID}) a ON a.value = l.value),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY concept_id ORDER BY pos, code_pos) AS k FROM e)
SELECT pos, code_pos, concept_id, CASE WHEN k = 1 THEN variable ELSE '' END AS varname, CASE WHEN k = 1 THEN varlabel ELSE '' END AS varlabel,
  CASE WHEN k = 1 THEN CONCAT_WS(' ', question, question_item) ELSE '' END AS question,
  CASE WHEN valuen % 1 = 0 THEN PRINTF('%.0f', valuen) WHEN valuen % 1 <> 0 THEN PRINTF('%.2f', valuen) ELSE CONCAT('[', constraint_type, ']') END AS valn, vallabel AS valc FROM r"""))
def book(x):
    return cb.codebook(x.sql(_VARIABLES), x.sql(_CONCEPTS), x.sql(_ASKED), x.sql(_SAID), x.view("dsd_codelists"), check=False)


@query("codebook_integrity", oracle(f"""
SELECT 'concept without question' AS problem, concept_id AS item FROM ({_VARIABLES}) v WHERE concept_id NOT IN (SELECT concept_id FROM ({_ASKED}) q)
UNION ALL SELECT DISTINCT 'value without label', l.value FROM ({_CONCEPTS}) c JOIN dsd_codelists l ON l.codelist = c.constraint_codelist
WHERE l.value NOT IN (SELECT value FROM ({_SAID}) a)"""))
def integrity(x):
    variables, questions = x.sql(_VARIABLES), x.sql(_ASKED)
    expanded = cb.expanded_variables(variables, x.sql(_CONCEPTS), questions, x.view("dsd_codelists"))
    unasked = cb.concepts_without_question(variables, questions)
    silent = cb.values_without_label(expanded, x.sql(_SAID))
    return unasked.select(F.lit("concept without question").alias("problem"), F.col("concept_id").alias("item")).unionByName(
        silent.select(F.lit("value without label").alias("problem"), F.col("value").alias("item")))


_EDITION_ROWS = """SELECT CONCAT('SV', LPAD(CAST(s_suppkey AS VARCHAR(12)), 4, '0')) AS surv_id, 2000 + s_nationkey AS surv_year, CASE WHEN s_suppkey % 2 = 0 THEN 'spring' ELSE 'autumn' END AS surv_semester,
  s_suppkey * 10 AS sample_n, s_name AS cntctprs, CONCAT('org ', CAST(s_nationkey AS VARCHAR(4))) AS fw_org FROM supplier"""


@query("codebook_title", f"""
WITH e AS ({_EDITION_ROWS})
SELECT surv_id, 1 AS line, 'TITEL' AS key, CONCAT('Codeboek ', surv_id, ' (', surv_semester, ' ', CAST(surv_year AS VARCHAR), ')') AS value FROM e
UNION ALL SELECT surv_id, 2, 'BESCHRIJVING', CONCAT('Bevraging bij ', CAST(sample_n AS VARCHAR), ' personen') FROM e
UNION ALL SELECT surv_id, 3, 'CONTACTPERSOON', cntctprs FROM e UNION ALL SELECT surv_id, 4, 'VELDWERKBUREAU', fw_org FROM e""")
def title(x):
    return cb.title_block(x.sql(_EDITION_ROWS))


# ---------------------------------------------------------------- older metadata

_SCALES = """SELECT DISTINCT CONCAT('old', p_type) AS old_scale, LOWER(p_type) AS scale, CAST(p_size % 4 AS DOUBLE) AS valuen, CONCAT(LOWER(p_type), '_', CAST(p_size % 4 AS VARCHAR(4))) AS value FROM part
UNION SELECT DISTINCT 'missing', 'dkn', CAST(99 AS DOUBLE), 'dkn' FROM part UNION SELECT DISTINCT 'missing', 'na', CAST(98 AS DOUBLE), 'na' FROM part UNION SELECT DISTINCT 'missing', 'inv', CAST(97 AS DOUBLE), 'invalid' FROM part"""
_USES = """SELECT CASE WHEN p_size % 10 <> 0 THEN CONCAT('old', p_type) END AS scale, CASE WHEN p_partkey % 2 = 0 THEN 'x' END AS weetniet, CASE WHEN p_partkey % 3 = 0 THEN 'f' END AS filter,
  CASE WHEN p_partkey % 5 = 0 THEN 'q' END AS question FROM part"""


@query("legacy_membership", f"""
WITH s AS ({_SCALES}), u AS (SELECT DISTINCT scale, CASE WHEN weetniet = 'x' THEN 'dkn' END AS w, CASE WHEN filter IS NOT NULL THEN 'na' END AS f, CASE WHEN question IS NOT NULL THEN 'inv' END AS i FROM ({_USES}) z WHERE scale IS NOT NULL),
n AS (SELECT u.*, k.new_scale FROM u LEFT JOIN (SELECT DISTINCT old_scale, scale AS new_scale FROM s) k ON k.old_scale = u.scale),
a AS (SELECT scale, NULL AS w, NULL AS f, NULL AS i, new_scale FROM n WHERE i = 'inv' UNION SELECT scale, w, f, i, new_scale FROM n),
b AS (SELECT CONCAT_WS('_', new_scale, w, f, i) AS name, new_scale AS overall_scale, new_scale, w, f, i FROM a),
l AS (SELECT name, overall_scale, new_scale AS part FROM b UNION ALL SELECT name, overall_scale, w FROM b UNION ALL SELECT name, overall_scale, f FROM b UNION ALL SELECT name, overall_scale, i FROM b)
SELECT DISTINCT l.overall_scale, l.name, s.valuen, s.value FROM l LEFT JOIN s ON s.scale = l.part WHERE l.part IS NOT NULL""")
def scale_members(x):
    return legacy.scale_members(x.sql(_USES), x.sql(_SCALES))


_SCALE = "promo"


@query("legacy_skeleton", f"""
WITH s AS ({_SCALES}), u AS (SELECT DISTINCT CASE WHEN weetniet = 'x' THEN 'dkn' END AS w, CASE WHEN filter IS NOT NULL THEN 'na' END AS f, CASE WHEN question IS NOT NULL THEN 'inv' END AS i
  FROM ({_USES}) z WHERE scale = 'oldPROMO'),
a AS (SELECT w, f, i FROM u UNION SELECT NULL, NULL, NULL FROM u WHERE i = 'inv'),
b AS (SELECT CONCAT_WS('_', '{_SCALE}', w, f, i) AS name, '{_SCALE}' AS n, w, f, i FROM a),
l AS (SELECT name, n AS part FROM b UNION SELECT name, w FROM b UNION SELECT name, f FROM b UNION SELECT name, i FROM b),
m AS (SELECT DISTINCT name, valuen, value FROM l JOIN s ON s.scale = l.part)
SELECT v.valuen, v.value, k.name, m.name IS NOT NULL AS member
FROM (SELECT DISTINCT valuen, value FROM m) v CROSS JOIN (SELECT DISTINCT name FROM m) k
LEFT JOIN m ON m.name = k.name AND m.value = v.value AND m.valuen IS NOT DISTINCT FROM v.valuen""")
def scale_skeleton(x):
    """The skeleton of one scale, FALSE where a list lacks a value; its columns made rows, as they differ with the data."""
    wide = legacy.legacy_skeleton(legacy.scale_members(x.sql(_USES), x.sql(_SCALES)), _SCALE)
    return wide.unpivot(["valuen", "value"], [c for c in wide.columns if c not in ("valuen", "value")], "name", "member")


@query("ambiguous_values", """
SELECT value, COUNT(*) AS n FROM (SELECT DISTINCT p_brand AS value, p_type AS description_nl, p_size % 2 AS label_nl FROM part) t GROUP BY value HAVING COUNT(*) > 1""")
def ambiguous(x):
    return legacy.ambiguous_values(x.sql("SELECT p_brand AS value, p_type AS description_nl, p_size % 2 AS label_nl FROM part"))


_OLD_VALUES = """SELECT CONCAT('old', p_type) AS scale, CASE WHEN p_size = 13 THEN 'x' ELSE CAST(p_size % 5 AS VARCHAR(4)) END AS valn,
  CASE WHEN p_size % 4 = 3 THEN 'Andere situatie' ELSE CONCAT('label ', CAST(p_size % 4 AS VARCHAR(4))) END AS valc FROM part"""


@query("legacy_labels", f"""
WITH k AS (SELECT old_scale AS scale, valuen AS valn, value FROM ({_SCALES}) s WHERE old_scale <> 'missing'),
o AS (SELECT scale, TRY_CAST(valn AS DOUBLE) AS valn, valc FROM ({_OLD_VALUES}) v),
l AS (SELECT DISTINCT k.value, o.valc AS label_survey FROM o LEFT JOIN k ON k.scale = o.scale AND k.valn IS NOT DISTINCT FROM o.valn WHERE o.valc <> 'Andere situatie')
SELECT v.value, v.label, l.label_survey FROM (SELECT DISTINCT value, UPPER(value) AS label FROM ({_SCALES}) s) v LEFT JOIN l ON l.value IS NOT DISTINCT FROM v.value""")
def old_labels(x):
    values = x.sql(f"SELECT DISTINCT value, UPPER(value) AS label FROM ({_SCALES}) s")
    return legacy.attach_survey_labels(values, x.sql(_SCALES), x.sql(_OLD_VALUES))


_FORMATS = """SELECT CONCAT('v', CAST(p_partkey AS VARCHAR(20))) AS variable, CASE p_partkey % 4 WHEN 0 THEN 'string' WHEN 1 THEN 'nominal' WHEN 2 THEN 'ordinal' ELSE 'numeric' END AS measure,
  CASE WHEN p_size % 6 = 0 THEN '^[0-9]+$' END AS format, CASE WHEN p_partkey % 4 IN (1, 2) THEN LOWER(p_type) END AS scale, CASE WHEN p_size % 2 = 0 THEN 'x' END AS weetniet,
  CASE WHEN p_size % 3 = 0 THEN 'f' END AS filter, CASE WHEN p_size % 5 = 0 THEN 'q' END AS question,
  CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 7 < 4 THEN 'enquete' ELSE 'register' END AS source, CASE WHEN p_size % 8 = 0 THEN NULL WHEN p_size % 8 < 4 THEN 'x' ELSE '-' END AS suf,
  CASE WHEN p_size % 9 < 4 THEN 'x' ELSE '-' END AS puf FROM part"""


@query("format_strings", f"""
WITH v AS ({_FORMATS}), m AS (SELECT *, CASE measure WHEN 'string' THEN 'character' WHEN 'nominal' THEN 'codelist' WHEN 'ordinal' THEN 'codelist' ELSE measure END AS mm FROM v),
c AS (SELECT *, CONCAT_WS('_', scale, CASE WHEN weetniet = 'x' AND mm = 'codelist' THEN 'dkn' END, CASE WHEN filter IS NOT NULL AND mm = 'codelist' THEN 'na' END,
  CASE WHEN question IS NOT NULL AND mm = 'codelist' THEN 'inv' END) AS cl FROM m),
t AS (SELECT *, CONCAT_WS(';', 'format=' || mm, 'regex=' || format, 'codelist=' || NULLIF(cl, '')) AS txt FROM c)
SELECT variable, '' AS format_sample, CASE WHEN source = 'enquete' THEN txt WHEN source <> 'enquete' THEN '' END AS format_fieldwork, txt AS format_clean,
  CASE WHEN suf = 'x' THEN txt WHEN suf <> 'x' THEN '' END AS format_suf, CASE WHEN puf = 'x' THEN txt WHEN puf <> 'x' THEN '' END AS format_puf FROM t""")
def formats(x):
    return legacy.format_strings(x.sql(_FORMATS))


@query("variable_mapping", """
SELECT c_name AS variable, CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 'resp_fwdisp' ELSE CONCAT('con', CAST(c_custkey AS VARCHAR)) END AS concept_id FROM customer""")
def variables(x):
    registry = x.sql("SELECT CONCAT('o', CAST(c_custkey AS VARCHAR(12))) AS old_varname, CASE WHEN c_custkey % 10 <> 0 THEN LOWER(c_name) END AS variable_lc FROM customer")
    recoded = x.sql("SELECT CONCAT('o', CAST(c_custkey AS VARCHAR(12))) AS old_varname, CASE WHEN c_custkey % 10 = 1 THEN 'resp_disp' ELSE CONCAT('con', CAST(c_custkey AS VARCHAR(12))) END AS concept_id FROM customer")
    return legacy.variable_mapping(x.table("customer").select(F.col("c_name").alias("variable")), registry, recoded)


@query("label_skeleton", """
WITH r AS (SELECT c_custkey AS concept_id, CONCAT('V', CAST(c_custkey AS VARCHAR)) AS variable, c_mktsegment AS label_nl FROM customer WHERE c_custkey % 7 NOT IN (0, 1)),
f AS (SELECT CONCAT('V', CAST(c_custkey AS VARCHAR)) AS variable, c_name AS variable_label FROM customer WHERE c_custkey % 3 <> 0)
SELECT r.concept_id, COALESCE(r.variable, f.variable) AS variable, r.label_nl, f.variable_label FROM r FULL OUTER JOIN f ON f.variable = r.variable""")
def skeleton(x):
    registry = x.sql("""SELECT c_custkey AS concept_id, CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'afgeleid' ELSE CONCAT('v', CAST(c_custkey AS VARCHAR(12))) END AS variable,
        c_mktsegment AS label_nl FROM customer""")
    labels = x.sql("SELECT CONCAT('V', CAST(c_custkey AS VARCHAR(12))) AS variable, c_name AS variable_label FROM customer WHERE c_custkey % 3 <> 0")
    return legacy.label_skeleton(registry, labels)
