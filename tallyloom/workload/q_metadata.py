"""Versioned registries, lookups, mailings and the DSD."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metadata as m
from ..operators.dsd import dsd_lint
from .inputs import oracle
from .registry import query

_ANSWERS = """
SELECT DISTINCT CONCAT(o_orderstatus, '-', CAST(o_custkey % 50 AS VARCHAR(4))) AS value,
  CONCAT('SV', LPAD(CAST(YEAR(o_orderdate) - 1994 AS VARCHAR(4)), 4, '0')) AS from_surv_id,
  CONCAT('label ', SUBSTRING(o_orderpriority, 1, 1)) AS vallabel
FROM orders"""


@query("asof_questions", oracle("""
SELECT concept_id, varlabel FROM (SELECT *, RANK() OVER (PARTITION BY concept_id ORDER BY from_surv_id DESC) AS r
  FROM questions WHERE from_surv_id <= 'SV0004') t WHERE r = 1"""))
def questions(x):
    return m.asof_questions(x.view("questions"), "SV0004")


@query("asof_answers", f"""
SELECT value, vallabel FROM (SELECT *, RANK() OVER (PARTITION BY value ORDER BY from_surv_id DESC) AS r
  FROM ({_ANSWERS}) a WHERE from_surv_id <= 'SV0005') t WHERE r = 1""")
def answers(x):
    return m.asof_answers(x.sql(_ANSWERS), "SV0005")


@query("exactly_one", """
SELECT c_custkey, COUNT(o_orderkey) AS n,
  CASE WHEN COUNT(o_orderkey) = 0 THEN 'missing' WHEN COUNT(o_orderkey) = 1 THEN 'ok' ELSE 'multiple' END AS status
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def one(x):
    registry = x.table("orders").select(F.col("o_custkey").alias("c_custkey"))
    return m.lookup_counts(x.table("customer"), registry, "c_custkey")


@query("metadata_nulls", oracle("""
SELECT 'q1' AS "column", COUNT(*) - COUNT(q1) AS n_missing FROM answers
UNION ALL SELECT 'q7', COUNT(*) - COUNT(q7) FROM answers UNION ALL SELECT 'row_id', COUNT(*) - COUNT(row_id) FROM answers"""))
def nulls(x):
    return m.null_counts(x.view("answers"), ["q1", "q7", "row_id"])


@query("complete_counts", oracle("""
WITH e AS (SELECT fw_period, contact FROM (SELECT DISTINCT fw_period FROM contact_log) p
           CROSS JOIN (VALUES ('invitation'), ('reminder_1'), ('reminder_2')) AS t(contact)),
c AS (SELECT fw_period, contact, COUNT(*) AS n FROM contact_log GROUP BY fw_period, contact)
SELECT e.fw_period, e.contact, COALESCE(c.n, 0) AS n,
  CONCAT(e.contact, CASE WHEN c.n IS NULL THEN ': no mailing' ELSE ': several mailings' END) AS message
FROM e LEFT JOIN c ON e.fw_period = c.fw_period AND e.contact = c.contact WHERE COALESCE(c.n, 0) <> 1"""))
def contacts(x):
    return m.contact_problems(x.view("contact_log"))


@query("mailings_wide", oracle("""
SELECT fw_period, CAST(MIN(CASE WHEN contact = 'invitation' THEN date END) AS VARCHAR) AS invitation,
  CAST(MIN(CASE WHEN contact = 'reminder_1' THEN date END) AS VARCHAR) AS reminder_1,
  CAST(MIN(CASE WHEN contact = 'reminder_2' THEN date END) AS VARCHAR) AS reminder_2
FROM contact_log GROUP BY fw_period"""))
def wide(x):
    first = x.view("contact_log").groupBy("fw_period", "contact").agg(F.min("date").alias("date"))  # the log repeats contacts
    return m.mailings_wide(first).select(
        "fw_period", *[F.col(c).cast("string").alias(c) for c in m.CONTACTS])


@query("missing_concepts", oracle("""
SELECT DISTINCT CONCAT('c', CAST(l_partkey AS VARCHAR)) AS concept_id FROM lineitem
WHERE CONCAT('c', CAST(l_partkey AS VARCHAR)) NOT IN (SELECT concept_id FROM dsd)"""))
def unknown_concepts(x):
    wanted = x.sql("SELECT CONCAT('c', CAST(l_partkey AS VARCHAR(20))) AS concept_id FROM lineitem")
    return m.missing_concepts(wanted, x.view("dsd"))


@query("dsd_with_codelists", oracle("""
SELECT concept_id, constraint_codelist, COALESCE(n, 0) AS n_codes, COALESCE(codes, '') AS codes
FROM dsd LEFT JOIN (SELECT codelist, COUNT(*) AS n, STRING_AGG(value, ';' ORDER BY pos) AS codes FROM dsd_codelists GROUP BY codelist) c
ON constraint_codelist = codelist"""))
def nested(x):
    out = m.dsd_with_codelists(x.view("dsd"), x.view("dsd_codelists"))
    codes = F.col("constraint_codelist_ds")
    return out.select("concept_id", "constraint_codelist", F.size(codes).cast("bigint").alias("n_codes"),
                      F.array_join(F.transform(codes, lambda c: c["value"]), ";").alias("codes"))


@query("edition_structure", oracle("""
SELECT CONCAT('v', CAST(o_orderkey AS VARCHAR)) AS concept_id, d.label_nl, d.label_fr, d.label_en, d.fmt AS format
FROM orders LEFT JOIN (SELECT concept_id, MIN(label_nl) AS label_nl, MIN(UPPER(label_nl)) AS label_fr, MIN(LOWER(label_nl)) AS label_en,
  MIN(constraint_type) AS fmt FROM dsd GROUP BY concept_id) d ON d.concept_id = CONCAT('c', CAST(o_custkey * 2 AS VARCHAR))"""))
def structure(x):
    skeleton = x.sql("""SELECT CONCAT('v', CAST(o_orderkey AS VARCHAR(20))) AS variable,
        CONCAT('c', CAST(o_custkey * 2 AS VARCHAR(20))) AS concept_id FROM orders""")
    concepts = x.sql("""SELECT concept_id, MIN(label_nl) AS label_nl, MIN(UPPER(label_nl)) AS label_fr,
        MIN(LOWER(label_nl)) AS label_en, MIN(constraint_type) AS format_sample FROM dsd GROUP BY concept_id""")
    return m.edition_structure(skeleton, concepts, "format_sample")


_IS_TYPE = "constraint_type IN ('character', 'date', 'datetime', 'codelist', 'integer', 'numeric')"


@query("dsd_lint", oracle(f"""
SELECT 'type' AS rule, concept_id, CONCAT('Type ''', constraint_type, ''' of concept ''', concept_id, ''' is not known') AS message
FROM dsd WHERE NOT ({_IS_TYPE})
UNION ALL SELECT 'codelist_on_other_type', concept_id, CONCAT('Concept ''', concept_id, ''' has a code list but is not of type codelist')
FROM dsd WHERE constraint_codelist IS NOT NULL AND constraint_type <> 'codelist'
UNION ALL SELECT 'codelist_missing', concept_id, CONCAT('Concept ''', concept_id, ''' does not have a code list')
FROM dsd WHERE constraint_codelist IS NULL AND constraint_type = 'codelist'
UNION ALL SELECT 'regex_on_other_type', concept_id, CONCAT('Concept ''', concept_id, ''' has a regex but is not of type character')
FROM dsd WHERE constraint_regex IS NOT NULL AND constraint_type <> 'character'
UNION ALL SELECT 'min_on_other_type', concept_id, CONCAT('Concept ''', concept_id, ''' has a minimum but is not numeric')
FROM dsd WHERE constraint_min IS NOT NULL AND constraint_type NOT IN ('integer', 'numeric')
UNION ALL SELECT 'max_on_other_type', concept_id, CONCAT('Concept ''', concept_id, ''' has a maximum but is not numeric')
FROM dsd WHERE constraint_max IS NOT NULL AND constraint_type NOT IN ('integer', 'numeric')
UNION ALL SELECT 'min_above_max', concept_id, CONCAT('Concept ''', concept_id, ''' has a minimum above its maximum')
FROM dsd WHERE constraint_min > constraint_max
UNION ALL SELECT 'duplicate', concept_id, CONCAT('concept_id ''', concept_id, ''' is not unique (', CAST(COUNT(*) AS VARCHAR), ' rows)')
FROM dsd GROUP BY concept_id HAVING COUNT(*) > 1
UNION ALL SELECT 'codelist_unknown', concept_id, CONCAT('Code list of concept ''', concept_id, ''' does not exist: ''', constraint_codelist, '''')
FROM dsd WHERE constraint_codelist IS NOT NULL AND constraint_codelist NOT IN (SELECT codelist FROM dsd_codelists)
UNION ALL SELECT 'regex_invalid', concept_id, CONCAT('Regex of concept ''', concept_id, ''' is not valid: ''', constraint_regex, '''')
FROM dsd WHERE constraint_regex = '([a-z'"""))
def lint(x):
    return dsd_lint(x.view("dsd"), x.view("dsd_codelists"))


@query("version_intervals", oracle("""
SELECT concept_id, start, LEAD(start) OVER (PARTITION BY concept_id ORDER BY start) - 1 AS "end"
FROM (SELECT concept_id, CAST(SUBSTRING(from_surv_id, 3) AS INT) AS start FROM questions) t"""))
def intervals(x):
    registry = x.view("questions").select("concept_id", F.expr("CAST(SUBSTRING(from_surv_id, 3) AS INT)").alias("start"))
    return m.version_intervals(registry, "start", ["concept_id"])


_VERSIONS = """SELECT concept_id AS o_orderpriority, CAST(CONCAT(CAST(1994 + CAST(SUBSTRING(from_surv_id, 3) AS INT) AS VARCHAR(4)), '-05-01') AS DATE) AS since,
  CASE WHEN from_surv_id = 'SV0002' THEN CAST('1996-12-31' AS DATE) END AS last_day, varlabel FROM questions"""
_DATED = "SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders"


@query("versions_at_dates", oracle(f"""
WITH v AS ({_VERSIONS}), d AS ({_DATED})
SELECT d.o_orderkey, d.day, CASE WHEN d.day <= COALESCE(v.last_day, d.day) THEN v.varlabel END AS varlabel
FROM d ASOF LEFT JOIN v ON d.o_orderpriority = v.o_orderpriority AND d.day >= v.since"""))
def versions_at_dates(x):
    """The wording of its question that held on the day of every response."""
    out = m.valid_versions(x.sql(_DATED), "day", x.sql(_VERSIONS), "since", ["varlabel"], ["o_orderpriority"], until="last_day")
    return out.select("o_orderkey", "day", "varlabel")
