"""Checks of data against the DSD, and conforming to it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import validation as v
from ..operators.validation import Concept
from ..plans.publishing import publish_checked
from ..sources import versions
from ..sources.tables import write_partitioned
from .inputs import oracle
from .registry import query

CONCEPTS = [
    Concept("row_id", "integer", allow_missings=False),
    Concept("status", "codelist", codelist="status", allow_missings=False),
    Concept("priority", "character", regex="^[1-4]-[A-Z]", allow_missings=False),
    Concept("price", "numeric", minimum=5000.0, maximum=450000.0),
    Concept("date_text", "date"),
    Concept("moment_text", "datetime"),
    Concept("code", "codelist", codelist="code"),
]
# code lists built from the data: all but one status, all codes below ten
_LISTS = """
SELECT DISTINCT 'status' AS codelist, o_orderstatus AS value, CAST(NULL AS DOUBLE) AS valuen FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT DISTINCT 'code', CONCAT('code', CAST(o_custkey % 10 AS VARCHAR(4))), CAST(o_custkey % 10 AS DOUBLE) FROM orders"""
_MISSING = """SELECT 'priority' AS concept_id, 'missing' AS rule, CAST(NULL AS VARCHAR) AS value, COUNT(*) AS n FROM raw WHERE priority IS NULL HAVING COUNT(*) > 0"""
_RANGE = """SELECT 'price' AS concept_id, 'min' AS rule, CAST(NULL AS VARCHAR) AS value, COUNT(*) AS n FROM raw WHERE price < 5000 HAVING COUNT(*) > 0
UNION ALL SELECT 'price', 'max', NULL, COUNT(*) FROM raw WHERE price > 450000 HAVING COUNT(*) > 0"""
_DATES = """SELECT 'date_text' AS concept_id, 'date_format' AS rule, CAST(NULL AS VARCHAR) AS value, COUNT(*) AS n FROM raw
WHERE NOT regexp_matches(date_text, '^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$') HAVING COUNT(*) > 0
UNION ALL SELECT 'moment_text', 'datetime_format', NULL, COUNT(*) FROM raw
WHERE NOT regexp_matches(moment_text, '^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])[ T](0[0-9]|1[0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$') HAVING COUNT(*) > 0"""
_REGEX = """SELECT 'priority' AS concept_id, 'regex' AS rule, priority AS value, COUNT(*) AS n FROM raw
WHERE NOT regexp_matches(priority, '^[1-4]-[A-Z]') GROUP BY priority"""
_LISTED = """SELECT 'status' AS concept_id, 'codelist' AS rule, status AS value, COUNT(*) AS n FROM raw WHERE status NOT IN (SELECT value FROM lists WHERE codelist = 'status') GROUP BY status
UNION ALL SELECT 'code', 'codelist', CONCAT(CAST(code AS VARCHAR), '.0'), COUNT(*) FROM raw WHERE code NOT IN (SELECT valuen FROM lists WHERE codelist = 'code') GROUP BY code"""


@query("check_missing", oracle(_MISSING))
def missing(x):
    return v.check_cells(x.view("raw"), CONCEPTS).where("rule = 'missing'")


@query("check_range", oracle(_RANGE))
def ranges(x):
    return v.check_cells(x.view("raw"), CONCEPTS).where("rule IN ('min', 'max')")


@query("check_date_format", oracle(_DATES))
def dates(x):
    return v.check_cells(x.view("raw"), CONCEPTS).where("rule LIKE '%format'")


@query("check_regex", oracle(_REGEX))
def regex(x):
    return v.offending_values(x.view("raw"), CONCEPTS)


@query("check_codelist", oracle(f"WITH lists AS ({_LISTS})\n{_LISTED}"))
def listed(x):
    return v.unlisted_values(x.view("raw"), CONCEPTS, x.sql(_LISTS))


@query("violations", oracle(f"WITH lists AS ({_LISTS})\n" + "\nUNION ALL ".join([_MISSING, _RANGE, _DATES, _REGEX, _LISTED])))
def everything(x):
    return v.violations(x.view("raw"), CONCEPTS, x.sql(_LISTS))


@query("conform", oracle(f"""
WITH lists AS ({_LISTS})
SELECT CAST(row_id AS INT) AS row_id, status, priority, price,
  CAST(TRY_CAST(date_text AS DATE) AS VARCHAR) AS date_text,
  STRFTIME(TRY_CAST(REPLACE(moment_text, 'T', ' ') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS moment_text, l.value AS code
FROM raw LEFT JOIN lists l ON l.codelist = 'code' AND l.valuen = raw.code"""))
def conformed(x):
    out = v.conform(x.view("raw"), CONCEPTS, x.sql(_LISTS), [c.concept_id for c in CONCEPTS])
    return out.withColumns({"date_text": F.col("date_text").cast("string"),
                            "moment_text": F.date_format("moment_text", "yyyy-MM-dd HH:mm:ss")})


_DSD_ROWS = "SELECT DISTINCT CONCAT('q', CAST(l_linenumber + 1 AS VARCHAR(4))) AS concept_id FROM lineitem"


@query("schema_diff", f"""
WITH h AS (SELECT concept_id FROM (VALUES ('q1'), ('q2'), ('q3'), ('q4'), ('q5'), ('q6'), ('q7')) AS t(concept_id)), d AS ({_DSD_ROWS})
SELECT concept_id, 'column without concept' AS problem FROM h WHERE concept_id NOT IN (SELECT concept_id FROM d)
UNION ALL SELECT concept_id, 'concept without column' FROM d WHERE concept_id NOT IN (SELECT concept_id FROM h)""")
def columns(x):
    data = x.view("answers").select(*[f"q{i}" for i in range(1, 8)])
    return v.schema_diff(data, x.sql(_DSD_ROWS))


_CODES = "SELECT DISTINCT 'priority' AS codelist, CONCAT('p', SUBSTRING(o_orderpriority, 1, 1)) AS value FROM orders"
_LABELS = """SELECT DISTINCT CONCAT('p', SUBSTRING(o_orderpriority, 1, 1)) AS value, o_orderpriority AS vallabel FROM orders
WHERE o_orderpriority <> '5-LOW'"""


@query("relabel_codes", oracle("""
SELECT row_id, CASE WHEN priority <> '5-LOW' THEN CONCAT('p', SUBSTRING(priority, 1, 1)) END AS priority, status FROM raw"""))
def relabelled(x):
    displays = v.display_values(x.sql(_CODES), x.sql(_LABELS))
    return v.relabel_codes(x.view("raw").select("row_id", "priority", "status"), {"priority": "priority"}, displays)


@query("label_mismatch", """
SELECT variable, varlabel, value FROM (
  SELECT CONCAT('v', CAST(p_partkey AS VARCHAR)) AS variable, p_name AS varlabel,
    CASE WHEN p_partkey % 9 = 0 THEN p_name WHEN p_partkey % 6 = 0 THEN UPPER(p_name) WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END AS value
  FROM part) t WHERE value <> varlabel""")
def labels(x):
    part = x.table("part").select(F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("variable"), "p_partkey", "p_name")
    found = F.when(F.col("p_partkey") % 6 == 0, F.upper("p_name")).when(F.col("p_partkey") % 4 == 0, None).otherwise(F.col("p_name"))
    return v.label_mismatch(part.select("variable", found.alias("value")),
                            part.select("variable", F.col("p_name").alias("varlabel")),
                            part.where("p_partkey % 9 = 0").select("variable", F.col("p_name").alias("value")))


@query("decode_labels", r"""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final answer' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus,
  TRIM(REGEXP_REPLACE(CONCAT('  ', REPLACE(o_orderpriority, '-', '    '), ' '), '\s+', ' ', 'g')) AS o_orderpriority FROM orders""")
def decoded(x):
    padded = F.concat(F.lit("  "), F.regexp_replace("o_orderpriority", "-", "  \t "), F.lit(" "))
    df = x.table("orders").select("o_orderkey", "o_orderstatus", padded.alias("o_orderpriority"))
    return v.decode_labels(df, {"o_orderstatus": {"F": " final   answer", "O": "open"}})


@query("response_checks", """
WITH s AS (SELECT CASE WHEN o_orderkey % 90 = 0 THEN NULL ELSE o_orderpriority END AS disp,
    CASE o_orderstatus WHEN 'P' THEN 'paper' WHEN 'O' THEN 'online' END AS mode,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'QR' END AS qr, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS date,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'phone' END AS dev FROM orders)
SELECT 'disposition missing' AS rule, COUNT(*) AS n FROM s WHERE disp IS NULL
UNION ALL SELECT 'online without qr/url', COUNT(*) FROM s WHERE mode = 'online' AND qr IS NULL
UNION ALL SELECT 'online without date', COUNT(*) FROM s WHERE mode = 'online' AND date IS NULL
UNION ALL SELECT 'not online but with date', COUNT(*) FROM s WHERE mode <> 'online' AND date IS NOT NULL
UNION ALL SELECT 'online without device', COUNT(*) FROM s WHERE mode = 'online' AND dev IS NULL""")
def crossed(x):
    key = F.col("o_orderkey")
    return v.response_checks(x.table("orders").select(
        F.when(key % 90 != 0, F.col("o_orderpriority")).alias("resp_fwdisp"),
        F.when(F.col("o_orderstatus") == "P", "paper").when(F.col("o_orderstatus") == "O", "online").alias("resp_mode"),
        F.when(key % 7 != 0, "QR").alias("resp_qrurl"), F.when(key % 11 != 0, F.col("o_orderdate")).alias("resp_date"),
        F.when(key % 13 != 0, "phone").alias("resp_dev")))


_EDITIONS = """SELECT CONCAT('SV', CAST(n_nationkey AS VARCHAR(4))) AS surv_id, CAST(50 + n_nationkey % 5 AS BIGINT) AS sample_n FROM nation"""


@query("sample_size_check", f"""
WITH e AS ({_EDITIONS}), c AS (SELECT CONCAT('SV', CAST(c_nationkey AS VARCHAR)) AS surv_id, COUNT(*) AS n FROM customer GROUP BY c_nationkey)
SELECT e.surv_id, e.sample_n, COALESCE(c.n, 0) AS n FROM e LEFT JOIN c ON e.surv_id = c.surv_id WHERE COALESCE(c.n, 0) <> e.sample_n""")
def sizes(x):
    rows = x.sql("SELECT CONCAT('SV', CAST(c_nationkey AS VARCHAR(4))) AS surv_id FROM customer")
    return v.sample_size_check(rows, x.sql(_EDITIONS))


@query("audit_values", oracle("""
SELECT DISTINCT 'status' AS varname, status AS value FROM raw WHERE status = 'P'
UNION ALL SELECT DISTINCT 'priority', priority FROM raw WHERE priority IN ('1-URGENT', '2-HIGH')"""))
def audited(x):
    allowed = x.sql("""SELECT 'status' AS varname, o_orderstatus AS value FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT 'priority', o_orderpriority FROM orders WHERE o_orderpriority > '3'""")
    return v.audit_values(x.view("raw"), allowed)


@query("audit_formats", oracle("""
SELECT DISTINCT 'date_text' AS varname, date_text AS value FROM raw WHERE date_text LIKE 'bad%'
UNION ALL SELECT DISTINCT 'code', CAST(code AS VARCHAR) FROM raw WHERE code >= 10"""))
def formats(x):
    return v.audit_formats(x.view("raw"), {"date_text": r"^\d{4}-", "code": r"^\d$", "absent": "x"})


# a DSD that does not fit the types of the raw data
_TYPES = """SELECT 'status' AS concept_id, CASE WHEN COUNT(o_orderstatus) > 0 THEN 'integer' ELSE 'codelist' END AS constraint_type FROM orders
UNION ALL SELECT 'price', CASE WHEN MAX(o_totalprice) > 0 THEN 'character' ELSE 'numeric' END FROM orders
UNION ALL SELECT 'priority', CASE WHEN COUNT(o_orderpriority) > 0 THEN 'character' ELSE 'date' END FROM orders"""


@query("class_check", oracle(f"""SELECT concept_id, CASE concept_id WHEN 'status' THEN 'string' ELSE 'double' END AS actual, constraint_type AS allowed
FROM ({_TYPES}) t WHERE concept_id <> 'priority'"""))
def classes(x):
    none = F.lit(None).cast("string")
    dsd = x.sql(_TYPES).select("concept_id", "constraint_type", none.alias("constraint_codelist"), none.alias("constraint_regex"), none.alias("constraint_min"),
                               none.alias("constraint_max"), F.lit(True).alias("constraint_allow_missings"))
    return v.class_check(x.view("raw"), dsd)


_SOUND = """SELECT o_orderkey AS row_id, o_orderstatus AS status, o_totalprice AS price, CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS day FROM orders"""
_SOUND_DSD = [(1, "day", "date", None, False), (2, "price", "numeric", None, False), (3, "status", "codelist", "status", False), (4, "row_id", "integer", None, False)]


@query("revalidation", oracle("""SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_totalprice AS price, o_orderstatus AS status, CAST(o_orderkey AS INT) AS row_id FROM orders"""))
def revalidated(x):
    """Checked, written by status, read back and checked again, columns in the order of the DSD."""
    none = F.lit(None)
    dsd = x.spark.createDataFrame(_SOUND_DSD, "pos int, concept_id string, constraint_type string, constraint_codelist string, constraint_allow_missings boolean")
    dsd = dsd.withColumns({"constraint_regex": none.cast("string"), "constraint_min": none.cast("double"), "constraint_max": none.cast("double")})
    lists = x.sql("SELECT DISTINCT 'status' AS codelist, o_orderstatus AS value, CAST(NULL AS DOUBLE) AS valuen FROM orders")
    path = x.folder()
    write_partitioned(v.validate(x.sql(_SOUND), dsd, lists), path, ["status"])
    again = v.validate(x.spark.read.parquet(path), dsd, lists)
    if again.columns != [row[1] for row in _SOUND_DSD]:
        raise v.ValidationError(f"columns are not in the order of the DSD: {again.columns}")
    return again.withColumn("day", F.col("day").cast("string"))


def _concept_rows(x):
    rows = [(i, c.concept_id, c.kind, c.codelist, c.regex, c.minimum, c.maximum, c.allow_missings) for i, c in enumerate(CONCEPTS)]
    return x.spark.createDataFrame(rows, "pos int, concept_id string, constraint_type string, constraint_codelist string, constraint_regex string, "
                                         "constraint_min double, constraint_max double, constraint_allow_missings boolean")


@query("refused_version", oracle(f"WITH lists AS ({_LISTS}),\nfound AS (" + "\nUNION ALL ".join([_MISSING, _RANGE, _DATES, _REGEX, _LISTED]) + """)
SELECT concept_id, rule, CAST(SUM(n) AS BIGINT) AS n, CAST(0 AS BIGINT) AS versions FROM found GROUP BY concept_id, rule"""))
def refused(x):
    """Publishing rows that break rules: what the writing pass counted, and the number of versions left behind."""
    path = x.folder()
    try:
        publish_checked(x.view("raw"), _concept_rows(x), x.sql(_LISTS), path)
    except v.ValidationError as error:
        left = versions.commits(x.spark, path).count()
        return x.spark.createDataFrame([(c, rule, n, left) for (c, rule), n in error.found.items()], "concept_id string, rule string, n long, versions long")
    raise AssertionError("a version with broken rules was published")


_SOUND_RAW = """FROM raw WHERE priority NOT LIKE '5%' AND price BETWEEN 5000 AND 450000 AND date_text NOT LIKE 'bad%' AND moment_text NOT LIKE '%25:00:00'
  AND status <> 'P' AND code < 10"""


@query("published_checked", oracle(f"""
WITH lists AS ({_LISTS}), sound AS (SELECT * {_SOUND_RAW})
SELECT CAST(row_id AS INT) AS row_id, status, priority, price, date_text, STRFTIME(CAST(REPLACE(moment_text, 'T', ' ') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS moment_text,
  l.value AS code FROM sound JOIN lists l ON l.codelist = 'code' AND l.valuen = sound.code"""))
def published(x):
    """Sound rows, checked while they are written by status, committed and read back."""
    path = x.folder()
    publish_checked(x.sql("SELECT * " + _SOUND_RAW), _concept_rows(x), x.sql(_LISTS), path, ["status"])
    return versions.read_version(x.spark, path).withColumns({"date_text": F.col("date_text").cast("string"),
                                                             "moment_text": F.date_format("moment_text", "yyyy-MM-dd HH:mm:ss")})
