"""The driver's tables and the survey tables derived from them by SQL that Spark and DuckDB share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Answers are numbered in alphabetical order, so that the greatest number is the greatest text; numbers
# can be aggregated by hashing, texts only by sorting.
_CHOICES = ["dkn", "invalid", "no", "yes"]
_FREQUENCIES = ["daily", "dkn", "monthly", "never", "weekly", "yearly"]


def _greatest(codes: list[str], flag: str, i: int, name: str) -> str:
    names = " ".join(f"WHEN {k + 1} THEN '{c}'" for k, c in enumerate(codes))
    return f"CASE MAX(CASE WHEN l_linenumber = {i} THEN {flag} END) {names} END AS {name}{i}"


_Q = ", ".join(_greatest(_CHOICES, "a", i, "q") for i in range(1, 8))
_F = ", ".join(_greatest(_FREQUENCIES, "f", i, "f") for i in range(1, 8))
_T = ", ".join(f"CAST(MAX(CASE WHEN l_linenumber = {i} THEN l_quantity END) AS INT) AS t{i}" for i in range(1, 8))
_FREQ = "CASE CAST(l_quantity AS INT) % 6 WHEN 0 THEN 1 WHEN 1 THEN 5 WHEN 2 THEN 3 WHEN 3 THEN 6 WHEN 4 THEN 4 ELSE 2 END"

VIEWS: dict[str, str] = {
    # one sampled person per customer
    "sample": """
SELECT c_custkey AS pseudo_id,
  CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex,
  CAST(1930 + c_custkey % 80 AS INT) AS bth_year,
  n_name AS geo_lvl4, r_name AS geo_lvl2,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 11 < 8 THEN 'home'
       WHEN c_custkey % 11 < 10 THEN 'eu' ELSE 'noteu' END AS natltygrp
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    # responses; a person may have many
    "responses": """
SELECT o_orderkey AS row_id, o_custkey AS pseudo_id,
  CASE o_orderstatus WHEN 'P' THEN 'paper' ELSE 'online' END AS resp_mode,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS resp_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'unreach' WHEN '2-HIGH' THEN 'late' ELSE 'answer' END AS resp_fwdisp
FROM orders""",
    # answers of a response: choices q1-q7, frequencies f1-f7, seconds t1-t7
    "answers": f"""
SELECT l_orderkey AS row_id, {_Q}, {_F}, {_T}
FROM (SELECT l_orderkey, l_linenumber, l_quantity,
        CASE WHEN l_returnflag = 'R' THEN 4 WHEN l_returnflag = 'N' THEN 3 WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS a,
        {_FREQ} AS f
      FROM lineitem) t
GROUP BY l_orderkey""",
    "register": """
SELECT c_nationkey AS CD_REFNIS, CAST(1 + c_custkey % 3 AS INT) AS CD_SEX,
  CAST(10 + c_custkey % 90 AS INT) AS MS_AGE, CAST(c_custkey % 25 AS INT) AS CD_NATLTY, c_custkey
FROM customer""",
    # municipalities in scope with their province, and nationality codes with their group
    "areas": """
SELECT n_nationkey AS value, r_name AS target_value FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE n_nationkey < 22""",
    "nationalities": """
SELECT n_nationkey AS value, CASE WHEN n_regionkey = 3 THEN 'home' WHEN n_regionkey < 2 THEN 'eu' ELSE 'noteu' END AS target_value
FROM nation WHERE n_nationkey <> 7""",
    "questions": """
SELECT DISTINCT o_orderpriority AS concept_id,
  CONCAT('SV', LPAD(CAST(YEAR(o_orderdate) - 1994 AS VARCHAR(4)), 4, '0')) AS from_surv_id,
  CONCAT(o_orderpriority, ' v', CAST(YEAR(o_orderdate) AS VARCHAR(4))) AS varlabel
FROM orders WHERE (YEAR(o_orderdate) + LENGTH(o_orderpriority)) % 3 <> 0""",
    "mailings": """
SELECT 'P1' AS fw_period, contact, CAST(d AS DATE) AS mail_date
FROM (VALUES ('invitation','1995-01-01'),('reminder_1','1997-01-01'),('reminder_2','1999-01-01')) AS t(contact, d)""",
    # contacts per period, with missing and repeated ones
    "contact_log": """
SELECT CONCAT('P', CAST(c.c_nationkey AS VARCHAR(4)), '-', CAST(YEAR(o.o_orderdate) AS VARCHAR(4))) AS fw_period,
  CASE WHEN o.o_orderkey % 61 = 0 THEN 'invitation' WHEN o.o_orderkey % 61 = 1 THEN 'reminder_1'
       WHEN o.o_orderkey % 61 = 2 THEN 'reminder_2' ELSE 'other' END AS contact,
  CAST(o.o_orderdate AS DATE) AS date
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    # a list in which every area follows its ancestors
    "hierarchy": """
SELECT (CAST(r AS BIGINT) * 1000 + n + 1) * 1000000000000 + c + 1 AS pos, level, id
FROM (SELECT r_regionkey AS r, -1 AS n, CAST(-1 AS BIGINT) AS c, 0 AS level, r_name AS id FROM region
      UNION ALL SELECT n_regionkey, n_nationkey, CAST(-1 AS BIGINT), 1, n_name FROM nation
      UNION ALL SELECT n_regionkey, n_nationkey, c_custkey, 2, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey) t""",
    # members of areas in two versions: nations 6 and 7 merge, nation 8 leaves its region
    "area_members": """
SELECT c_custkey AS id, r_name AS v1lvl0, n_name AS v1lvl1,
  CASE WHEN n_nationkey = 8 THEN 'new region' ELSE CONCAT(r_name, ' 2') END AS v2lvl0,
  CASE WHEN n_nationkey IN (6, 7) THEN 'merged' WHEN n_nationkey = 9 THEN NULL ELSE CONCAT(n_name, ' 2') END AS v2lvl1
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "multicode": "SELECT p_partkey AS valuen, REPLACE(p_name, ' ', ';') AS codes FROM part",
    # categories of single codes; some codes are unknown
    "code_lookup": """
SELECT w AS code, CONCAT('cat', CAST(LENGTH(w) % 2 AS VARCHAR(2))) AS cat, CONCAT('l', CAST(LENGTH(w) AS VARCHAR(4))) AS len
FROM (SELECT DISTINCT SPLIT_PART(p_name, ' ', 1) AS w FROM part
      UNION SELECT DISTINCT SPLIT_PART(p_name, ' ', 2) AS w FROM part) t WHERE LENGTH(w) <> 6""",
    # a data structure definition with every kind of mistake
    "dsd": """
SELECT CONCAT('c', CAST(CASE WHEN p_partkey % 10 = 9 THEN p_partkey - 1 ELSE p_partkey END AS VARCHAR(20))) AS concept_id,
  p_name AS label_nl, kind AS constraint_type,
  CASE WHEN kind = 'codelist' AND p_size % 4 <> 0 THEN CONCAT('cl_', p_type)
       WHEN kind = 'integer' AND p_size = 30 THEN 'cl_none' END AS constraint_codelist,
  CASE WHEN kind = 'character' AND p_size % 9 = 0 THEN '([a-z' WHEN kind = 'character' THEN '^[a-z]+$'
       WHEN kind = 'integer' AND p_size % 11 = 0 THEN 'x' END AS constraint_regex,
  CASE WHEN kind IN ('integer', 'numeric') THEN CAST(p_size AS DOUBLE) WHEN p_size = 49 THEN CAST(1 AS DOUBLE) END AS constraint_min,
  CASE WHEN kind IN ('integer', 'numeric') THEN CAST(p_size + p_partkey % 5 - 1 AS DOUBLE) WHEN p_size = 48 THEN CAST(1 AS DOUBLE) END AS constraint_max,
  p_partkey % 2 = 0 AS constraint_allow_missings
FROM (SELECT part.*, CASE p_partkey % 7 WHEN 0 THEN 'character' WHEN 1 THEN 'date' WHEN 2 THEN 'datetime' WHEN 3 THEN 'codelist'
        WHEN 4 THEN 'codelist' WHEN 5 THEN 'integer' ELSE CASE WHEN p_size % 5 = 0 THEN 'text' ELSE 'numeric' END END AS kind
      FROM part) t""",
    # code lists per part type, in order of their values
    "dsd_codelists": """
SELECT codelist, value, CAST(ROW_NUMBER() OVER (PARTITION BY codelist ORDER BY value) AS BIGINT) AS pos,
  CAST(LENGTH(value) AS DOUBLE) / 4 AS valuen
FROM (SELECT DISTINCT CONCAT('cl_', p_type) AS codelist, p_brand AS value FROM part WHERE p_type <> 'PROMO') t""",
    # raw data with mistakes for the validation rules
    "raw": """
SELECT o_orderkey AS row_id, o_orderstatus AS status,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderpriority END AS priority, o_totalprice AS price,
  CASE WHEN o_orderkey % 40 = 0 THEN CONCAT('bad-', CAST(o_orderkey % 100 AS VARCHAR(4))) ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) END AS date_text,
  CONCAT(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), CASE WHEN o_orderkey % 45 = 0 THEN ' 25:00:00' WHEN o_orderkey % 2 = 0 THEN 'T10:00:00' ELSE ' 23:59:59' END) AS moment_text,
  CAST(o_custkey % 12 AS INT) AS code
FROM orders""",
    # skeleton of code lists: membership flags per value
    "skeleton": """
SELECT value, CAST(MIN(k) AS DOUBLE) AS valuen, BOOL_OR(a) AS a, BOOL_OR(b) AS b, BOOL_OR(c) AS c, BOOL_OR(d) AS d
FROM (SELECT p_brand AS value, p_partkey AS k, p_size > 10 AS a, p_size > 48 AS b, p_partkey % 50 = 7 AS c,
        p_partkey % 50 = 7 AND p_size > 25 AS d FROM part) t
GROUP BY value""",
    "code_values": """
SELECT DISTINCT p_brand AS value, CONCAT('nl ', p_brand) AS label_nl, CONCAT('fr ', p_brand) AS label_fr
FROM part WHERE p_brand <> 'Brand#7'""",
    # frequencies of eleven activities per part
    "culture": "SELECT l_partkey AS id, " + ", ".join(
        f"CASE MAX(CASE WHEN l_suppkey % 11 = {i} THEN g END) WHEN 1 THEN 'daily' WHEN 2 THEN 'dkn' WHEN 3 THEN 'invalid' "
        f"WHEN 4 THEN 'monthly' WHEN 5 THEN 'never' WHEN 6 THEN 'weekly' WHEN 7 THEN 'yearly' END AS c{i}" for i in range(11)) + """
FROM (SELECT l_partkey, l_suppkey, CASE WHEN l_partkey % 3 = 0 THEN 5
        WHEN l_partkey % 3 = 1 THEN CASE WHEN CAST(l_quantity AS INT) % 9 = 0 THEN 2 ELSE 7 END
        ELSE CASE CAST(l_quantity AS INT) % 7 WHEN 0 THEN 1 WHEN 1 THEN 6 WHEN 2 THEN 4 WHEN 3 THEN 7 WHEN 4 THEN 5 WHEN 5 THEN 2 ELSE 3 END END AS g
      FROM lineitem) t GROUP BY l_partkey""",
}


def used_views(sql: str) -> list[str]:
    """Names of the derived tables a text mentions, in the order in which they are defined."""
    words = set(re.findall(r"\w+", sql))
    found = {v for v in VIEWS if v in words and re.search(rf"(FROM|JOIN|,)\s+{v}\b", sql)}
    for v in list(found):
        found |= set(used_views(VIEWS[v]))
    return [v for v in VIEWS if v in found]


def oracle(sql: str) -> str:
    """Prefix a text with the definitions of the derived tables it uses."""
    views = used_views(sql)
    if not views:
        return sql
    defs = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in views)
    body = sql.strip()
    return f"WITH {defs},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {defs}\n{body}"


class Inputs:
    """Tables of one scale factor, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run a text over the driver's tables and the derived ones."""
        full = oracle(text)
        names = [n for n in SCHEMAS if re.search(rf"\b{n}\b", full)]
        # the tables go in as arguments, so no view of the user's session is touched
        body = full.replace("{", "{{").replace("}", "}}")
        tables = ", ".join(f"{n} AS (SELECT * FROM {{{n}}})" for n in names)
        start = re.match(r"\s*WITH\s+", body)
        whole = f"WITH {tables}, {body[start.end():]}" if start else f"WITH {tables} {body}"
        return self.spark.sql(whole if names else body, **{n: self.table(n) for n in names})

    def view(self, name: str) -> DataFrame:
        return self.sql(VIEWS[name])

    def folder(self) -> str:
        """A new folder in the shared place, for queries that write."""
        return f"{shared_dir(self.spark).rstrip('/')}/written-{uuid.uuid4().hex}"
