"""Response behaviour, disposition, waves and double responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import identifiers
from ..operators import responses as r
from ..operators.responses import Question
from . import sqltext as t
from .inputs import oracle
from .registry import query

QUESTIONS = [f"q{i}" for i in range(1, 8)]
DEMOGRAPHICS = ["q1", "q2", "q3"]
PROGRESS = [Question(q, round((i + 1) / 7, 3), QUESTIONS[i + 1] if i < 6 else None) for i, q in enumerate(QUESTIONS)]

# question registry of many editions: one questionnaire per brand, in part order
_VARIABLES = """SELECT p_brand AS surv_id, p_partkey AS pos,
  CASE WHEN p_partkey % 17 = 0 THEN CONCAT('c', CAST(p_partkey AS VARCHAR(20)), '_text') ELSE CONCAT('c', CAST(p_partkey AS VARCHAR(20))) END AS concept_id FROM part"""
_MODULES = """SELECT CASE WHEN p_partkey % 17 = 0 THEN CONCAT('c', CAST(p_partkey AS VARCHAR(20)), '_text') ELSE CONCAT('c', CAST(p_partkey AS VARCHAR(20))) END AS concept_id,
  p_type AS question_module FROM part WHERE p_size > 5"""


@query("question_progress", f"""
WITH k AS (SELECT v.* FROM ({_VARIABLES}) v JOIN ({_MODULES}) m ON v.concept_id = m.concept_id WHERE v.concept_id NOT LIKE '%\\_text' ESCAPE '\\')
SELECT surv_id, concept_id, ROUND_EVEN(CAST(ROW_NUMBER() OVER w AS DOUBLE) / COUNT(*) OVER (PARTITION BY surv_id), 3) AS resp_pct,
  LEAD(concept_id) OVER w AS resp_drop FROM k WINDOW w AS (PARTITION BY surv_id ORDER BY pos)""")
def progress(x):
    return r.question_progress(x.sql(_VARIABLES), x.sql(_MODULES), by=["surv_id"])


_LONG = "\nUNION ALL ".join(f"SELECT row_id, '{q}' AS concept_id, {t.behaviour(q)} AS behavior FROM answers" for q in QUESTIONS)


@query("answer_behavior", oracle(_LONG))
def behaviour(x):
    return r.answer_behaviour(x.view("answers"), "row_id", QUESTIONS)


@query("response_rates", oracle(f"""
SELECT row_id, CAST(BOOL_OR(concept_id = 'q1' AND behavior = 'respons') AND BOOL_OR(concept_id = 'q2' AND behavior = 'respons')
  AND BOOL_OR(concept_id = 'q3' AND behavior = 'respons') AS INT) AS resp_demo,
  ROUND(COUNT(*) FILTER (WHERE behavior = 'respons') / CAST(COUNT(*) AS DOUBLE), 6) AS resp_share FROM ({_LONG}) l GROUP BY row_id"""))
def rates(x):
    out = r.response_rates(r.answer_behaviour(x.view("answers"), "row_id", QUESTIONS), "row_id", DEMOGRAPHICS)
    return out.select("row_id", F.col("resp_demo").cast("int").alias("resp_demo"), F.round("resp_share", 6).alias("resp_share"))


_PROGRESS = " UNION ALL ".join(
    f"SELECT '{p.concept_id}' AS concept_id, {p.pct} AS resp_pct, {repr(p.following) if p.following else 'NULL'} AS resp_drop" for p in PROGRESS)


@query("dropout", oracle(f"""
SELECT row_id, CAST(resp_pct AS DOUBLE) AS resp_pct, resp_drop FROM (SELECT row_id, p.resp_pct, p.resp_drop, RANK() OVER (PARTITION BY row_id ORDER BY p.resp_pct DESC) AS k
  FROM ({_LONG}) l JOIN ({_PROGRESS}) p ON l.concept_id = p.concept_id WHERE behavior <> 'no respons') z WHERE k = 1"""))
def dropped_out(x):
    table = x.spark.createDataFrame([(p.concept_id, p.pct, p.following) for p in PROGRESS], "concept_id string, resp_pct double, resp_drop string")
    return r.drop_out(r.answer_behaviour(x.view("answers"), "row_id", QUESTIONS), table, "row_id")


def _joined(x):
    """Responses with their answers; some responses have none."""
    return x.sql("SELECT r.*, q1, q2, q3, q4, q5, q6, q7 FROM responses r LEFT JOIN answers a ON r.row_id = a.row_id")


_JOINED = "(SELECT r.*, q1, q2, q3, q4, q5, q6, q7 FROM responses r LEFT JOIN answers a ON r.row_id = a.row_id) j"
_KEEP = ["row_id", "pseudo_id", "resp_mode", "resp_date", "resp_fwdisp"]
_PROFILE = t.profile(QUESTIONS, DEMOGRAPHICS, _JOINED, _KEEP)


@query("response_profile", oracle(f"""
SELECT row_id, CAST(resp_demo AS INT) AS resp_demo, ROUND(resp_share, 6) AS resp_share, resp_pct, resp_drop FROM ({_PROFILE}) p"""))
def profile(x):
    out = r.response_profile(_joined(x), PROGRESS, DEMOGRAPHICS)
    return out.select("row_id", F.col("resp_demo").cast("int").alias("resp_demo"), F.round("resp_share", 6).alias("resp_share"), "resp_pct", "resp_drop")


def _statuses(x):
    return r.status(r.disposition(r.response_profile(_joined(x), PROGRESS, DEMOGRAPHICS)))


_DISP = f"SELECT *, {t.STATUS} AS resp_stat FROM (SELECT * REPLACE (COALESCE(resp_pct, 0) AS resp_pct), {t.DISPOSITION} AS resp_disp FROM ({_PROFILE}) p) d"


@query("disposition", oracle(f"SELECT row_id, resp_pct, resp_disp FROM ({_DISP}) s"))
def disposed(x):
    return r.disposition(r.response_profile(_joined(x), PROGRESS, DEMOGRAPHICS)).select("row_id", "resp_pct", "resp_disp")


@query("resp_stat", oracle(f"SELECT row_id, resp_disp, resp_stat FROM ({_DISP}) s"))
def statuses(x):
    return _statuses(x).select("row_id", "resp_disp", "resp_stat")


@query("response_wave", oracle(f"""
SELECT row_id, {t.WAVE} AS resp_time FROM responses, (SELECT DATE '1995-06-01' AS invitation, DATE '1997-01-01' AS reminder_1, DATE '1999-01-01' AS reminder_2) m"""))
def wave(x):
    dates = {"invitation": "1995-06-01", "reminder_1": "1997-01-01", "reminder_2": "1999-01-01"}
    df = x.view("responses").withColumns({k: F.lit(v).cast("date") for k, v in dates.items()})
    return r.response_wave(df).select("row_id", "resp_time")


@query("row_id", """
SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (ORDER BY SHA256(CONCAT('row', '|', LENGTH(CAST(o_orderkey AS VARCHAR)), ':', CAST(o_orderkey AS VARCHAR)))) AS row_id FROM orders""")
def numbered(x):
    return identifiers.row_ids(x.table("orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])


@query("dedupe_responses", oracle(f"""
SELECT row_id, pseudo_id, resp_stat, resp_pct, CAST(resp_date AS VARCHAR) AS resp_date
FROM (SELECT *, {t.BEST} AS k FROM ({_DISP}) s) z WHERE k = 1"""))
def deduped(x):
    return r.dedupe_responses(_statuses(x)).select("row_id", "pseudo_id", "resp_stat", "resp_pct", F.col("resp_date").cast("string").alias("resp_date"))


@query("dedupe_history", oracle(f"""
WITH s AS ({_DISP}),
h AS (SELECT pseudo_id, COUNT(*) AS resp_n, STRING_AGG(resp_mode, ' + ' ORDER BY CASE resp_mode WHEN 'online' THEN 1 ELSE 2 END) AS resp_type FROM s GROUP BY pseudo_id),
b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY pseudo_id ORDER BY CASE WHEN resp_stat = 'resp' THEN 1 ELSE 0 END DESC, resp_pct DESC, resp_date DESC NULLS LAST, row_id) AS k FROM s)
SELECT row_id, b.pseudo_id, resp_stat, resp_n, resp_type FROM b JOIN h ON b.pseudo_id = h.pseudo_id WHERE k = 1"""))
def history(x):
    return r.dedupe_with_history(_statuses(x), "pseudo_id", "row_id").select("row_id", "pseudo_id", "resp_stat", "resp_n", "resp_type")


@query("module_shares", oracle(f"""
SELECT row_id, ROUND(COUNT(*) FILTER (WHERE concept_id <= 'q3' AND behavior <> 'no respons') / 3.0, 6) AS p_socdem,
  ROUND(COUNT(*) FILTER (WHERE concept_id > 'q3' AND behavior = 'respons') / 4.0, 6) AS p_other FROM ({_LONG}) l GROUP BY row_id"""))
def modules(x):
    parts = x.spark.createDataFrame([(q, "socdem" if q <= "q3" else "other") for q in QUESTIONS], "concept_id string, part string")
    out = r.module_shares(r.answer_behaviour(x.view("answers"), "row_id", QUESTIONS), parts, "row_id")
    return out.select("row_id", F.round("p_socdem", 6).alias("p_socdem"), F.round("p_other", 6).alias("p_other"))
