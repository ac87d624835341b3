"""Corrections, batteries and filtered questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.recode import replace_everywhere
from ..operators import cleaning as c
from ..operators.batteries import Battery, FilteredQuestion, clean_batteries, clean_battery, clean_filtered, clean_filters
from ..operators.joins import coalesce_join, recode_overlay
from . import sqltext as t
from .inputs import oracle
from .registry import query

_DAY = lambda name: F.col(name).cast("string").alias(name)


@query("coalesce_join", oracle("""
SELECT row_id, pseudo_id, CASE WHEN row_id % 10 = 0 AND row_id % 20 <> 0 THEN 'phone' ELSE resp_mode END AS resp_mode,
  CAST(resp_date AS VARCHAR) AS resp_date, CASE WHEN row_id % 10 = 0 THEN 'corrected' ELSE resp_fwdisp END AS resp_fwdisp FROM responses"""))
def overlay(x):
    original = x.view("responses")
    corrections = original.where("row_id % 10 = 0").select(
        "row_id", F.when(F.col("row_id") % 20 != 0, "phone").alias("resp_mode"), F.lit("corrected").alias("resp_fwdisp"))
    return coalesce_join(original, corrections, ["row_id"]).withColumn("resp_date", F.col("resp_date").cast("string"))


@query("recode_overlay", oracle("""
SELECT row_id, CASE WHEN row_id % 3 = 0 THEN 'fixed' ELSE q1 END AS q1, CASE WHEN row_id % 5 = 0 THEN 'mended' ELSE q2 END AS q2, q3 FROM answers"""))
def long_overlay(x):
    answers = x.view("answers").select("row_id", "q1", "q2", "q3")
    ids = x.table("lineitem").select(F.col("l_orderkey").alias("row_id"))
    recodes = (ids.where("row_id % 3 = 0").select("row_id", F.lit("q1").alias("variable"), F.lit("fixed").alias("value"))
               .unionByName(ids.where("row_id % 5 = 0").select("row_id", F.lit("q2").alias("variable"), F.lit("mended").alias("value"))))
    return recode_overlay(answers, recodes, "row_id", ["q1", "q2"])


_PARTS = ", ".join(f"CASE WHEN q{i} = 'yes' THEN 'q{i}' END" for i in range(1, 8))


@query("multi_response_concat", oracle(f"""
SELECT row_id, CONCAT_WS('; ', {_PARTS}) AS text FROM answers WHERE CONCAT_WS('; ', {_PARTS}) <> ''"""))
def concat(x):
    ticked = x.view("answers").select("row_id", *[F.when(F.col(f"q{i}") == "yes", "x").alias(f"q{i}") for i in range(1, 8)])
    return c.multi_response_concat(ticked, "row_id", [f"q{i}" for i in range(1, 8)], "text")


@query("in_sample", oracle("""
SELECT row_id, pseudo_id FROM responses WHERE pseudo_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"""))
def semi(x):
    sample = x.table("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("pseudo_id"))
    return c.in_sample(x.view("responses").select("row_id", "pseudo_id"), sample)


@query("id_link", """
SELECT l_orderkey, l_linenumber, l_quantity, o_custkey AS pseudo_id FROM lineitem
LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l_orderkey = o_orderkey""")
def link(x):
    links = x.table("orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("pseudo_id"))
    return c.link_ids(x.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), links, "l_orderkey")


@query("replace_values", """
WITH r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' ELSE o_orderstatus END AS st,
  CASE o_custkey WHEN 7 THEN 70 WHEN 9 THEN NULL ELSE o_custkey END AS cust, o_orderpriority AS pr FROM orders)
SELECT o_orderkey, CASE st WHEN 'P' THEN NULL WHEN '5-LOW' THEN 'low' ELSE st END AS o_orderstatus, cust AS o_custkey,
  CASE pr WHEN 'P' THEN NULL WHEN '5-LOW' THEN 'low' ELSE pr END AS o_orderpriority FROM r""")
def replaced(x):
    df = x.table("orders").select("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")
    df = c.replace_in(df, {"o_orderstatus": {"F": "final"}, "o_custkey": {7: 70, 9: None}})
    return replace_everywhere(df, {"P": None, "5-LOW": "low"})


@query("source_coding", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'QR' WHEN o_orderstatus <> 'P' THEN 'URL' END AS source FROM orders""")
def coded(x):
    df = c.source_code(x.table("orders"), "source", [(F.col("o_orderpriority") == "1-URGENT", "QR"), (F.col("o_orderstatus") != "P", "URL")])
    return df.select("o_orderkey", "source")


@query("na_default", oracle("""
SELECT row_id, CASE WHEN COALESCE(q1, '999') = 'invalid' THEN '999' ELSE COALESCE(q1, '999') END AS q1 FROM answers"""))
def defaulted(x):
    return c.fill_missing(x.view("answers").select("row_id", "q1"), "q1", "999", {"invalid": "999"})


@query("drop_technical", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def dropped(x):
    return c.drop_technical(x.table("orders"), ["o_totalprice", "o_orderdate", "absent"])


_TIMES = ", ".join(f"STRFTIME(o_orderdate + TO_SECONDS({' + '.join(f't{j}' for j in range(1, i + 1))}), '%Y-%m-%d %H:%M:%S') AS t{i}" for i in range(1, 8))


@query("cumulative_timers", oracle(f"""
SELECT row_id, {_TIMES}, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS start FROM answers JOIN orders ON row_id = o_orderkey"""))
def timers(x):
    names = [f"t{i}" for i in range(1, 8)]
    starts = x.table("orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderdate").alias("start"))
    df = x.view("answers").select("row_id", *names).join(starts, "row_id")
    out = c.cumulative_timers(df, "start", names)
    return out.select("row_id", *[F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n) for n in names], _DAY("start"))


@query("merge_sample_survey", oracle("""
SELECT s.pseudo_id, 'SV0001' AS surv_id, sex, bth_year, r.row_id, resp_mode, CAST(resp_date AS VARCHAR) AS resp_date, 'P1' AS fw_period,
  CAST(2024 AS INT) AS surv_year, '1995-01-01' AS invitation, '1999-01-01' AS reminder_2
FROM sample s LEFT JOIN responses r ON s.pseudo_id = r.pseudo_id"""))
def merged(x):
    edition = x.spark.createDataFrame([("SV0001", "P1", 2024, "spring")], "surv_id string, fw_period string, surv_year int, surv_semester string")
    contacts = x.view("mailings").groupBy("fw_period").pivot("contact", ["invitation", "reminder_1", "reminder_2"]).agg(F.min("mail_date"))
    survey = x.view("responses").withColumn("fw_period", F.lit("P0"))
    out = c.merge_sources(x.view("sample").withColumn("surv_year", F.lit(1900)), survey, edition, contacts, "SV0001")
    return out.select("pseudo_id", "surv_id", "sex", "bth_year", "row_id", "resp_mode", _DAY("resp_date"), "fw_period",
                      "surv_year", _DAY("invitation"), _DAY("reminder_2"))


@query("fix_birth_year", oracle("""
SELECT pseudo_id, CASE WHEN 2024 - bth_year < 18 OR 2024 - bth_year > 90 THEN NULL ELSE bth_year END AS bth_year FROM sample"""))
def births(x):
    df = x.view("sample").select("pseudo_id", "bth_year", F.lit(2024).alias("surv_year"))
    return c.fix_birth_year(df, oldest=90).select("pseudo_id", "bth_year")


# household questions of a response; counts are missing where no line was recorded
_HOUSEHOLD = """SELECT row_id, q1 AS hh_child, q2 AS hh_partn, q3 AS hh_alone, q4 AS hh_dk,
  t5 % 3 AS nhh_nchld, t6 % 2 AS nhh_nadlt, t7 % 4 AS nhh_nsnr FROM answers"""
_ZERO = "CASE WHEN (hh_child = 'yes' OR hh_partn = 'yes' OR hh_alone = 'yes' OR hh_dk = 'yes') AND {0} IS NULL THEN 0 ELSE {0} END AS {0}"


@query("fix_household_counts", oracle(f"""
SELECT row_id, {_ZERO.format('nhh_nchld')}, {_ZERO.format('nhh_nadlt')}, {_ZERO.format('nhh_nsnr')} FROM ({_HOUSEHOLD}) h"""))
def counts(x):
    return c.fix_household_counts(x.sql(_HOUSEHOLD)).select("row_id", "nhh_nchld", "nhh_nadlt", "nhh_nsnr")


@query("household_consistency", oracle(f"""
WITH z AS (SELECT row_id, hh_child, hh_partn, hh_alone, hh_dk, {_ZERO.format('nhh_nchld')}, {_ZERO.format('nhh_nadlt')}, {_ZERO.format('nhh_nsnr')} FROM ({_HOUSEHOLD}) h)
SELECT row_id, hh_partn, hh_dk, nhh_nchld, nhh_nadlt, nhh_nsnr, CASE WHEN nhh_nchld > 0 THEN 'yes' ELSE hh_child END AS hh_child,
  CASE WHEN nhh_nchld > 0 OR nhh_nadlt > 0 OR nhh_nsnr > 0 THEN 'no' ELSE hh_alone END AS hh_alone FROM z"""))
def consistent(x):
    return c.correct_inconsistencies(x.sql(_HOUSEHOLD))


_OPTIONS = ["q1", "q2", "q3", "q4"]


@query("cata", oracle(f"SELECT {t.select(t.battery(_OPTIONS, 'q5'), ['row_id', 'q6'])} FROM answers"))
def cata(x):
    df = x.view("answers").select("row_id", *_OPTIONS, "q5", "q6")
    return clean_battery(df, [*_OPTIONS, "absent"], "q5", none="not_there")


@query("cata_none", oracle(f"SELECT {t.select(t.battery(_OPTIONS, 'q5', 'q6'), ['row_id'])} FROM answers"))
def cata_none(x):
    return clean_battery(x.view("answers").select("row_id", *_OPTIONS, "q5", "q6"), _OPTIONS, "q5", "q6")


@query("batteries", oracle(f"""
SELECT {t.select({**t.battery(['q1', 'q2'], 'q3', 'q4'), **t.battery(['q5', 'q6'], 'q7')}, ['row_id'])} FROM answers"""))
def batteries(x):
    df = x.view("answers").select("row_id", *[f"q{i}" for i in range(1, 8)])
    return clean_batteries(df, [Battery(("q1", "q2"), "q3", "q4"), Battery(("q5", "q6"), "q7"), Battery(("z1",), "z2")])


@query("filtered", oracle(f"SELECT row_id, {t.filtered('q1', chr(39) + 'yes' + chr(39) + ' = q7')} AS q1, "
                          f"{t.filtered('q2', chr(39) + 'yes' + chr(39) + ' = q7')} AS q2, q7 FROM answers"))
def filtered(x):
    return clean_filtered(x.view("answers").select("row_id", "q1", "q2", "q7"), ["q1", "q2", "absent"], F.col("q7") == "yes")


_F1 = t.filtered("q1", "f1 = 'yearly' OR f1 = 'monthly' OR f1 = 'weekly' OR f1 = 'daily'")


@query("filters_in_order", oracle(f"""
WITH a AS (SELECT row_id, f1, {_F1} AS q1, q2, q3, q4, q5 FROM answers)
SELECT row_id, f1, q1, {t.filtered('q2', "q1 <> 'na'", '')} AS q2, {t.filtered('q3', "q4 = 'yes' OR q5 = 'yes'")} AS q3, q4, q5 FROM a"""))
def ordered_filters(x):
    df = x.view("answers").select("row_id", "f1", "q1", "q2", "q3", "q4", "q5")
    return clean_filters(df, [
        FilteredQuestion(("q1",), ("f1",), ("yearly", "monthly", "weekly", "daily")),
        FilteredQuestion(("q2",), ("q1",), ("na",), negate=True, na_value=""),
        FilteredQuestion(("q3",), ("q4", "q5"), ("yes",)),
        FilteredQuestion(("absent",), ("nothing",), ("yes",)),
    ])
