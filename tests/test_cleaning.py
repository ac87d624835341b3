"""Batteries, filters, overlays, merging."""

import itertools

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import cleaning
from tallyloom.operators.batteries import FilteredQuestion, clean_battery, clean_filtered, clean_filters
from tallyloom.operators.joins import JoinError, coalesce_join, left_join_many, recode_overlay

VALUES = ["yes", "no", "dkn", None]


def battery_by_hand(options, dk, none, with_none):
    """The battery rules for one row."""
    ticked = "yes" in options
    out = []
    for o in options:
        if o == "yes":
            out.append("yes")
        elif dk == "yes":
            out.append("dkn")
        elif with_none and none == "yes":
            out.append("no")
        else:
            out.append("no" if ticked else None)
    dk_out = "yes" if dk == "yes" else "no" if ticked or (with_none and none == "yes") else None
    none_out = "no" if ticked else "dkn" if dk == "yes" else "yes" if none == "yes" else None
    return (*out, dk_out, none_out if with_none else none)


@pytest.mark.parametrize("with_none", [True, False])
def test_battery_truth_table(spark, with_none):
    table = list(itertools.product(VALUES, repeat=4))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(table)], "id int, a string, b string, dk string, none string")
    got = clean_battery(df, ["a", "b", "absent"], "dk", "none" if with_none else None).collect()
    for r in got:
        a, b, dk, none = table[r["id"]]
        assert (r["a"], r["b"], r["dk"], r["none"]) == battery_by_hand([a, b], dk, none, with_none), table[r["id"]]


def test_battery_without_its_columns_is_left_alone(spark):
    df = spark.createDataFrame([("no",)], "a string")
    assert clean_battery(df, ["a"], "dk") is df
    assert clean_battery(df, ["x"], "a") is df


def test_filter_on_true_false_unknown(spark, rows):
    df = spark.createDataFrame([(1, True, "v"), (2, False, "v"), (3, None, "v")], "id int, c boolean, q string")
    assert rows(clean_filtered(df, ["q"], F.col("c")), "id", "q") == [(1, "v"), (2, "na"), (3, None)]
    assert rows(clean_filtered(df, ["q"], F.col("c"), na_as_false=True), "id", "q") == [(1, "v"), (2, "na"), (3, "na")]
    assert clean_filtered(df, ["absent"], F.col("c")) is df


def test_filters_see_earlier_results_and_need_their_columns(spark, rows):
    df = spark.createDataFrame([("no", "yes", "text"), ("yes", "yes", "text")], "go string, q string, t string")
    out = clean_filters(df, [FilteredQuestion(("q",), ("go",), ("yes",)),
                             FilteredQuestion(("t",), ("q",), ("na",), negate=True, na_value="")])
    assert rows(out) == [("no", "na", ""), ("yes", "yes", "text")]
    with pytest.raises(ValueError, match="needs columns"):
        clean_filters(df, [FilteredQuestion(("q",), ("gone",), ("yes",))])


def test_coalesce_join_checks(spark, rows):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "y"), (None, "c", "z")], "id int, v string, w string")
    fix = spark.createDataFrame([(1, None, "new"), (None, "null key", None)], "id int, v string, w string")
    assert rows(coalesce_join(df, fix, ["id"])) == [(1, "a", "new"), (2, "b", "y"), (None, "null key", "z")]
    with pytest.raises(JoinError, match="not there: x"):
        coalesce_join(df, fix.withColumn("x", F.lit(1)), ["id"])
    with pytest.raises(JoinError, match="not there: 5000") as caught:
        coalesce_join(df, spark.range(10, 5010).select(F.col("id").cast("int"), F.lit("a").alias("v")), ["id"])
    assert caught.value.offenders.distinct().count() == 5000


def test_conflicting_corrections_are_an_error(spark, rows):
    df = spark.createDataFrame([(1, "a", "b")], "id int, v string, w string")
    fixes = lambda *r: spark.createDataFrame(list(r), "id int, variable string, value string")
    assert rows(recode_overlay(df, fixes((1, "v", "x"), (1, "v", "x")), "id", ["v", "w"])) == [(1, "x", "b")]
    with pytest.raises(JoinError, match="two ways: 1"):
        recode_overlay(df, fixes((1, "v", "x"), (1, "v", "y")), "id", ["v", "w"])
    with pytest.raises(Exception, match="two ways"):
        recode_overlay(df, fixes((1, "v", "x"), (1, "v", "y")), "id", ["v", "w"], check=False).collect()


def test_negated_filter_with_two_answers(spark, rows):
    asked = FilteredQuestion(("q",), ("k",), ("a", "b"), negate=True)
    df = spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (3, "x", "c"), (4, "x", None)], "id int, q string, k string")
    assert rows(clean_filters(df, [asked]), "id", "q") == [(1, "na"), (2, "na"), (3, "x"), (4, None)]


def test_coalesce_join_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    fix = spark.createDataFrame([(1, "x", 2), (1, "y", 1)], "id int, v string, pos int")
    with pytest.raises(JoinError, match="corrected more than once"):
        coalesce_join(df, fix.drop("pos"), ["id"])
    assert rows(coalesce_join(df, fix, ["id"], duplicates="first", order=["pos"])) == [(1, "y")]
    assert rows(coalesce_join(df, fix.drop("pos"), ["id"], duplicates="expand")) == [(1, "x"), (1, "y")]


def test_coalesce_join_other_key_name(spark, rows):
    df = spark.createDataFrame([(1, 7, "a")], "id int, ref int, v string")
    fix = spark.createDataFrame([(1, "b")], "ref int, v string")
    assert rows(coalesce_join(df, fix, {"id": "ref"})) == [(1, 7, "b")]


def test_recode_overlay_casts_to_the_column(spark, rows):
    df = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "id int, n int, t string")
    long = spark.createDataFrame([(1, "n", "11"), (2, "t", "c")], "id int, variable string, value string")
    assert rows(recode_overlay(df, long, "id", ["n", "t"])) == [(1, 11, "a"), (2, 20, "c")]


def test_left_join_many_equals_a_left_join(spark, rows):
    left = spark.createDataFrame([(k, f"l{k}", "left") for k in [1, 2, None]], "k int, v string, both string")
    right = spark.createDataFrame([(1, i, "right") for i in range(50)] + [(None, 99, "right"), (5, 5, "right")], "k int, w int, both string")
    got = rows(left_join_many(left, right, ["k"]), "k", "v", "w", "both")
    want = [(1, "l1", i, "right") for i in range(50)] + [(None, "lNone", 99, "right"), (2, "l2", None, None)]
    assert got == sorted(want, key=repr)


def test_household_rules(spark, rows):
    df = spark.createDataFrame([
        (1, "yes", None, None, None, None), (2, None, None, None, None, None), (3, "no", None, "yes", 2, None), (4, None, "yes", None, 0, 0),
    ], "id int, hh_child string, hh_dk string, hh_alone string, nhh_nchld int, nhh_nadlt int").withColumn("nhh_nsnr", F.lit(None).cast("int"))
    got = rows(cleaning.correct_inconsistencies(df), "id", "hh_child", "hh_alone", "nhh_nchld", "nhh_nadlt", "nhh_nsnr")
    assert got == [(1, "yes", None, 0, 0, 0), (2, None, None, None, None, None), (3, "yes", "no", 2, 0, 0), (4, None, None, 0, 0, 0)]


def test_birth_year_bounds(spark, rows):
    df = spark.createDataFrame([(2006,), (2007,), (1904,), (1903,), (None,)], "bth_year int").withColumn("surv_year", F.lit(2024))
    assert rows(cleaning.fix_birth_year(df), "bth_year") == [(1904,), (2006,), (None,), (None,), (None,)]


def test_timers_carry_missing_forward(spark, rows):
    df = spark.createDataFrame([("2024-01-01 23:59:00", 30.5, 60.0, None)], "start string, a double, b double, c double")
    df = df.withColumn("start", F.to_timestamp("start"))
    out = cleaning.cumulative_timers(df, "start", ["a", "b", "c"]).select(*[F.col(c).cast("string") for c in ("start", "a", "b", "c")])
    assert rows(out) == [("2024-01-01", "2024-01-01 23:59:30.5", "2024-01-02 00:00:30.5", None)]


def test_multi_response(spark, rows):
    df = spark.createDataFrame([(1, "x", None, "y"), (2, None, None, None)], "id int, golf string, judo string, ski string")
    assert rows(cleaning.multi_response_concat(df, "id", ["golf", "judo", "ski"], "t")) == [(1, "golf; ski")]


def test_merge_prefers_later_sources(spark, rows):
    sample = spark.createDataFrame([(1, 1900), (2, 1900)], "pseudo_id int, surv_year int")
    survey = spark.createDataFrame([(1, "a"), (1, "b")], "pseudo_id int, q string")
    edition = spark.createDataFrame([("S1", "P1", 2024, "x")], "surv_id string, fw_period string, surv_year int, surv_semester string")
    contacts = spark.createDataFrame([("P1", "d")], "fw_period string, invitation string")
    out = cleaning.merge_sources(sample, survey, edition, contacts, "S1")
    assert rows(out, "surv_id", "pseudo_id", "q", "surv_year", "invitation") == [
        ("S1", 1, "a", 2024, "d"), ("S1", 1, "b", 2024, "d"), ("S1", 2, None, 2024, "d")]
