"""Missing-value logic, recodes, bands and text."""

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.bands import SCHEMES, age_band
from tallyloom.functions.nulls import any_of, filter_out, join_null_safe, row_sum
from tallyloom.functions.recode import recode_strict, replace_everywhere, replace_values
from tallyloom.functions.text import squish, title_case


def test_any_of_and_row_sum_are_three_valued(spark, rows):
    df = spark.createDataFrame([(1, "yes", None), (2, None, None), (3, "no", "no"), (4, "no", None)], "id int, a string, b string")
    got = rows(df.select("id", any_of([F.col("a") == "yes", F.col("b") == "yes"]).alias("x")))
    assert got == [(1, True), (2, None), (3, False), (4, None)]
    nums = spark.createDataFrame([(1, 2), (None, 2)], "a int, b int")
    assert rows(nums.select(row_sum([F.col("a"), F.col("b")]))) == [(3,), (None,)]


def test_filter_out_keeps_unknown(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    assert rows(filter_out(df, F.col("a") == 1)) == [(2,), (None,)]


def test_null_keys_match_and_stay_an_equi_join(spark, rows, plan):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([(None, "n"), ("a", "x")], "k string, w string")
    joined = join_null_safe(left, right, ["k"])
    assert rows(joined, "v", "w") == [(1, "n"), (2, "x"), (3, None)]
    assert "NestedLoop" not in plan(joined) and "Cartesian" not in plan(joined)


def test_join_name_clash(spark, rows):
    left = spark.createDataFrame([(1, "l")], "k int, v string")
    right = spark.createDataFrame([(1, "r")], "k int, v string")
    with pytest.raises(ValueError, match="both sides"):
        join_null_safe(left, right, ["k"])
    assert rows(join_null_safe(left, right, ["k"], prefer="right"), "v") == [("r",)]
    assert rows(join_null_safe(left, right, ["k"], prefer="left"), "v") == [("l",)]


def test_recodes(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert rows(df.select(replace_values(F.col("v"), {"a": None}))) == [("b",), (None,), (None,)]
    strict = recode_strict(F.col("v"), {"a": "x", None: None}, "v")
    with pytest.raises(Exception, match="no recode for value b"):
        df.select(strict).collect()
    assert rows(df.where("v = 'a' OR v IS NULL").select(strict)) == [("x",), (None,)]
    assert rows(replace_everywhere(df, {"b": "c"})) == [("a",), ("c",), (None,)]


@pytest.mark.parametrize("scheme", list(SCHEMES))
def test_every_age_falls_in_its_band(spark, scheme):
    breaks, labels = SCHEMES[scheme]
    got = {r[0]: r[1] for r in spark.range(-10, 121).select("id", age_band(F.col("id"), scheme)).collect()}
    for age, label in got.items():
        below = [i for i, b in enumerate(breaks) if b <= age]
        assert label == (labels[below[-1]] if below else None)


def test_band_labels():
    assert SCHEMES["agecat7from18"][1] == ["a18_24", "a25_34", "a35_44", "a45_54", "a55_64", "a65_74", "a75plus"]
    assert SCHEMES["agecat4from18"][1] == ["a18_34", "a35_49", "a50_64", "a65plus"]
    assert SCHEMES["agecat5yr"][1][-1] == "100+" and SCHEMES["agecat5yrfrom18"][1][0] == "18-24"


def test_text(spark, rows):
    df = spark.createDataFrame([("  SINT-niklaas  l'EAU d’or\t2a ",), (None,)], "t string")
    assert rows(df.select(title_case(squish(F.col("t"))))) == [("Sint-Niklaas L'eau D’or 2a",), (None,)]


def test_digests_of_compound_keys_differ(spark):
    from tallyloom.operators.identifiers import keyed_digest, pseudonymous_ids
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("\\N", "x"), ("-", "x")], "k string, l string")
    assert df.select(keyed_digest(["k", "l"], "s").alias("d")).distinct().count() == 5
    twice = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    out = pseudonymous_ids(twice, ["k"], "SV0001", "s")
    assert out.count() == 3 and out.select("resp_id").distinct().count() == 2


def test_published_keys_of_digits_keep_their_zeros(spark, tmp_path, rows):
    from tallyloom.sources.tables import publish_by_key, read_published
    df = spark.createDataFrame([("02000", 1, "x"), ("2000", 2, "y")], "area string, n int, v string")
    publish_by_key(df, str(tmp_path / "areas"), ["area"])
    assert rows(read_published(spark, str(tmp_path / "areas"), area="02000")) == [(1, "x")]
    assert rows(read_published(spark, str(tmp_path / "areas"), area="2000")) == [(2, "y")]


def test_separators_are_no_patterns(spark, rows):
    from tallyloom.operators.countries import multi_code_enrich
    lookup = spark.createDataFrame([("a", "A"), ("b", "B")], "code string, name string")
    df = spark.createDataFrame([("k", "a|b")], "key string, codes string")
    assert rows(multi_code_enrich(df, ["key"], "codes", lookup, "code", ["name"], sep="|"), "codes", "name") == [("a|b", "A|B")]


def test_queries_leave_the_views_of_the_session_alone(spark):
    import os
    if not os.path.isdir("/root/testdata/sf0.001"):
        return
    from tallyloom.workload.inputs import Inputs
    spark.createDataFrame([(1,)], "mine int").createOrReplaceTempView("orders")
    assert Inputs(spark, "/root/testdata/sf0.001").sql("SELECT COUNT(*) AS n FROM orders WHERE o_orderpriority LIKE '{%' OR TRUE").first()[0] == 1500
    assert spark.table("orders").columns == ["mine"]
    spark.catalog.dropTempView("orders")


def test_published_types_survive(spark, rows, tmp_path):
    from tallyloom.sources.tables import SchemaError, publish_by_key, read_published
    path = str(tmp_path / "areas")
    df = spark.createDataFrame([("2019", "02000", 1), ("2019", "2000", 2), ("2020", "02000", 3)], "version string, area string, n int")
    publish_by_key(df, path, ["version", "area"])
    assert rows(read_published(spark, path, version="2019")) == [(1, "02000"), (2, "2000")]
    assert rows(read_published(spark, path), "version", "area", "n") == [("2019", "02000", 1), ("2019", "2000", 2), ("2020", "02000", 3)]
    publish_by_key(df.where("n = 3").withColumn("label", F.lit("x")), path, ["version", "area"])
    assert rows(read_published(spark, path, area="02000"), "version", "n", "label") == [("2019", 1, None), ("2020", 3, "x")]
    with pytest.raises(SchemaError, match="another type: n"):
        publish_by_key(df.withColumn("n", F.col("n").cast("string")), path, ["version", "area"])


def test_versions_are_read_whole_or_not_at_all(spark, rows, tmp_path):
    from tallyloom.sources import versions as v
    from tallyloom.sources.tables import SchemaError
    path = str(tmp_path / "table")
    df = spark.createDataFrame([("02000", 1, "a"), ("2000", 2, None), (None, 3, "c")], "area string, n int, text string")
    assert v.latest(spark, path) is None
    with pytest.raises(SchemaError, match="no complete version"):
        v.read_version(spark, path)
    v.write_data(df, path, ["area"])                      # a writer that dies before its commit
    assert v.latest(spark, path) is None
    assert v.publish_version(df, path, ["area"]) == 1
    made = v.write_data(df.where("n > 1"), path, ["area"])  # another one, while readers go on
    assert rows(v.read_version(spark, path)) == rows(df)
    broken = df.withColumn("n", F.when(F.col("n") < 3, F.col("n")).otherwise(F.raise_error(F.lit("stop")).cast("int")))
    with pytest.raises(Exception, match="stop"):
        v.publish_version(broken, path, ["area"])
    assert v.latest(spark, path) == 1 and rows(v.read_version(spark, path, area="02000")) == [(1, "a")]
    assert rows(v.read_version(spark, path, area=None)) == [(3, "c")]
    assert v.commit(spark, path, made, 1) == 2
    with pytest.raises(v.Conflict):
        v.commit(spark, path, made, 1)
    assert rows(v.read_version(spark, path), "n") == [(2,), (3,)] and rows(v.read_version(spark, path, 1)) == rows(df)
    assert v.publish_version(df.where("n > 9"), path, ["area"]) == 3
    assert v.read_version(spark, path).count() == 0 and v.read_version(spark, path).schema == df.schema
    assert [tuple(r) for r in v.commits(spark, path).select("version", "n_rows").orderBy("version").collect()] == [(1, 3), (2, 2), (3, 0)]
    assert v.publish_version(df.select("n"), path) == 4 and rows(v.read_version(spark, path)) == [(1,), (2,), (3,)]
    with pytest.raises(SchemaError, match="no column: area"):
        v.read_version(spark, path, area="x")
