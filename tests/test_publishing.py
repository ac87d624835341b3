"""Checks inside the pass that writes a version."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.validation import ValidationError, validate
from tallyloom.plans.publishing import Checked, publish_checked
from tallyloom.sources import versions

DSD = "concept_id string, constraint_type string, constraint_codelist string, constraint_regex string, constraint_min double, constraint_max double, " \
      "constraint_allow_missings boolean"


@pytest.fixture
def meta(spark):
    dsd = spark.createDataFrame([("id", "integer", None, None, 0.0, 1000.0, False), ("kind", "codelist", "kinds", None, None, None, True),
                                 ("level", "codelist", "levels", None, None, None, True)], DSD)
    lists = spark.createDataFrame([("kinds", "a", None), ("kinds", "b", None), ("levels", "low", 1.0), ("levels", "high", 2.0)], "codelist string, value string, valuen double")
    return dsd, lists


def _counted(spark, n):
    """A table of n rows, and how many of its rows have been computed so far."""
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch
    rows = spark.range(n).mapInArrow(count, "id long")
    return rows.select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("kind"), (F.col("id") % 2 + 1).alias("level")), passed


@pytest.mark.parametrize("keys", [(), ("kind",)])
def test_one_pass_checks_and_writes(spark, meta, tmp_path, rows, keys):
    df, passed = _counted(spark, 300)
    assert publish_checked(df, *meta, str(tmp_path / "t"), keys, n_rows=300) == 1
    assert passed.value == 300
    back = versions.read_version(spark, str(tmp_path / "t"))
    assert rows(back.where("id < 4"), "id", "kind", "level") == [(0, "a", "low"), (1, "b", "high"), (2, None, "low"), (3, "a", "high")]
    validate(df, *meta).count()
    assert passed.value > 600  # checks as jobs of their own read the table again


def test_a_refused_version_leaves_the_last_one(spark, meta, tmp_path, rows):
    path = str(tmp_path / "t")
    df, _ = _counted(spark, 30)
    publish_checked(df, *meta, path)
    bad = df.withColumns({"kind": F.when(F.col("id") == 4, "z").otherwise(F.col("kind")), "level": F.when(F.col("id") < 2, 7).otherwise(F.col("level")),
                          "id": F.when(F.col("id") == 9, 5000).when(F.col("id") != 8, F.col("id"))})
    with pytest.raises(ValidationError, match=r"id: max \(1 cells\)\nid: missing \(1 cells\)\nkind: codelist \(1 cells\)\nlevel: codelist \(2 cells\)") as caught:
        publish_checked(bad, *meta, path)
    assert rows(caught.value.offenders) == [("id", "max", None, 1), ("id", "missing", None, 1), ("kind", "codelist", "z", 1), ("level", "codelist", "7.0", 2)]
    with pytest.raises(ValidationError, match="30 rows, 31 expected"):
        publish_checked(df, *meta, path, n_rows=31)
    assert versions.latest(spark, path) == 1 and versions.read_version(spark, path).count() == 30
    assert publish_checked(df, *meta, path) == 2


def test_shape_is_checked_before_anything_is_read(spark, meta, tmp_path):
    df, passed = _counted(spark, 30)
    with pytest.raises(ValidationError, match="extra: column without concept"):
        publish_checked(df.withColumn("extra", F.lit(1)), *meta, str(tmp_path / "t"))
    with pytest.raises(ValidationError, match="id: class string"):
        publish_checked(df.withColumn("id", F.col("id").cast("string")), *meta, str(tmp_path / "t"))
    with pytest.raises(ValidationError, match="level: concept without column"):
        publish_checked(df.drop("level"), *meta, str(tmp_path / "t"))
    assert passed.value == 0


def test_empty_tables_and_lists(spark, meta, tmp_path):
    dsd, lists = meta
    empty = spark.createDataFrame([], "id long, kind string, level int")
    assert publish_checked(empty, dsd, lists, str(tmp_path / "t"), n_rows=0) == 1
    assert versions.read_version(spark, str(tmp_path / "t")).count() == 0
    df, _ = _counted(spark, 6)
    with pytest.raises(ValidationError, match=r"kind: codelist \(4 cells\)"):
        publish_checked(df, dsd, lists.where("codelist = 'levels'"), str(tmp_path / "u"))


def test_metrics_of_any_pass(spark):
    checked = Checked(spark.range(100), [("id", "odd", F.col("id") % 2 == 1), ("id", "none", F.col("id") < 0)])
    assert checked.df.agg(F.sum("id")).first()[0] == 4950
    assert checked.broken() == {("id", "odd"): 50}
