"""Margins and raking."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import margins as m
from tallyloom.operators import raking

COV = ["sex", "area"]
TARGETS = [("sex", "m", 0.5), ("sex", "f", 0.5), ("area", "a", 0.6), ("area", "b", 0.3), ("area", "c", 0.1)]


def _sample(spark, n=600):
    return spark.range(n).select(
        F.col("id").alias("k"), F.when(F.col("id") % 5 < 3, "m").otherwise("f").alias("sex"),
        F.when(F.col("id") % 7 < 2, "a").when(F.col("id") % 7 < 5, "b").otherwise("c").alias("area"))


def _targets(spark):
    return spark.createDataFrame(TARGETS, "covariate string, category string, p double")


def test_margins_sum_to_one_in_one_scan(spark, plan, tmp_path):
    _sample(spark).withColumn("sex", F.when(F.col("k") > 50, F.col("sex"))).write.parquet(str(tmp_path / "p"))
    out = m.population_margins(spark.read.parquet(str(tmp_path / "p")), COV)
    sums = {r["covariate"]: r["s"] for r in out.groupBy("covariate").agg(F.sum("p").alias("s")).collect()}
    assert sums == pytest.approx({"sex": 1.0, "area": 1.0})
    assert out.where("category IS NULL").count() == 0
    assert plan(out).count("FileScan") == 1


def test_weights_meet_the_targets(spark):
    rows = _sample(spark)
    w = raking.rake_weights(rows, _targets(spark), COV, "k")
    full = raking.attach_weights(rows, w, "k")
    got = {(r["covariate"], r["category"]): r["p"] for r in raking.weighted_margins(full, COV).collect()}
    assert got == pytest.approx({(c, k): p for c, k, p in TARGETS}, abs=1e-6)
    assert full.agg(F.avg("psweight")).first()[0] == pytest.approx(1.0)


def _by_hand(cells, cap, sweeps):
    """The same sweeps in a few lines of numpy; the cap is cut and rescaled until nothing changes."""
    keys, n = list(cells), np.array([cells[k] for k in cells], float)
    w, total = np.ones(len(n)), n.sum()
    goal = {(c, k): p for c, k, p in TARGETS}
    for _ in range(sweeps):
        for i, c in enumerate(COV):
            for cat in {k[i] for k in keys}:
                here = np.array([k[i] == cat for k in keys])
                w[here] *= goal[(c, cat)] * total / (n * w)[here].sum()
        for _ in range(5000):
            if w.max() <= cap * (1 + 1e-14):
                break
            w = np.minimum(w, cap)
            w *= total / (n * w).sum()
        w = np.minimum(w, cap)
    return dict(zip(keys, w))


@pytest.mark.parametrize("cap", [5.0, 1.8])
def test_cap_equals_cut_and_rescale(spark, cap):
    rows = _sample(spark)
    cells = raking.rake_cells(rows, _targets(spark), COV, cap=cap, tol=1e-7).collect()
    want = _by_hand({(r["sex"], r["area"]): r["n"] for r in cells}, cap, 200)
    assert {(r["sex"], r["area"]): r["psweight"] for r in cells} == pytest.approx(want, rel=1e-5)
    assert max(r["psweight"] for r in cells) <= cap * (1 + 1e-9)


def test_weights_that_do_not_settle_are_an_error(spark):
    with pytest.raises(raking.RakingError, match="after 2 sweeps"):
        raking.rake_cells(_sample(spark), _targets(spark), COV, cap=1.3, max_sweeps=2)


def test_only_covariates_of_both_tables_count(spark):
    sample = _sample(spark)
    some = _targets(spark).where("covariate = 'sex'")
    w = {(r["sex"], r["area"]): r["psweight"] for r in raking.rake_cells(sample, some, COV).collect()}
    assert min(w.values()) > 0 and len({round(x, 9) for (sex, _), x in w.items() if sex == "m"}) == 1
    with pytest.raises(raking.RakingError, match="no targets"):
        raking.rake_cells(sample, some, ["area"])
    with pytest.raises(raking.RakingError, match="without a target: area=c"):
        raking.rake_cells(sample, _targets(spark).where("category <> 'c'"), COV)


def test_many_cells_of_a_covariate_with_two_categories(spark):
    """A million cells: margins are aggregates of partial sums, so no task sees more rows than categories of its tasks."""
    rows = spark.range(1_000_000).select("id", F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("two"), (F.col("id") % 1000).cast("string").alias("many"),
                                         (F.col("id") % 997).cast("string").alias("more"))
    targets = spark.createDataFrame([("two", "a", 0.4), ("two", "b", 0.6)], "covariate string, category string, p double")
    cells = raking.rake_cells(rows, targets, ["two", "many", "more"], tol=1e-6)
    got = {r["two"]: r["w"] for r in cells.groupBy("two").agg(F.sum(F.col("n") * F.col("psweight")).alias("w")).collect()}
    assert got == pytest.approx({"a": 400_000, "b": 600_000})


def test_impossible_targets(spark):
    rows = _sample(spark)
    more = _targets(spark).union(spark.createDataFrame([("area", "z", 0.1)], "covariate string, category string, p double"))
    with pytest.raises(raking.RakingError, match="area=z"):
        raking.rake_cells(rows, more, COV)
    with pytest.raises(raking.RakingError, match="cap"):
        raking.rake_cells(rows, _targets(spark), COV, cap=1.0)
    assert raking.rake_cells(rows.where("k < 0"), _targets(spark), COV).count() == 0


def test_cell_weights_equal_row_weights(spark, rows):
    sample = _sample(spark).withColumn("resp_stat", F.when(F.col("k") % 3 > 0, "resp").otherwise("nonresp")).withColumn(
        "area", F.when(F.col("k") % 11 > 0, F.col("area")))
    frame = m.raking_frame(sample, COV, "k")
    by_row = raking.attach_weights(sample, raking.rake_weights(frame, _targets(spark), COV, "k"), "k")
    by_cell = raking.attach_cell_weights(sample, raking.rake_cells(frame, _targets(spark), COV), COV, F.col("resp_stat") == "resp")
    a, b = rows(by_row, "k", "psweight"), rows(by_cell, "k", "psweight")
    assert [(k, w is None) for k, w in a] == [(k, w is None) for k, w in b]
    assert [w for _, w in a if w] == pytest.approx([w for _, w in b if w])


def test_many_covariates_at_once(spark):
    names = [f"c{i}" for i in range(27)]
    rows = spark.range(64).select("id", *[F.when(F.col("id").bitwiseAND(1 << (i % 6)) > 0, "x").otherwise("y").alias(c) for i, c in enumerate(names)])
    targets = spark.createDataFrame([(c, k, p) for c in names for k, p in (("x", 0.6), ("y", 0.4))], "covariate string, category string, p double")
    cells = raking.rake_cells(rows, targets, names, tol=1e-3)
    assert cells.agg(F.sum(F.col("n") * F.col("psweight"))).first()[0] == pytest.approx(64)


def _jobs(spark, fn):
    """How many jobs a call starts."""
    spark.sparkContext.setJobGroup(name := f"count-{fn!r}", "")
    try:
        fn()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


@pytest.mark.parametrize("cap", [5.0, 2.2])
def test_raking_takes_few_jobs(spark, cap):
    rows, targets = _sample(spark), _targets(spark)
    assert _jobs(spark, lambda: raking.rake_cells(rows, targets, COV, cap=cap, tol=1e-9).collect()) <= 30


def test_newton_and_sweeps_agree(spark, monkeypatch):
    rows, targets = _sample(spark), _targets(spark)
    for cap in (5.0, 2.2):
        direct = {(r["sex"], r["area"]): r["psweight"] for r in raking.rake_cells(rows, targets, COV, cap=cap).collect()}
        with monkeypatch.context() as m_:
            m_.setattr(raking, "_newton", lambda *a: None)
            swept = {(r["sex"], r["area"]): r["psweight"] for r in raking.rake_cells(rows, targets, COV, cap=cap, tol=1e-9).collect()}
        assert direct == pytest.approx(swept, rel=1e-6)


def test_factors_far_from_one_and_margins_that_contradict(spark):
    """Rare categories with large shares need long steps; shares that cannot be met within the cap are approached in sweeps."""
    rows = spark.range(4000).select("id", F.when(F.col("id") % 400 == 0, "rare").otherwise("often").alias("a"),
                                    (F.col("id") % 7).cast("string").alias("b"))
    shares = [("a", "rare", 0.4), ("a", "often", 0.6)] + [("b", str(k), 1 / 7) for k in range(7)]
    targets = spark.createDataFrame(shares, "covariate string, category string, p double")
    cells = raking.rake_cells(rows, targets, ["a", "b"], cap=1e6)
    got = {r["a"]: r["w"] for r in cells.groupBy("a").agg(F.sum(F.col("n") * F.col("psweight")).alias("w")).collect()}
    assert got == pytest.approx({"rare": 1600, "often": 2400})
    low = raking.rake_cells(rows, targets, ["a", "b"], cap=5.0, tol=1e-4, max_sweeps=60)
    w = {r["a"]: r["psweight"] for r in low.collect()}
    assert w["rare"] == pytest.approx(5.0) and low.agg(F.sum(F.col("n") * F.col("psweight"))).first()[0] == pytest.approx(4000, rel=1e-3)
