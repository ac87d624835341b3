"""Response behaviour, de-duplication, ordered helpers and identifiers."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import identifiers
from tallyloom.operators import responses as r
from tallyloom.operators.ordered import last_before, last_seen, number_rows, running_totals, splitters, with_blocks
from tallyloom.operators.ranking import slice_best
from tallyloom.operators.responses import Question

QS = [Question("a", 0.333, "b"), Question("b", 0.667, "c"), Question("c", 1.0, None)]


def _answers(spark):
    return spark.createDataFrame([
        (1, "yes", "dkn", None), (2, None, None, None), (3, "no", "no", "no"), (4, "invalid", None, "dkn"), (5, None, "x", ""),
    ], "id int, a string, b string, c string")


def test_row_and_long_form_agree(spark, rows):
    df = _answers(spark)
    wide = r.response_profile(df, QS, ["a", "b"])
    long = r.answer_behaviour(df, "id", ["a", "b", "c"])
    progress = spark.createDataFrame([(q.concept_id, q.pct, q.following) for q in QS], "concept_id string, resp_pct double, resp_drop string")
    rates = {k: (d, round(s, 6)) for k, d, s in rows(r.response_rates(long, "id", ["a", "b"]))}
    drops = {k: (p, n) for k, p, n in rows(r.drop_out(long, progress, "id"))}
    for row in wide.collect():
        if row["id"] == 2:  # nothing answered: all four are unknown
            assert (row["resp_demo"], row["resp_share"], row["resp_pct"], row["resp_drop"]) == (None, None, None, None)
            continue
        assert (row["resp_demo"], round(row["resp_share"], 6)) == rates[row["id"]]
        assert (row["resp_pct"], row["resp_drop"]) == drops[row["id"]]


def test_row_form_needs_no_shuffle(spark, plan):
    assert "Exchange" not in plan(r.response_profile(_answers(spark), QS, ["a"]))


def test_equal_shares_give_a_row_per_tie(spark, rows):
    tied = [Question("a", 0.5, "b"), Question("b", 1.0, "c"), Question("c", 1.0, None)]
    out = r.response_profile(_answers(spark).where("id = 3"), tied, ["a"])
    assert rows(out, "resp_pct", "resp_drop") == [(1.0, "c"), (1.0, None)]


def test_dispositions(spark, rows):
    cases = [
        (1, "late", True, 1.0, 1.0), (2, "answer", True, 0.8, 1.0), (3, "answer", True, 0.3, 1.0), (4, "answer", False, 0.9, 1.0),
        (5, "answer", True, 0.1, 0.4), (6, "answer", None, None, None), (7, None, True, 0.9, 1.0), (8, "incapble", None, None, None),
    ]
    df = spark.createDataFrame(cases, "id int, resp_fwdisp string, resp_demo boolean, resp_share double, resp_pct double")
    out = r.status(r.disposition(df))
    assert rows(out, "id", "resp_disp", "resp_stat") == [
        (1, "late", "nonresp"), (2, "full", "resp"), (3, "partial", "resp"), (4, "wrongrsp", "nonresp"), (5, "breakoff", "nonresp"),
        (6, "refusal", "nonresp"), (7, "full", "resp"), (8, "incapble", "nonresp")]


def test_wave_bounds(spark, rows):
    days = ["2024-01-01", "2024-01-02", "2024-01-05", "2024-01-06", "2024-01-09", "2024-01-10", None]
    df = spark.createDataFrame([(i, "online", d) for i, d in enumerate(days)] + [(9, "paper", None)], "id int, resp_mode string, d string")
    df = df.select("id", "resp_mode", F.to_date("d").alias("resp_date"), *[
        F.to_date(F.lit(v)).alias(k) for k, v in {"invitation": "2024-01-02", "reminder_1": "2024-01-05", "reminder_2": "2024-01-09"}.items()])
    assert [w for _, w in rows(r.response_wave(df), "id", "resp_time")] == [None, "inv1", "inv1", "rem1", "rem1", "rem2", None, "rem2"]


def test_dedupe_keeps_ties_and_ranks_null_date_last(spark, rows):
    data = [
        (1, 1, "nonresp", 1.0, "2024-01-01"), (1, 2, "resp", 0.5, "2024-01-03"), (1, 3, "resp", 0.9, None), (1, 4, "resp", 0.9, "2024-01-04"),
        (2, 5, "nonresp", 0.0, None), (2, 6, "nonresp", 0.0, None), (3, 7, "resp", 0.9, None), (None, 8, "resp", 0.1, None), (None, 9, "resp", 0.2, None),
    ]
    df = spark.createDataFrame(data, "pseudo_id int, row_id int, resp_stat string, resp_pct double, d string").withColumn("resp_date", F.to_date("d"))
    once = r.dedupe_responses(df)
    assert rows(once, "row_id") == [(4,), (5,), (6,), (7,), (9,)]
    assert rows(r.dedupe_responses(once), "row_id") == rows(once, "row_id")
    assert rows(r.dedupe_responses(df, row_key="row_id"), "row_id") == [(4,), (5,), (7,), (9,)]


def test_dedupe_has_no_window_over_persons(spark, plan):
    df = spark.range(100).select(F.lit(1).alias("pseudo_id"), F.lit("resp").alias("resp_stat"), F.col("id").cast("double").alias("resp_pct"),
                                 F.current_date().alias("resp_date"))
    text = plan(r.dedupe_responses(df))
    assert "Window" not in text and "LeftSemi" in text


def test_history(spark, rows):
    df = spark.createDataFrame([(1, 1, "paper", "resp"), (1, 2, "online", "nonresp"), (1, 3, "online", "nonresp"), (2, 4, None, "resp")],
                               "p int, id int, resp_mode string, resp_stat string").withColumns({"resp_pct": F.lit(1.0), "resp_date": F.lit(None).cast("date")})
    assert rows(r.dedupe_with_history(df, "p", "id"), "p", "id", "resp_n", "resp_type") == [
        (1, 1, 3, "online + online + paper"), (2, 4, 1, None)]


def test_slice_best_with_a_hot_group(spark, rows):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 7).alias("v"), "id")
    got = {k: v for k, v, _ in rows(slice_best(df, ["k"], [F.col("v")]))}
    assert got[0] == 6 and len(got) == len({0 if i % 3 == 0 else i for i in range(5000)})


def test_running_state_across_blocks(spark, rows):
    rng = random.Random(3)
    data, want, state = [], [], {}
    for pos in range(400):
        g, v = rng.choice("ab"), rng.choice([None, None, pos])
        data.append((g, pos, v))
        state[g] = v if v is not None else state.get(g)
        want.append((g, pos, state[g]))
    df = spark.createDataFrame(data, "g string, pos int, v int")
    for blocks in (1, 2, 16, 1024):
        assert rows(last_seen(df, "pos", {"s": F.col("v")}, ["g"], blocks=blocks), "g", "pos", "s") == sorted(want, key=repr)
    far = df.withColumn("pos", F.col("pos").cast("long") * 1_000_000)
    assert rows(last_seen(far, "pos", {"s": F.col("v")}, ["g"]), "g", "pos", "s") == sorted([(g, p * 1_000_000, s) for g, p, s in want], key=repr)


def test_blocks_hold_like_many_rows_wherever_positions_lie(spark):
    """Positions in clumps and far apart: no block, and so no task of a scan, gets much more than its share."""
    df = spark.range(40_000).select((F.col("id") * F.when(F.col("id") % 2 == 0, 1).otherwise(10**9)).alias("pos"))
    cuts = splitters(df, "pos", 64)
    blocked = with_blocks(df, "pos", cuts, "b")
    sizes = blocked.groupBy("b").count().collect()
    assert len(sizes) == 64 and max(r["count"] for r in sizes) < 1.1 * 40_000 / 64
    got = {r["pos"]: r["b"] for r in blocked.sample(0.02, 1).collect()}
    assert got == {p: sum(c <= p for c in cuts) for p in got}


def test_running_totals(spark, rows):
    rng = random.Random(4)
    data = [(rng.choice("ab"), p * 7 % 501, rng.choice([None, 1, 5])) for p in range(501)]
    df = spark.createDataFrame(data, "g string, pos int, v int")
    want = []
    for g in "ab":
        total = None
        for _, p, v in sorted(d for d in ((d[1], d[1], d[2]) for d in data if d[0] == g)):
            total = total if v is None else v + (total or 0)
            want.append((g, p, total))
    for blocks in (1, 9, 1024):
        assert rows(running_totals(df, "pos", {"t": F.col("v")}, ["g"], blocks), "g", "pos", "t") == sorted(want, key=repr)


@pytest.mark.parametrize("blocks", [1, 5, 1024])
def test_last_before_is_an_asof_join(spark, rows, plan, blocks):
    rng = random.Random(9)
    events = [(rng.choice("abcd"), rng.choice([None, *range(0, 300, 7)]), f"v{k}", rng.choice([None, 5, 60])) for k in range(120)]
    asked = [(rng.choice(["a", "b", "c", "x", None]), rng.choice([None, *range(-5, 310)]), k) for k in range(400)] + [(None, 50, 400)]
    events += [(None, 40, "null's", None)]
    want = []
    for g, at, k in asked:
        own = [(t, (v, t + u if u is not None else None)) for e, t, v, u in events if e == g and t is not None and at is not None and t <= at]
        last = max(own, key=lambda o: (o[0], o[1][0], o[1][1] is not None, o[1][1] or 0), default=None)
        want.append((g, at, k, last[1][0] if last and (last[1][1] is None or at <= last[1][1]) else None))
    versions = spark.createDataFrame(events, "g string, t int, v string, u int").withColumn("end", F.col("t") + F.col("u"))
    got = last_before(spark.createDataFrame(asked, "g string, at long, k int"), "at", versions, "t", ["v"], ["g"], "end", blocks)
    assert rows(got, "g", "at", "k", "v") == sorted(want, key=repr)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_row_numbers_across_blocks(spark, rows):
    data = [("ab"[p % 3 == 0], p * 5, f"n{p}") for p in range(100)]
    df = spark.createDataFrame(data, "g string, pos int, name string")
    got = rows(number_rows(df, "pos", ["g"], "k", "n", {"nxt": "name"}, blocks=8), "g", "pos", "k", "n", "nxt")
    want = []
    for g in "ab":
        own = sorted(d[1:] for d in data if d[0] == g)
        want += [(g, p, i + 1, len(own), own[i + 1][1] if i + 1 < len(own) else None) for i, (p, _) in enumerate(own)]
    assert got == sorted(want, key=repr)


def test_question_progress(spark, rows):
    variables = spark.createDataFrame([(1, "a"), (2, "b_text"), (3, "c"), (4, "d"), (5, "e")], "pos int, concept_id string")
    questions = spark.createDataFrame([("a", "m"), ("b_text", "m"), ("c", None), ("d", "m"), ("e", "m")], "concept_id string, question_module string")
    assert r.question_list(r.question_progress(variables, questions)) == [
        Question("a", 0.333, "d"), Question("d", 0.667, "e"), Question("e", 1.0, None)]


def test_identifiers_are_dense_unique_and_stable(spark, plan):
    df = spark.range(3000).select(F.col("id").alias("pseudo_id"), F.lit("x").alias("v"))
    one = identifiers.pseudonymous_ids(df, ["pseudo_id"], "SV0009", "salt")
    again = identifiers.pseudonymous_ids(df.repartition(7), ["pseudo_id"], "SV0009", "salt")
    other = identifiers.pseudonymous_ids(df, ["pseudo_id"], "SV0009", "pepper")
    a = {r["pseudo_id"]: r for r in one.collect()}
    assert a == {r["pseudo_id"]: r for r in again.collect()}
    assert sorted(int(r["resp_id"].split("-")[1]) for r in a.values()) == list(range(1, 3001))
    assert sorted(r["resp_id_suf"] for r in a.values())[0] == "SV0009-SUF-0001"
    assert sum(a[r["pseudo_id"]]["resp_id"] == r["resp_id"] for r in other.collect()) < 50
    assert sum(r["resp_id"][7:] == r["resp_id_suf"][11:] for r in a.values()) < 50
    assert "pseudo_id" not in identifiers.pseudonymous_ids(df, ["pseudo_id"], "S", "s", drop=["pseudo_id"]).columns
