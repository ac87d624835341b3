"""Periodic runs, the conversation trie and sharding against brute-force versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import periodic, sharding, trie
from tallyloom.llm.queries import _repeating


def _rows(df):
    return [r.asDict() for r in df.collect()]


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- periodic runs

def _runs(w, times=4, least=6):
    """start, length, period of every run, period by period."""
    out = set()
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            long = j > i and j + q - i >= max(least, times * q)
            if long and not any(q % d == 0 and all(w[x] == w[x + d] for x in range(i, j + q - d)) for d in range(1, q)):
                out.add((i, j + q - i, q))
            i = j + 1
    return out


def _periodic_answer(words):
    runs = sorted((s, q, n) for s, n, q in _runs(words))
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, q, n in runs), default=None)
    facts = (len(runs), best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (0, None, None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
    return (*facts, _sha(lines), _sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.fixture(scope="module")
def periodic_texts():
    rng, out = random.Random(3), {}
    for k in range(150):
        w = [f"w{rng.randrange(rng.choice([1, 2, 5, 50]))}" for _ in range(rng.randrange(0, 220))]
        for _ in range(rng.randrange(3)):
            if len(w) > 8:
                p, a = rng.randrange(1, len(w) // 3), rng.randrange(len(w))
                for i in range(a + p, rng.randrange(a, len(w))):
                    w[i] = w[i - p]
        out[k] = rng.choice([" ", "\n", " \t "]).join(w)
    long = [f"v{rng.randrange(900)}" for _ in range(1500)]
    out |= {200: None, 201: "", 202: " \t\n", 203: "a " * 5, 204: "a " * 6, 205: "é " * 3000, 206: "a b " * 700 + "c", 207: "x" * 9000,
            208: " ".join(long + long[-300:] * 4 + long), 209: "A a A a A a A a", 210: "a\x85b a\x85b a\x85b a\x85b a\x85b a\x85b"}
    return out


def _words(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_periodic_runs(spark, periodic_texts):
    df = spark.createDataFrame(list(periodic_texts.items()), "doc_id long, text string").withColumns(
        {"no": F.lit("clash"), "period": F.lit(1), "words": F.lit(0), "runs": F.lit("x")}).repartition(3)
    got = {r.pop("doc_id"): tuple(r.values()) for r in _rows(periodic.periodic_runs(df))}
    assert got == {k: _periodic_answer(_words(t)) for k, t in periodic_texts.items()}
    full = {r["doc_id"]: r for r in _rows(periodic.periodic_runs(df, texts=True))}
    for k, t in periodic_texts.items():
        assert _sha(full[k]["collapsed"]) == full[k]["collapsed_sha256"] == got[k][-1]
        assert {(r["start"], r["length"], r["period"]) for r in full[k]["runs"]} == _runs(_words(t))


def test_periodic_runs_of_reshaped_documents(spark, periodic_texts):
    def shaped(key, text):
        w, h = _words(text), zlib.crc32(str(key).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        return w
    df = spark.createDataFrame(list(periodic_texts.items()), "doc_id long, text string")
    got = {r.pop("doc_id"): tuple(r.values()) for r in _rows(periodic.periodic_runs(df, shape=_repeating))}
    assert got == {k: _periodic_answer(shaped(k, t)) for k, t in periodic_texts.items()}


def test_periodic_runs_of_null_and_repeated_ids_and_no_rows(spark):
    rows = [(None, "a " * 9), (None, "b"), (3, "a " * 7), (3, "a b " * 4), (3, "a " * 7)]
    got = Counter((r["doc_id"], r["n_runs"], r["length"]) for r in _rows(periodic.periodic_runs(spark.createDataFrame(rows, "doc_id int, text string"))))
    assert got == Counter([(None, 1, 9), (None, 0, None), (3, 1, 7), (3, 1, 8), (3, 1, 7)])
    empty = periodic.periodic_runs(spark.createDataFrame([], "doc_id string, text string"))
    assert empty.count() == 0 and empty.schema["doc_id"].dataType.simpleString() == "string"
    with pytest.raises(ValueError):
        periodic.periodic_runs(empty, times=3)


def test_tiles_of_a_long_document_are_short_and_many():
    import numpy as np
    ids = np.tile(np.arange(7, dtype=np.int32), 20_000)
    tiles = [(k, x, *periodic.tile_bounds(k, x, len(ids))) for _, k, x in periodic.anchors(ids, np.array([0]), 4, 6)]
    small = [t for t in tiles if t[0] == 2]
    assert len(ids) // 8 - 2 <= len(small) <= len(ids) // 8 and max(hi - lo for _, _, lo, hi in small) <= 29
    assert {q for k, x, lo, hi in small for q, _, _ in periodic.solve_tile(ids[lo:hi].tolist(), k, x - lo)} == {7}


# ---------------------------------------------------------------- conversation trie

def _rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    return own, out


def _trie_answer(conversations):
    members = defaultdict(list)
    for c in sorted(conversations):
        for d in range(len(conversations[c]) + 1):
            members[tuple(conversations[c][:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        words = len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own) - 1) * words
    return Counter((own[0], len(p), members[p[:-1]][0] if p else None, len(own), children[p], leaves[p], saved[p],
                    _sha(",".join(str(c) for c in own if len(conversations[c]) == len(p)))) for p, own in members.items())


@pytest.fixture(scope="module")
def conversations():
    rng, rows = random.Random(8), []
    for c in range(400):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant"]), " ".join(rng.choice("ab") for _ in range(rng.randrange(3)))))
    rows += [(500 + k, t, "user", "the same") for k in range(60) for t in range(4)]            # one very common conversation
    rows += [(20 * k, 0, "user", "common") for k in range(30, 60)]
    rows += [(1001, t, "user", f"t{t}") for t in range(120)]                                   # long, its base absent
    rows += [(1002, t, "user", f"t{t}") for t in range(110)]
    rows += [(2001 + k, 0, None, None) for k in range(30)]                                     # some rebuilt without turns
    rows += [(None, 0, "user", "lost"), (3000, None, "user", "first"), (3000, 0, "a", "z"), (3000, 0, "a", "b"), (3000, 0, "a", "b"), (3007, 1, "", ""),
             (3013, 1, None, "x  y\tz\x85z")]
    return rows


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("shard_rows", [None, 1, 40, 10**9])
def test_conversation_trie(spark, conversations, shard_rows):
    df = spark.createDataFrame(conversations, TURNS).withColumns({"pos": F.lit("clash"), "depth": F.lit(0), "conv": F.lit("x"), "p1": F.lit(1)}).repartition(3)
    own, rebuilt = _rebuilt(conversations)
    heads = F.crc32(F.col("conv").cast("string")) % 4
    got = trie.conversation_trie(df, heads=heads, shard_rows=shard_rows, waiting=50)
    assert Counter(tuple(r) for r in got.collect()) == _trie_answer(rebuilt)
    if shard_rows is None:
        assert Counter(tuple(r) for r in trie.conversation_trie(df).collect()) == _trie_answer(own)


def test_prefixes_over_blocks(spark, conversations, monkeypatch):
    monkeypatch.setattr(trie, "_BLOCK", 7)
    own, _ = _rebuilt(conversations)
    got = trie.conversation_trie(spark.createDataFrame(conversations, TURNS))
    assert Counter(tuple(r) for r in got.collect()) == _trie_answer(own)


def test_trie_of_no_rows(spark):
    empty = spark.createDataFrame([], TURNS)
    assert trie.conversation_trie(empty).count() == 0
    assert trie.conversation_trie(empty, heads=F.lit(1)).count() == 0
    assert trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).count() == 0


def test_spilling_queue():
    rng, queue, kept = random.Random(2), trie.SpillingQueue(16), defaultdict(list)
    for step in range(40):
        for _ in range(rng.randrange(30)):
            message = (rng.randrange(step, step + 5), -rng.randrange(3), 0, rng.randrange(-9, 9), 2**40)
            queue.put(message)
            kept[message[:3]].append(message)
        for key in sorted(k for k in kept if k[0] == step):
            assert sorted(queue.take(key)) == sorted(kept.pop(key))
    assert queue.spilled > 5


# ---------------------------------------------------------------- sharding

def _check_shards(got, rows, shards):
    assert Counter(r["doc_id"] for r in got) == Counter(k for k, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in rows)
    per = defaultdict(list)
    for r in got:
        per[r["shard"]].append(r["slot"])
        assert r["next_shard"] in (r["shard"], shards) and r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(v) == list(range(len(v))) for v in per.values()) and all(0 <= s < shards for s in per)


def test_sharding(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice(["ä", "word "]) * rng.randrange(200)) for k in range(3000)] + [(None, None)] * 40 + [(None, "n")] * 900 + [(7, "hot")] * 1500 + [(8, "y" * 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"size": F.lit("clash"), "shard": F.lit(9), "slot": F.lit(9), "_id": F.lit("x")}).repartition(5)
    got = _rows(sharding.shard_documents(df, 6))
    _check_shards(got, rows, 6)
    loads = Counter()
    later = Counter()
    for r in got:
        loads[r["shard"]] += r["size"]
        later[r["next_shard"]] += r["size"]
    assert max(loads.values()) < 1.01 * min(loads.values())
    assert max(later.values()) < 1.1 * min(later.values()) and len(later) == 7
    assert Counter(tuple(r.values()) for r in got) == Counter(tuple(r.values()) for r in _rows(sharding.shard_documents(df.repartition(2), 6)))


def test_edits_move_what_they_must(spark):
    sizes = spark.createDataFrame([(k, 10 + k % 7) for k in range(64)], "virtual_slot int, slot_size long")
    one = {r[0]: r[1] for r in sharding.edited_map(sizes, 4).collect()}
    assert sorted(one) == list(range(64)) and set(one.values()) == set(range(4))
    as_map = lambda m: spark.createDataFrame(list(m.items()), "virtual_slot int, shard int")
    same = {r[0]: r[1] for r in sharding.edited_map(sizes, 4, as_map(one), slack=0.05).collect()}
    assert same == one
    grown = {r[0]: r[1] for r in sharding.edited_map(sizes, 5, as_map(one)).collect()}
    assert all(grown[k] in (one[k], 4) for k in one) and 10 <= sum(v == 4 for v in grown.values()) <= 18
    fewer = {r[0]: r[1] for r in sharding.edited_map(sizes, 3, as_map(one), slack=10).collect()}
    assert set(fewer.values()) == {0, 1, 2} and all(fewer[k] == one[k] for k in one if one[k] < 3)
    heavy = sizes.withColumn("slot_size", F.when(F.col("virtual_slot") < 8, 200).otherwise(F.col("slot_size")).cast("long"))
    later = {r[0]: r[1] for r in sharding.edited_map(heavy, 4, as_map(one), slack=0.1).collect()}
    bytes_of = {r[0]: r[1] for r in heavy.collect()}
    loads = [sum(bytes_of[k] for k in later if later[k] == s) for s in range(4)]
    assert max(loads) < 1.25 * min(loads) and 0 < sum(later[k] != one[k] for k in one) < 40


def test_versions_and_tiny_tables(spark, tmp_path):
    path = str(tmp_path / "maps")
    df = spark.createDataFrame([(1, None)], "doc_id long, text string")
    got = _rows(sharding.shard_documents(df, 3, path=path))
    assert [(r["size"], r["text_crc32"], r["slot"]) for r in got] == [(8, 0, 0)]
    assert sharding.read_version(spark, path, 1).count() == sharding.read_version(spark, path, 2).count() == sharding.SLOTS
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        sharding.write_version(sharding.read_version(spark, path, 1), path, 2)
    assert sharding.shard_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sharding_stays_in_the_jvm(spark, plan):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    text = plan(sharding.shard_documents(df))
    assert "Python" not in text and "Arrow" not in text and "NestedLoop" not in text
