"""Each operator against a brute-force version on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import chat, exact, jaccard, mixing, packing, permutation, quality, suffix, toxicity, warc
from tallyloom.llm.components import components
from tallyloom.llm.shingles import WordHashes, shingle_set, shingle_sets

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _words(rng, n, vocabulary=400):
    return [f"w{rng.integers(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    """id -> text: copies, near copies by one word and by many, shared passages, empty, blank, very long."""
    rng, out = np.random.default_rng(5), {}
    passage = _words(rng, 70)
    for k in range(40):
        own = _words(rng, int(rng.integers(1, 120)))
        out[len(out)] = " ".join(own)
        if k % 4 == 0:
            out[len(out)] = " ".join(own)
            changed = list(own)
            changed[len(own) // 2] = "changed"
            out[len(out)] = "\n".join(changed)
        if k % 5 == 0:
            out[len(out)] = " ".join(_words(rng, 30) + passage + _words(rng, 25))
    base = _words(rng, 200)
    for k in range(40):  # near copies of one text, more than are paired directly
        own = list(base)
        own[5 * k % 200] = f"x{k}"
        out[len(out)] = " ".join(own)
    for k in range(6):  # tiny sets that differ by one shingle
        out[len(out)] = " ".join(base[:8 + k])
    long = _words(rng, 20_000, 5000)
    for text in ("", "  \t\n", None, "one", "ONE", "a b c d", " ".join(long), " ".join(long[:19_000] + ["z"]), "é à ü " * 30, "x" * 5000):
        out[len(out)] = text
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, "en", f"s{k % 3}" if k % 7 else None, len(t or "")) for k, t in texts.items()]
    return spark.createDataFrame(rows, DOCS).withColumns({"n": F.lit("clash"), "id": F.lit(1), "_id": F.lit("x"), "node": F.lit(0)}).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _collect(df):
    return [r.asDict() for r in df.collect()]


# ---------------------------------------------------------------- exact de-duplication

@pytest.mark.parametrize("keep", ["min", "max"])
def test_content_sort(docs, texts, empty, keep):
    groups = defaultdict(list)
    for k, t in texts.items():
        groups[t or ""].append(k)
    choose = min if keep == "min" else max
    got = {r["doc_id"]: r for r in _collect(exact.content_sort(docs, keep=keep))}
    assert got.keys() == texts.keys()
    for k, t in texts.items():
        own, r = groups[t or ""], got[k]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (choose(own), len(own), k == choose(own))
        assert r["text_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert exact.content_sort(empty).count() == 0


def test_content_sort_of_one_hot_text_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
        out = exact.content_sort(df, "id", keep="max")
        assert out.filter("kept").count() == 1001
        assert out.filter("group_size = 2000").agg(F.min("keep_id"), F.max("keep_id")).first() == (2999, 2999)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_content_sort_with_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a"), (3, "a"), (2, "a"), (5, "b"), (5, "b"), (None, "c"), (None, "c")], "id long, text string")
    for keep, ids in (("min", 2), ("max", 3)):
        got = _collect(exact.content_sort(df, "id", keep=keep).filter("kept"))
        assert Counter(r["id"] for r in got) == Counter([ids, 5, None])
    assert Counter((r["id"], r["text"]) for r in _collect(exact.keep_one(df, "id"))) == Counter([(2, "a"), (5, "b"), (None, "c")])


# ---------------------------------------------------------------- shingles, components, Jaccard join

def test_sets_of_many_texts_are_those_of_each(texts):
    hashes = WordHashes()
    for one, text in zip(shingle_sets(texts.values(), hashes, together=500), texts.values()):
        assert one.tolist() == shingle_set(hashes.of(text)).tolist()


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1060)]
    root = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in _collect(components(spark.createDataFrame(edges, "a long, b long")))}
    assert got == {k: v for k, v in root.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _jaccard(texts):
    sets = {}
    for k, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                one, two = find(a), find(b)
                root[max(one, two)] = min(one, two)
    return {k: (len(sets[k]), find(k)) for k in sets}


def test_near_duplicates(docs, texts, empty):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in _collect(jaccard.near_duplicates(docs))}
    want = _jaccard(texts)
    assert got == want
    kept = jaccard.keep_representatives(docs)
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {k for k, (_, c) in want.items() if k == c}
    assert kept.columns == docs.columns
    assert jaccard.near_duplicates(empty).count() == 0


def test_links_through_rows_without_ids(spark):
    rng = np.random.default_rng(12)
    a = _words(rng, 120)
    x = a[:105] + _words(rng, 15, 9)
    b = x[12:] + _words(rng, 12, 9)
    rows = [(1, " ".join(a)), (None, " ".join(x)), (2, " ".join(b)), (None, " ".join(x)), (None, " ".join(_words(rng, 50))), (3, " ".join(_words(rng, 50)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = _collect(jaccard.near_duplicates(df))
    want = _jaccard(dict(enumerate(t for _, t in rows)))
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter([(1, 1), (None, 1), (2, 1), (None, 1), (None, None), (3, 3)])
    assert len({want[k] for k in range(4)}) == 1 and len({want[0], want[4], want[5]}) == 3
    assert Counter(r["doc_id"] for r in _collect(jaccard.keep_representatives(df))) == Counter([1, None, 3])


def test_one_row_of_each_component_stays(spark):
    rng = np.random.default_rng(13)
    a, b, c = (_words(rng, 80) for _ in range(3))
    near = lambda w, k: " ".join([*w[:k], "other", *w[k + 1:]])
    rows = [(1, " ".join(a)), (7, near(a, 3)), (7, " ".join(b)), (4, near(c, 9)), (4, " ".join(c)), (None, near(a, 50)), (None, ""), (None, ""), (5, " "),
            (6, "one text"), (6, "one text"), (None, "lost text here"), (None, "lost text here"), (9, None)]
    df = spark.createDataFrame([(k, t, f"n{i}", i) for i, (k, t) in enumerate(rows)], "doc_id long, text string, class string, mark int")
    got = _collect(jaccard.keep_representatives(df))
    kept = Counter((r["doc_id"], r["text"]) for r in got)
    assert kept[(1, " ".join(a))] == kept[(7, " ".join(b))] == 1 and (7, near(a, 3)) not in kept
    assert kept[(4, near(c, 9))] + kept[(4, " ".join(c))] == 1 and (None, near(a, 50)) not in kept
    assert kept[(None, "")] == 2 and kept[(5, " ")] == kept[(9, None)] == 1
    assert kept[(6, "one text")] == kept[(None, "lost text here")] == 1 and len(got) == 9


def test_near_duplicates_without_ids_and_with_repeated_ones(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(None, text), (4, text + " more"), (4, text), (7, "other words here only"), (None, None)]
    got = _collect(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sorted((r["doc_id"], r["component_id"]) for r in got if r["doc_id"]) == [(4, 4), (4, 4), (7, 7)]
    assert sorted((r["n_shingles"], r["component_id"] or 0) for r in got if r["doc_id"] is None) == [(0, 0), (36, 4)]


def test_bounds_of_the_partition():
    limits = jaccard.Limits()
    for r in range(1, 300):
        for s in range(limits.smallest(r), r + 1):
            most = max((r + s - 2 * both for both in range(s + 1) if 100 * both >= 75 * (r + s - both)), default=0)
            assert most <= limits.differ(r + s) <= min(limits.budget(r), limits.budget(s))
            shared = min(limits.prefix(r), limits.prefix(s)) - limits.differ(r + s)
            assert shared > max(limits.spare(r), limits.spare(s)) or limits.neighbours(s)
        assert limits.neighbours(r) or limits.segmented(r)
        assert limits.prefix(r) <= r or r < 3
    assert all(limits.segments(b) > limits.prefix(24 * 4 ** b - 1) for b in (1, 2, 3, 4))


def test_sketches_never_exclude_a_pair():
    rng = np.random.default_rng(2)
    for size in (10, 400, 3000, 9000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.append(a[size // 10:], rng.integers(0, 2**63, size // 8).astype(np.uint64)))
        apart = len(np.setxor1d(a, b))
        assert np.bitwise_count((jaccard.sketch(a) ^ jaccard.sketch(b)).view(np.uint64)).sum() <= apart
        if size > jaccard.SKETCH:
            assert jaccard.differing(jaccard.wide_sketch(a), jaccard.wide_sketch(b)) <= apart


# ---------------------------------------------------------------- mixing

def test_mix(docs, texts, empty):
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in texts.items()}
    source = {k: f"s{k % 3}" if k % 7 else None for k in texts}
    names = sorted({s for s in source.values() if s}) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    whole = {s: sum(size[k] for k in texts if source[k] == s) for s in names}
    target, free = {}, set(names)
    while True:  # reshare until no target is above its limit
        level = (1.5 * sum(whole.values()) - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= 2 * whole[s]}
        if not over:
            break
        target.update({s: 2.0 * whole[s] for s in over})
        free -= over
    target.update({s: weight[s] * level for s in free})
    rows = _collect(mixing.mix(docs))
    assert sorted((r["doc_id"], r["size"]) for r in rows) == sorted(size.items())
    taken = Counter()
    for r in rows:
        assert r["source_size"] == whole[source[r["doc_id"]]] and r["target"] == pytest.approx(target[source[r["doc_id"]]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    assert {s: taken[s] for s in names} == {s: int(target[s] + 1e-6) for s in names}
    assert sorted(rows, key=str) == sorted(_collect(mixing.mix(docs.repartition(7))), key=str)
    assert mixing.mix(empty).count() == 0

    mixed = _collect(mixing.mixed_documents(docs, chars_col="n_chars"))
    words = Counter()
    for r in mixed:
        words[r["doc_id"]] += len((r["text"] or "").split())
        assert (texts[r["doc_id"]] or "").startswith(r["text"] or "") and r["n_chars"] == len(r["text"] or "")
    assert {k: v for k, v in words.items() if v} == {r["doc_id"]: r["taken"] for r in rows if r["taken"]}


def test_mix_of_repeated_rows_and_empty_sources(spark):
    df = spark.createDataFrame([(1, "a b c", "x"), (1, "a b c", "x"), (2, "d e", "x"), (None, "f", "x"), (3, None, "y"), (4, "", None)], "doc_id long, text string, source string")
    rows = _collect(mixing.mix(df))
    assert len(rows) == 6 and all(r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["target"] for r in rows if r["doc_id"] in (3, 4)} == {0.0}


# ---------------------------------------------------------------- packing

def test_pack_documents(docs, texts, empty):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = _collect(packing.pack_documents(docs, TOKENIZER, 256))
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    for k, t in texts.items():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted(by[k], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in own] == [(i, s, min(256, len(ids) - s)) for i, s in enumerate(range(0, len(ids), 256))]
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in own)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= sum(r["length"] for r in rows) / 256 * 1.02 + 1
    assert packing.pack_documents(empty, TOKENIZER, 256).count() == 0


def test_packed_sequences_hold_the_ids(spark):
    df = spark.createDataFrame([(k, "some words " * k, None) for k in range(30)], "doc_id long, text string, extra string")
    pieces = packing.token_pieces(df, TOKENIZER, 64).cache()
    placed = packing.place_pieces(pieces.drop("ids"), 64)
    got = {r["sequence_id"]: np.frombuffer(bytes(r["ids"]), "<u4") for r in _collect(packing.packed_sequences(pieces, placed))}
    for r in _collect(placed.join(pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"])):
        assert got[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]].tobytes() == bytes(r["ids"])


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_keeps_every_capacity(rule):
    rng = np.random.default_rng(3)
    lengths = Counter(int(x) for x in rng.integers(1, 100, 500))
    plan = packing.plan_bins(list(lengths.items()), 100, max_documents=5, max_attention=4000 if rule == "norm" else 10**6, weights=(1.0, 0.5, 0.5), rule=rule) \
        if rule == "dot" else packing.plan_bins([(n, c) for n, c in lengths.items() if n <= 60], 100, max_documents=5, max_attention=4000, weights=(1.0, 0.5, 0.5))
    bins, seen = defaultdict(list), Counter()
    for length, first, last, start, copies, place in plan:
        assert first == seen[length]
        for number in range(first, last):
            bins[start + (number - first) // copies].append((place + (number - first) % copies * length, length))
        seen[length] = last
    assert seen == (lengths if rule == "dot" else Counter({n: c for n, c in lengths.items() if n <= 60}))
    for parts in bins.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 100 and len(parts) <= 5 and sum(n * n for _, n in parts) <= (4000 if rule == "norm" else 10**6)
    with pytest.raises(ValueError, match="no sequence"):
        packing.plan_bins([(101, 1)], 100)


def test_words_alone_are_the_whole_text():
    ids = packing._WordIds(TOKENIZER)
    rng, letters = np.random.default_rng(4), list("aA.,é'ß&%s×…ÉİΣ \x1c12#\ń-HJTWYhjtwy\u030c\u0331\u0308\u0301\u030a\u0323\u0345\u1100\u1161\u11a8\u200d\xa0ǰK\u212a\ufb01語🙂")
    for start in range(0, 20_000, 500):
        texts = ["".join(rng.choice(letters, int(rng.integers(1, 30)))) for _ in range(500)]
        split = [ids.split(t) for t in texts]
        now = ids.learn(set().union(*filter(None, split)))
        for text, words in zip(texts, split):
            assert ids.ids(text, words, now) == np.array(ids.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)
    assert ids.apart


def test_a_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "_CACHE", 40)
    ids, rng = packing._WordIds(TOKENIZER), np.random.default_rng(6)
    for _ in range(60):
        text = " ".join("".join(rng.choice(list("abcé"), 3)) + str(rng.choice(["", ",", "!?"])) for _ in range(30))
        words = ids.split(text)
        assert ids.ids(text, words, ids.learn(set(words))) == np.array(ids.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_a_tokenizer_that_joins_words_gets_whole_texts(spark, tmp_path):
    from tokenizers import Regex, models, pre_tokenizers
    own = Tokenizer(models.WordLevel({"a b": 2, "a": 3, "b": 4, "?": 5}, unk_token="?"))
    own.pre_tokenizer = pre_tokenizers.Split(Regex("a b|[ab]"), "isolated")
    own.save(path := str(tmp_path / "joins.json"))
    texts = ["a b", "b a", "", "a"]
    df = spark.createDataFrame(list(enumerate(texts)), "key string, text string".replace("string,", "long,", 1)).coalesce(1)
    got = {r["key"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in _collect(packing.token_pieces(df, path, id_col="key"))}
    assert got == {k: [*own.encode(t, add_special_tokens=False).ids, 1] for k, t in enumerate(texts)}
    assert packing.pack_documents(df, path, 8, id_col="key").columns[0] == "key"


def test_added_tokens_are_single_ids_where_the_whole_text_has_them(spark):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = ["plain words first", "<|endoftext|>", "one <|endoftext|> two", "foo<|endoftext|>", "<|endoftext|>, bar", "x<|ENDOFTEXT|>y",
             "<|StartOfText|>A<|startoftext|>B", "<|endoftext|><|endoftext|>\n<|endoftext", "<|endoftext |>", "É<|endoftext|>é", "last words"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in _collect(packing.token_pieces(df, TOKENIZER))}
    assert got == {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for k, t in enumerate(texts)}
    assert got[1] == [49407, 1] and 49407 not in got[5]
    rows = _collect(packing.pack_documents(df, TOKENIZER))
    assert {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in rows} == {k: (len(ids), packing.crc32(ids)) for k, ids in got.items()}


# ---------------------------------------------------------------- nearest neighbours

def test_nearest_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1200, 12)).astype(np.float32)
    x[300:420] = x[300]  # copies
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(5000, None), (5100, [0.0] * 12), (5200, [float("nan")] * 12), (5300, [None] * 12), (5400, [1.0]), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    got = defaultdict(list)
    for r in sorted(_collect(permutation.nearest_neighbours(df, lambda i: i % 100 == 0)), key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 1200, 100))
    hits = 0
    for q, found in got.items():
        far = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        best = [int(k) for k in np.lexsort((np.arange(len(x)), far)) if k != q][:10]
        assert [f[1] for f in found] == pytest.approx([far[v] for v, _ in found]) and found == sorted(found, key=lambda f: (f[1], f[0])) and len(found) == 10
        hits += len(set(best) & {v for v, _ in found})
    assert hits >= 0.9 * 10 * len(got)
    assert [v for v, _ in got[300]] == list(range(301, 311))
    assert permutation.nearest_neighbours(df.filter("vec_id < 0"), lambda i: i % 100 == 0).count() == 0
    assert permutation.nearest_neighbours(df.filter("vec_id IN (0, 1, 2)"), lambda i: i % 100 == 0).count() == 2


# ---------------------------------------------------------------- toxicity, quality

@pytest.fixture(scope="module")
def labelled(spark):
    rng, rows, labels = np.random.default_rng(7), [], []
    for k in range(900):
        bad, junk = k % 4 == 0, k % 5 == 0
        words = _words(rng, int(rng.integers(20, 80)), 900)
        if bad:
            for _ in range(3):
                words[int(rng.integers(len(words)))] = ["badword", "uglyterm", "nastyness"][int(rng.integers(3))]
        if junk:
            words = [w + "***" for w in words]
        rows.append((k, " ".join(words), "en", "junk" if junk and k % 2 else "s", 10))
        if k % 3:
            labels.append((k, int(not junk), int(bad)))
    rows += [(10_001, None, None, None, None), (10_002, "", "en", "s", 0), (None, "badword", "en", None, 3)]
    labels += [(None, 1, 1), (55_555, 1, 1)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(spark, labelled):
    docs, labels = labelled
    got = {r["doc_id"]: r for r in _collect(toxicity.toxicity(docs, labels))}
    assert len(got) == 903 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items() if k is not None)
    held = [k for k, r in got.items() if r["held_out"] and k is not None and k < 900]
    assert np.mean([got[k]["predicted"] == (k % 4 == 0) for k in held]) > 0.95
    assert got[10_001]["score"] == got[10_002]["score"]
    kept = {r["doc_id"] for r in toxicity.keep_clean(docs, labels).collect()}
    assert kept == {k for k, r in got.items() if not r["predicted"]}
    none = toxicity.toxicity(docs, labels.filter("toxic = 0"))
    assert {r["score"] for r in none.collect()} == {0.0}
    assert toxicity.toxicity(docs.filter("doc_id < 0"), labels).count() == 0


def test_quality(labelled):
    docs, labels = labelled
    got = {r["doc_id"]: r for r in _collect(quality.quality(docs, labels))}
    assert len(got) == 903 and all(0 <= r["score"] <= 1 for r in got.values())
    held = [k for k, r in got.items() if r["held_out"] and k is not None and k < 900]
    assert np.mean([got[k]["predicted"] == (k % 5 != 0) for k in held]) > 0.95
    assert {r["score"] for r in quality.quality(docs, labels.filter("quality = 1")).collect()} == {1.0}
    assert {r["score"] for r in quality.quality(docs, labels.filter("quality = 7")).collect()} == {0.0}


def test_co_training_learns_from_the_other_view():
    rng = np.random.default_rng(8)
    y = rng.integers(0, 2, 2000).astype(float)
    strong, weak = y[:, None] * 3 + rng.normal(size=(2000, 1)), np.hstack([y[:, None] * 1.2 + rng.normal(size=(2000, 1)), rng.normal(size=(2000, 20))])
    few = slice(0, 24)
    alone = quality.Logistic(weak[few], y[few], 1.0)
    _, taught = quality.co_train(strong[few], weak[few], y[few], strong[24:1500], weak[24:1500], sure=100)
    accuracy = lambda fit: ((fit(weak[1500:]) >= 0.5) == y[1500:]).mean()
    assert accuracy(taught) > accuracy(alone)


# ---------------------------------------------------------------- archive

def test_archive_round_trip(spark):
    rows = [(1, "u1", "same"), (2, None, "same"), (3, "u3", None), (4, "u4", ""), (5, "u\r\nX: y", "é\r\n\r\nWARC/1.1"), (6, "u6", "x" * 200_000), (7, "u7", "x" * 200_000),
            (8, "u8", "twice"), (8, "u8", "twice"), (None, "u9", "nobody"), (None, "u9", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("address", F.lit("clash"))
    archive = warc.write_archive(pages, least=0)
    assert spark.read.parquet(archive.payloads).count() == len({h or "" for _, _, h in rows})
    last = {}
    for k, _, h in rows:
        last[h or ""] = max(k or 0, last.get(h or "", 0))
    for r in _collect(warc.archive_facts(spark, archive).filter("page_id IS NOT NULL")):
        html = next(h or "" for k, _, h in rows if k == r["page_id"])
        import base64
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode() and r["payload_bytes"] == len(html.encode())
        keeper = last[html]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if keeper == r["page_id"] else ("revisit", keeper))
    records = _collect(warc.reconstruct(spark, archive))
    assert len(records) == len(rows)
    for r in records:
        head, body = bytes(r["record"]).split(b"\r\n\r\n", 1)
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert body[length:] == b"\r\n\r\n" and body[:length] == (bytes(r["payload"]) if b"WARC-Type: response" in head else b"")
        if r["page_id"] is not None:
            assert bytes(r["payload"]).decode() == next(h or "" for k, _, h in rows if k == r["page_id"])
    few = warc.archive_facts(spark, warc.write_archive(pages.filter("page_id <= 4"), least=5))
    assert {r["record_type"] for r in few.collect()} == {"response"}
    assert warc.archive_facts(spark, warc.write_archive(pages.filter("page_id < 0"))).count() == 0


def test_exported_files_are_the_records(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a"), (2, "u", "b\r\n")], "page_id long, url string, html string")
    archive = warc.write_archive(pages)
    warc.export_files(spark, archive, str(tmp_path / "files"))
    whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "files").glob("part-*")))
    assert sorted(bytes(r["record"]) for r in warc.reconstruct(spark, archive).collect()) == sorted(
        b"WARC/1.1" + part for part in whole.split(b"WARC/1.1")[1:])


# ---------------------------------------------------------------- chat

def test_layouts_become_the_same_turns():
    registry = chat.Registry()
    turns = [("user", "hi"), ("assistant", "ho")]
    for record in ({"prompt": "hi", "completion": "ho"}, {"instruction": "hi", "output": "ho", "id": 3}, {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "ho"}]},
                   {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "ho"}]}, {"data": {"dialog": [{"speaker": "user", "utterance": "hi"}, {"speaker": "bot", "utterance": "ho"}]}},
                   {"question": "hi", "response": "ho", "system_prompt": None}):
        assert registry.turns(record)[1] == turns
    assert registry.turns({"instruction": "do", "input": "this", "output": "done"})[1] == [("user", "do\n\nthis"), ("assistant", "done")]
    assert registry.turns({"unknown": 1}) == (None, []) and registry.turns({}) == (None, [])


def test_format_is_reversible():
    rng, marks = np.random.default_rng(9), [m for pair in chat.MARKS.values() for m in pair] + ["[ROLE ", "[/ROLE]", "\\", "]", "[", "<", "/", "a", "\n", "s>", "INST]"]
    for _ in range(400):
        turns = [(["user", "assistant", "system", "tool]\\x", ""][int(rng.integers(5))], "".join(rng.choice(marks, int(rng.integers(0, 8))))) for _ in range(int(rng.integers(0, 6)))]
        formatted, starts, ends = chat.render(turns)
        assert chat.parse(formatted) == turns
        assert [chat.unescape(formatted[a:b]) for a, b in zip(starts, ends)] == [t for r, t in turns if r == "assistant"]


def test_chat_tables(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (1, None, None, "first"), (2, 5, "assistant", "b"), (2, 5, "assistant", "a"), (None, 0, "user", "x" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("record", F.lit("clash"))
    got = {r["conv_id"]: r for r in _collect(chat.read_back(chat.format_records(chat.conversation_records(df), "conv_id"), "conv_id"))}
    assert got[1]["n_turns"] == 3 and got[1]["turns_sha256"] == hashlib.sha256(b"\nfirst\nuser\nq\nassistant\n\n").hexdigest() and got[1]["loss_chars"] == 0
    assert got[2]["loss_sha256"] == hashlib.sha256(b"ab").hexdigest() and got[None]["n_turns"] == 1
    odd = spark.createDataFrame([(1, None), (2, "no json"), (3, "[1]"), (4, '{"x": 1}')], "id long, record string")
    assert {(r["layout"], r["formatted"]) for r in _collect(chat.format_records(odd, "id"))} == {(None, "")}
    assert chat.conversation_records(df.filter("conv_id < 0")).count() == 0


# ---------------------------------------------------------------- repeated passages

def test_repeated_passages(docs, texts, empty):
    words = {k: (t or "").encode().split() for k, t in texts.items()}
    where = defaultdict(set)
    for k, w in words.items():
        for i in range(len(w) - 49):
            where[tuple(w[i:i + 50])].add(k)
    want = set()
    for k, w in words.items():
        covered = sorted({j for i in range(len(w) - 49) if len(where[tuple(w[i:i + 50])]) > 1 for j in (i,)})
        start = None
        for i in covered:
            if start is None or i > stop:
                if start is not None:
                    want.add((k, start, stop - start))
                start = i
            stop = i + 50
        if start is not None:
            want.add((k, start, stop - start))
    got = _collect(suffix.repeated_passages(docs))
    assert {(r["doc_id"], r["start_word"], r["n_words"]) for r in got} == want
    assert all(r["other_id"] != r["doc_id"] for r in got)
    assert suffix.repeated_passages(empty).count() == 0
    with pytest.raises(ValueError, match="exceed"):
        suffix.repeated_passages(docs, least=10)


def _all_repeated(texts, least=50):
    """(id, start, words, smallest other id) of every stretch, by brute force."""
    where, want = defaultdict(list), set()
    for k, t in texts.items():
        w = t.split()
        for i in range(len(w) - least + 1):
            where[tuple(w[i:i + least])].append((k, i))
    spans = defaultdict(list)
    for group in where.values():
        ids = sorted({k for k, _ in group})[:2]
        if len(ids) > 1:
            for k, i in group:
                spans[k].append((i, ids[k == ids[0]]))
    for k, found in spans.items():
        start, stop, other = None, None, None
        for i, o in sorted(found):
            if start is not None and i <= stop:
                stop, other = i + least, min(other, o)
                continue
            if start is not None:
                want.add((k, start, stop - start, other))
            start, stop, other = i, i + least, o
        want.add((k, start, stop - start, other))
    return want


def _found(spark, texts, **how):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    return {tuple(r[c] for c in ("doc_id", "start_word", "n_words", "other_id")) for r in _collect(suffix.repeated_passages(df, **how))}


def test_repeated_passages_before_a_phrase_of_very_many_documents(spark):
    rng = np.random.default_rng(8)
    phrase, out = _words(rng, 40), {}
    for k in range(200):  # pairs that share 12 or 15 words before the phrase and go on differently
        shared = _words(rng, 12 + 3 * (k % 2), 10**6)
        for _ in range(2):
            out[len(out)] = " ".join(_words(rng, 3, 10**6) + shared + phrase + _words(rng, 15, 10**6))
    while len(out) < 20_000:
        out[len(out)] = " ".join(_words(rng, 3, 10**6) + phrase + _words(rng, 15, 10**6))
    ids = rng.permutation(len(out)).tolist()
    out = {ids[k]: t for k, t in out.items()}
    want = _all_repeated(out)
    assert len(want) == 400
    assert _found(spark, out) == want
    assert _found(spark, out, held=1000) == want


def test_repeated_passages_in_periodic_words(spark):
    rng = np.random.default_rng(9)
    out = {}
    for period in (1, 2, 7, 27, 40):
        cycle = _words(rng, period, 10**6)
        for n in (49, 50, 51, 90, 500, 501):
            for _ in range(2):
                out[len(out)] = " ".join(_words(rng, 5, 10**6) + (cycle * n)[:n] + _words(rng, 5, 10**6) + (cycle * n)[n // 2:n])
    assert _found(spark, out) == _found(spark, out, held=4) == _all_repeated(out)


def test_repeated_passages_of_templates(spark):
    """Header, core and footer: a passage stands where both header and footer agree, and neighbours in either order do not."""
    rng = np.random.default_rng(10)
    headers, footers = ([_words(rng, 12, 10**6) for _ in range(40)] for _ in range(2))
    core = _words(rng, 30, 10**6)
    out = {k: " ".join(_words(rng, 3, 10**6) + headers[rng.integers(40)] + core + footers[rng.integers(40)] + _words(rng, 3, 10**6)) for k in range(3000)}
    want = _all_repeated(out)
    assert len(want) > 2000
    assert _found(spark, out) == want


# ---------------------------------------------------------------- roles of the own layout

def test_roles_of_turns_stay_as_they_stand(spark):
    said = [("human", "hi"), ("gpt", "yo"), ("assistant", "ok")]
    rows = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(said)], "conv_id long, turn long, role string, text string")
    got, = _collect(chat.read_back(chat.format_records(chat.conversation_records(rows), "conv_id"), "conv_id"))
    assert got["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
    assert got["loss_chars"] == 2 and got["loss_sha256"] == hashlib.sha256(b"ok").hexdigest()
    foreign = {"conversations": [{"from": r, "value": t} for r, t in said]}
    assert chat.Registry().turns(foreign) == ("conversations", [("user", "hi"), ("assistant", "yo"), ("assistant", "ok")])


def test_archive_facts_are_read_from_the_records(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "u", "<p>WARC-Refers-To: <urn:page:9>\r\n\r\né"), (2, None, "same"), (3, "u", "same"), (4, "u", None)],
                                  "page_id long, url string, html string")
    archive = warc.write_archive(pages, least=0)
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in _collect(warc.archive_facts(spark, archive))}
    assert got == {1: (37, "response", None), 2: (4, "revisit", 3), 3: (4, "response", None), 4: (0, "response", None)}
    whole = warc.reconstruct
    spoilt = F.expr("CAST(replace(CAST(record AS STRING), 'same', 'lame') AS BINARY)")
    monkeypatch.setattr(warc, "reconstruct", lambda *a: whole(*a).withColumn("record", spoilt))
    with pytest.raises(Exception, match="disagree"):
        warc.archive_facts(spark, archive).collect()


def test_no_record_fails_a_job(spark):
    deep = "[" * 100_000 + "]" * 100_000
    bad = ['{"prompt": "a\\ud800b", "completion": "c"}', '{"prompt": ' + "9" * 5000 + ', "completion": "x"}', deep, '{"prompt": ' + deep + ', "completion": "y"}',
           '{"a":' * 950 + "1" + "}" * 950, '{"data.dialog": [{"speaker": "user", "utterance": "u"}]}', '{"data": {"dialog": [{"speaker": "user", "utterance": "u"}]}}',
           '{"messages[]": [{"role": "user", "content": "u"}]}', '{"messages": [{"role": "\\udfff", "content": "u"}]}', "null", "nan", '{"turns": "x"}', '{"turns": [1, null]}']
    df = spark.createDataFrame(list(enumerate(bad)), "id long, record string").coalesce(1)
    formatted = chat.format_records(df, "id")
    got = {r["id"]: (r["layout"], r["formatted"]) for r in _collect(formatted)}
    assert got[0] == ("prompt", "[INST]a\ufffdb[/INST]<s>c</s>") and got[1] == ("prompt", "[INST]" + "9" * 5000 + "[/INST]<s>x</s>")
    assert [got[k] for k in (2, 3, 4, 5, 7)] == [(None, "")] * 5 and got[6] == ("nested", "[INST]u[/INST]")
    assert got[8] == ("messages", "[ROLE \ufffd]u[/ROLE]") and got[9] == got[10] == got[11] == (None, "")
    assert chat.read_back(formatted, "id").count() == len(bad)


def test_conversations_in_several_layouts_read_back_alike(spark):
    rng = np.random.default_rng(2)
    rows = [(c, t, str(rng.choice(["user", "assistant", "human", ""])), str(rng.choice(["", "a [INST]", "\\", None]))) for c in range(40) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    records = chat.conversation_records(df, layouts=chat.PLAIN)
    formatted = chat.format_records(records, "conv_id", mappings=chat.PLAIN)
    assert {r["layout"] for r in _collect(formatted)} == {m.name for m in chat.PLAIN}
    both = [sorted(tuple(r) for r in chat.read_back(f, "conv_id").collect()) for f in (formatted, chat.format_records(chat.conversation_records(df), "conv_id"))]
    assert both[0] == both[1] and len(both[0]) == 40


def test_a_view_without_signal_is_left_out():
    rng = np.random.default_rng(12)
    y = (rng.random(1500) < 0.6).astype(float)
    good, noise, other = y * 3 - 1.5 + rng.normal(0, 1, 1500), rng.normal(0, 3, 1500), y * 2 - 1 + rng.normal(0, 1, 1500)
    assert quality.joint_fit(np.stack([good, noise], axis=1), y)[1] == [0]
    assert quality.joint_fit(np.stack([noise, good], axis=1), y)[1] == [1]
    assert quality.joint_fit(np.stack([good, other], axis=1), y)[1] == [0, 1]


def test_words_are_evidence_of_quality():
    rng = np.random.default_rng(13)
    hashes = quality.WordHashes()
    y = np.repeat([0, 1], 200)
    texts = [" ".join([*rng.choice([f"w{i}" for i in range(300)], 30), ("spam" if not v else "fact") if rng.random() < 0.8 else "both"]) for v in y]
    found = [quality.grams(t, hashes) for t in texts]
    assert len(quality.grams(None, hashes)) == len(quality.grams(" \n", hashes)) == 0
    assert set(quality.grams("A b a", hashes)) == set(quality.grams("a B A", hashes))
    whole, evidence = quality.cross_fitted(found, y, np.arange(400) % 4 > 0)
    assert evidence[y == 1].mean() > evidence[y == 0].mean() + 0.05
    assert whole(quality.grams("spam", hashes)) < 0 < whole(quality.grams("fact", hashes)) and whole(quality.grams("", hashes)) == 0.0


def test_toxicity_windows_are_compressed_once_by_a_worker(monkeypatch):
    """What one task found serves the next; other dictionaries start anew and change no cell."""
    asked, compute = [], toxicity.Cells.compute
    monkeypatch.setattr(toxicity, "_last", None)
    monkeypatch.setattr(toxicity.Cells, "compute", lambda self, window: asked.append(window) or compute(self, window))
    model = toxicity.Model(b"\0" * 8, b"\0" * 8)
    first = model.cells().of("one two one").tolist()
    assert model.cells().of("two one").tolist() == [first[1], first[0]]
    assert asked == [b"one", b"two"]
    other = toxicity.Model(toxicity._spelled(b"one") * 4, b"\0" * 8)
    assert other.cells().of("one").tolist() == toxicity.Cells(other.ordinary, other.toxic).of("one").tolist()
    assert asked == [b"one", b"two", b"one", b"one"]
