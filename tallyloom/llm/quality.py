"""Quality by co-training.

Two classifiers see different views of a document: its text (words and pairs of words, shares of character classes, repetition,
word and line shapes) and the metadata of its page (source, language, stated length). Words and pairs are hashed to buckets; a
bucket weighs by the log odds of its documents' labels, and a document's evidence is the mean of its buckets' weights, for a
teaching document by weights from the other half of those. Both views start from the same labelled rows. In each round each view
labels a pool of unlabelled documents, and those it is most sure of, in the proportion of the labels, are given to the *other*
view to learn from. At the end a regression over the two scores, fitted on labelled rows that neither view learned from,
calibrates and combines them; a view without which held-back rows of those are predicted as well is left out. It scores every
document over its whole text. Labelled rows (``each`` of either label) and the pool (``pool`` rows) are bounded samples.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage_table, tidied
from .learn import Logistic, held_out, teaching_rows
from .shingles import WordHashes, mix

EACH, POOL, ROUNDS, SURE = 4000, 12_000, 6, 400
_SOURCES, _LANGS = 64, 16  # buckets of the two names
_GRAMS = 1 << 16           # buckets of words and pairs of words
_SEEN = 3                  # documents a bucket must have to weigh

# Classes of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 white space, 5 sentence marks, 6 symbols, 7 beyond ASCII.
_CLASS = np.zeros(256, np.uint8)
for _k, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\v\f", b".,;:!?'\"()-",
                             b"#$%&*+/<=>@[\\]^_`{|}~"), 1):
    _CLASS[list(_bytes)] = _k
_CLASS[128:] = 7


def text_view(text: str | None) -> list[float]:
    """Features of the whole text; an empty or null text has zeros and one flag."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [1.0] + [0.0] * 19
    classes = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8) / len(raw)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    plain = len({w.lower().strip(b".,;:!?") for w in counts})
    repeats = sum(a == b for a, b in zip(words, words[1:])) / len(words)
    odd = sum(n for w, n in counts.items() if not w[-1:].isalnum() and w[-1:] not in b".,;:!?\"')" and w[-1] < 128) / len(words)
    marks = sum(n for w, n in counts.items() if not any(c > 127 or 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 for c in w)) / len(words)
    size = np.log1p(len(words))
    return [0.0, *classes[1:].tolist(), size, float(lengths.mean()), float(lengths.std()), float(np.log1p(lengths.max())), plain / len(words),
            plain / len(words) * size, counts.most_common(1)[0][1] / len(words), repeats, odd, marks, len(set(lines)) / len(lines), float(np.log1p(len(words) / len(lines)))]


def grams(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Distinct buckets of the words, A-Z lowered, and of the pairs of neighbouring words of the whole text."""
    words = hashes.of(text)
    pairs = mix(words[:-1] * np.uint64(3) + words[1:])
    seen = np.zeros(_GRAMS, bool)
    seen[np.concatenate([words, pairs]) >> np.uint64(48)] = True
    return np.flatnonzero(seen).astype(np.uint16)


class Evidence:
    """What the words of a document say about its label."""

    def __init__(self, documents: list[np.ndarray], label: np.ndarray):
        counts = [np.zeros(_GRAMS), np.zeros(_GRAMS)]
        for found, y in zip(documents, label.astype(int)):
            counts[y][found] += 1
        bad, good = ((c + 0.5) / (n + 1) for c, n in zip(counts, ((label == 0).sum(), (label == 1).sum())))
        self.weights = np.where(counts[0] + counts[1] >= _SEEN, np.log(good) - np.log(bad), 0.0)

    def __call__(self, found: np.ndarray) -> float:
        return float(self.weights[found].mean()) if len(found) else 0.0


def cross_fitted(documents: list[np.ndarray], label: np.ndarray, teach: np.ndarray) -> tuple[Evidence, np.ndarray]:
    """Evidence from all teaching documents, and what it is of each document; of a teaching one by the other half of them."""
    def learned(rows: np.ndarray) -> Evidence:
        return Evidence([documents[i] for i in rows], label[rows])
    own = np.flatnonzero(teach)
    # rows come in order of their label, so every second one is a fair half
    whole, halves = learned(own), (learned(own[1::2]), learned(own[::2]))
    out = np.array([whole(found) for found in documents])
    for place, i in enumerate(own):
        out[i] = halves[place % 2](documents[i])
    return whole, out


def metadata_view(source: str | None, lang: str | None, chars: int | None) -> list[float]:
    """Features of the page's metadata; a null has a place of its own."""
    out = [0.0] * (_SOURCES + _LANGS + 4)
    out[0 if source is None else 1 + zlib.crc32(source.encode()) % (_SOURCES - 1)] = 1.0
    out[_SOURCES + (0 if lang is None else 1 + zlib.crc32(lang.encode()) % (_LANGS - 1))] = 1.0
    size = 0.0 if chars is None else float(np.log1p(max(chars, 0)))
    out[-4:] = [float(chars is None), size, size * size / 10, float(size < 5)]
    return out


def co_train(text: np.ndarray, meta: np.ndarray, label: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray,
             rounds: int = ROUNDS, sure: int = SURE) -> tuple[Logistic, Logistic]:
    """The two classifiers after exchanging pseudo-labels. ``sure`` documents of the pool change hands each way in a round."""
    views, pools = (text, meta), (pool_text, pool_meta)
    given = [np.full(len(pool_text), -1.0), np.full(len(pool_text), -1.0)]  # pseudo-labels that each view has been given
    fits = [Logistic(v, label, 1.0) for v in views]
    share = label.mean()
    for _ in range(rounds):
        for view, other in ((0, 1), (1, 0)):
            free = np.flatnonzero(given[other] < 0)
            if not len(free):
                continue
            p = fits[view](pools[view][free])
            order = np.argsort(p, kind="stable")
            low, high = int(sure * (1 - share)), int(sure * share)
            worst, best = order[:low], order[len(order) - high:]
            given[other][free[worst[p[worst] < 0.1]]] = 0.0
            given[other][free[best[p[best] > 0.9]]] = 1.0
        for k in (0, 1):
            new = given[k] >= 0
            fits[k] = Logistic(np.vstack([views[k], pools[k][new]]), np.append(label, given[k][new]), 1.0)
    return fits[0], fits[1]


def joint_fit(logits: np.ndarray, label: np.ndarray, folds: int = 5) -> tuple[Logistic, list[int]]:
    """The regression over the views' scores and the views it uses: the one view that predicts held-back folds best, or both
    where their loss is smaller by over twice its standard error."""
    fold = np.arange(len(label)) % folds

    def losses(used: list[int]) -> np.ndarray:
        out = np.zeros(len(label))
        for k in range(folds):
            rest, own = fold != k, fold == k
            if len(set(label[rest])) == 2:
                p = np.clip(Logistic(logits[rest][:, used], label[rest], 1.0)(logits[own][:, used]), 1e-6, 1 - 1e-6)
                out[own] = -(label[own] * np.log(p) + (1 - label[own]) * np.log(1 - p))
        return out
    alone, lost = min((([k], losses([k])) for k in (0, 1)), key=lambda one: one[1].sum())
    won = lost - losses([0, 1])
    used = [0, 1] if won.mean() > 2 * won.std() / np.sqrt(len(won)) else alone
    return Logistic(logits[:, used], label), used


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


class Model:
    """The two views and their calibrated combination, or a constant where labels of one kind are missing."""

    def __init__(self, views: tuple[Logistic, Logistic] | None = None, joint: tuple[Logistic, list[int]] | None = None,
                 evidence: Evidence | None = None, constant: float = 0.0):
        self.views, self.joint, self.evidence, self.constant = views, joint, evidence, constant

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined score, and those of the views."""
        if self.views is None:
            same = np.full(len(text), self.constant)
            return same, same, same
        one, two = self.views[0](text), self.views[1](meta)
        fit, used = self.joint
        return fit(np.stack([_logit(one), _logit(two)], axis=1)[:, used]), one, two


def _described(docs: DataFrame, extra: list[str]) -> DataFrame:
    """x (text view), g (buckets of words), m (metadata view) and the columns ``extra`` of rows text, source, lang, chars."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            x = [text_view(t.as_py()) for t in batch.column("text")]
            g = [grams(t.as_py(), hashes).tobytes() for t in batch.column("text")]
            m = [metadata_view(*row) for row in zip(*[batch.column(c).to_pylist() for c in ("source", "lang", "chars")])]
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(x, kind), pa.array(g, pa.binary()), pa.array(m, kind), *[batch.column(c) for c in extra]],
                                             names=["x", "g", "m", *extra])
    return docs.mapInArrow(tidied(describe), "x array<double>, g binary, m array<double>" + "".join(f", {c} {kinds[c]}" for c in extra))


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def named(column: str, kind: str) -> Column:
        return (F.col(column) if column in docs.columns else F.lit(None)).cast(kind)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), named("source", "string").alias("source"),
                       named("lang", "string").alias("lang"), named("n_chars", "long").alias("chars"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          each: int = EACH, pool: int = POOL, rounds: int = ROUNDS) -> Model:
    """Fits on labelled rows that are not held out, and on unlabelled ones. Without labels of both kinds scores are constant."""
    chosen = teaching_rows(labels, id_col, label_col, each).select("_id", "label", "half")
    ids = docs.select(F.col(id_col).alias("_id")).filter("_id IS NOT NULL")
    known = labels.select(F.col(id_col).alias("_known"))
    free = ids.join(known, F.col("_id") == F.col("_known"), "left_anti").distinct().orderBy(F.xxhash64("_id"), "_id").limit(pool)
    chosen = stage_table(chosen.union(free.select("_id", F.lit(-1), F.lit(-1))))
    read = _read(docs, id_col, text_col).join(F.broadcast(chosen), F.col("id") == F.col("_id"))
    rows = _described(read.repartition(16), ["label", "half"]).collect()
    rows = sorted(((r["label"], r["half"], r["x"], r["m"], bytes(r["g"])) for r in rows))
    label, half = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    seen = set(label.tolist()) - {-1}
    if len(seen) < 2:
        return Model(constant=float(seen.pop()) if seen else 0.0)
    found = [np.frombuffer(r[4], np.uint16) for r in rows]
    x, m = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    teach, judge, loose = (label >= 0) & (half == 0), (label >= 0) & (half == 1), label < 0
    if len(set(label[teach])) < 2 or len(set(label[judge])) < 2:
        teach = judge = label >= 0
    evidence, words = cross_fitted(found, label, teach)
    x = np.column_stack([x, words])
    views = co_train(x[teach], m[teach], label[teach].astype(float), x[loose], m[loose], rounds) if loose.any() else (
        Logistic(x[teach], label[teach].astype(float), 1.0), Logistic(m[teach], label[teach].astype(float), 1.0))
    both = np.stack([_logit(views[0](x[judge])), _logit(views[1](m[judge]))], axis=1)
    return Model(views, joint_fit(both, label[judge].astype(float)), evidence)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, score, text_score, metadata_score of every row; repeated rows and rows without an id are rows like others."""
    kind = docs.schema[id_col].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            if not len(batch):
                continue
            words = model.evidence or (lambda found: 0.0)
            x = np.array([[*text_view(t.as_py()), words(grams(t.as_py(), hashes))] for t in batch.column("text")])
            m = np.array([metadata_view(*row) for row in zip(*[batch.column(c).to_pylist() for c in ("source", "lang", "chars")])])
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(s) for s in model.scores(x, m)]], names=["id", "score", "text_score", "metadata_score"])
    out = _read(docs, id_col, text_col).mapInArrow(tidied(scored), f"id {kind}, score double, text_score double, metadata_score double")
    return out.withColumnRenamed("id", id_col)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, score (likelihood of label 1), predicted, text_score, metadata_score for every row of ``docs``."""
    out = score(docs, train(docs, labels, id_col, text_col), id_col, text_col)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_score", "metadata_score")
