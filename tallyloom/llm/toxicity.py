"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary text, one on windows that recur in toxic text and are all but
absent from ordinary text. A window is a word; it is compressed with the ordinary dictionary and with both, and the pair
(length with the toxic dictionary, length saved by it) falls in a cell whose likelihood ratio is calibrated on labelled
windows. A logistic regression on a document's strongest windows and on the share of suspect ones gives its score. Bytes are
spelled as four-byte codes before compression, so that one short word is long enough for zstandard to show what it saves.
Dictionaries and calibration use a bounded sample of labelled documents (``each`` of either label); scores use whole texts. What
the dictionaries are chosen from is bounded by ``Teaching``, as one process trains them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, stage_table, tidied
from .learn import Logistic, held_out, teaching_rows

EACH = 6000            # documents of either label that teach
_TOXIC, _ORDINARY = 32 << 10, 96 << 10   # bytes of the dictionaries
_LEVEL = 19            # only the optimal parser finds every match of a short window
_WINDOW = 40           # bytes of the longest window; a longer word is several
_KNOWN = 400_000       # windows a worker remembers, from one task to the next
_LONG, _SAVED = 40, 18  # cells: compressed length, bytes saved
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]{1,%d}" % _WINDOW)


@dataclass(frozen=True)
class Teaching:
    """What the dictionaries learn from: the windows in most documents of a label, each as often as documents have it, up to a bound.

    A window is toxic if it stands in a share of ``recurs`` of the toxic documents, at least in three, and is ``odds`` times as
    frequent in those as in ordinary ones; other windows that two ordinary documents have are ordinary.
    """

    toxic_windows: int = 4000
    ordinary_windows: int = 60_000
    toxic_copies: int = 50
    ordinary_copies: int = 20
    recurs: float = 0.005
    odds: int = 20


_CODES = [hashlib.sha256(bytes([b])).digest()[:4] for b in range(256)]


def windows(text: str | None) -> list[bytes]:
    return _WORDS.findall((text or "").encode().lower())


def _spelled(window: bytes) -> bytes:
    return b"".join([_CODES[b] for b in b" " + window + b" "])


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(level=_LEVEL)
    return zstandard.ZstdCompressor(dict_data=known, level=_LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)


class Cells(Remembered):
    """Cell of each window: what it compresses to with the toxic dictionary, and what that saves."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        super().__init__(_KNOWN)
        self.dictionaries = ordinary, toxic
        # the ordinary content stands next to the window in both, so ordinary matches cost the same
        self.plain, self.both = _compressor(ordinary), _compressor(toxic + ordinary)

    def compute(self, window: bytes) -> int:
        spelled = _spelled(window)
        long = len(self.both.compress(spelled))
        saved = len(self.plain.compress(spelled)) - long
        return min(long, _LONG - 1) * _SAVED + min(max(saved, -2), _SAVED - 3) + 2

    def of(self, text: str | None) -> np.ndarray:
        found = windows(text)
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


_last: Cells | None = None  # of this worker; what a window gives depends on the dictionaries alone


def remembered_cells(ordinary: bytes, toxic: bytes) -> Cells:
    """The cells of these dictionaries, with what the worker's earlier tasks have found; those of other dictionaries go."""
    global _last
    if _last is None or _last.dictionaries != (ordinary, toxic):
        _last = Cells(ordinary, toxic)
    return _last


def _trained(size: int, frequencies: list[tuple[bytes, int]], most: int) -> bytes:
    """A dictionary of windows, each given as often as it occurs up to ``most`` times, in an order drawn by hash."""
    spelled = [_spelled(w) for w, _ in frequencies]  # one object for all copies of a window
    copies = [(int.from_bytes(hashlib.md5(b"%d:%s" % (k, w)).digest()[:8]), i) for i, (w, n) in enumerate(frequencies) for k in range(min(n, most))]
    copies = np.array(copies, [("hash", "u8"), ("window", "i4")])
    samples = [spelled[i] for i in copies["window"][np.argsort(copies["hash"], kind="stable")].tolist()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to choose from: take what there is
        return b"".join(samples)[:size] or b"\0" * 8


class Model:
    """Dictionaries, likelihood ratios of cells, and the regression; all of bounded size."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic, self.ratios, self.fit, self.constant = ordinary, toxic, np.zeros(_LONG * _SAVED), None, None

    def cells(self) -> Cells:
        return remembered_cells(self.ordinary, self.toxic)

    def features(self, cells: np.ndarray) -> np.ndarray:
        """Ratios of the three strongest windows, and suspect windows by the root of all."""
        if not len(cells):
            return np.zeros(4)
        ratios = self.ratios[cells]
        top = np.sort(ratios)[::-1][:3]
        return np.append(np.pad(top, (0, 3 - len(top))), (ratios > 1.5).sum() / np.sqrt(len(cells)))

    def score(self, cells: np.ndarray) -> float:
        return self.constant if self.fit is None else float(self.fit(self.features(cells)[None])[0])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", each: int = EACH,
          teaching: Teaching = Teaching()) -> Model:
    """Fits on labelled documents that are not held out, ``each`` of either label at most; ``teaching`` bounds the dictionaries.

    Without documents of both labels the score is the share of toxic ones among those there are, 0 without any.
    """
    chosen = stage_table(teaching_rows(labels, id_col, label_col, each))
    read = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    sample = stage_table(read.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("text", "label", "half"))
    count = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    bad, good = count.get(1, 0), count.get(0, 0)
    if not bad or not good:
        model = Model(b"\0" * 8, b"\0" * 8)
        model.constant = bad / (bad + good) if bad + good else 0.0
        return model

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                found = list(set(windows(text)))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([label] * len(found), pa.int32())], names=["w", "label"])

    seen = stage_table(sample.select("text", "label").mapInArrow(tidied(distinct), "w binary, label int")
                       .groupBy("w").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good")))
    least = max(3, int(bad * teaching.recurs))
    recurs = f"bad >= {least} AND good * {bad} * {teaching.odds} <= bad * {good}"
    toxic = seen.filter(recurs).orderBy(F.desc("bad"), "w").limit(teaching.toxic_windows).collect()
    plain = seen.filter(f"good >= 2 AND NOT ({recurs})").orderBy(F.desc("good"), "w").limit(teaching.ordinary_windows).collect()
    model = Model(_trained(_ORDINARY, [(bytes(r["w"]), r["good"]) for r in plain], teaching.ordinary_copies),
                  _trained(_TOXIC, [(bytes(r["w"]), r["bad"]) for r in toxic], teaching.toxic_copies))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, total = model.cells(), np.zeros((2, _LONG * _SAVED), np.int64)
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                total[label] += np.bincount(cells.of(text), minlength=total.shape[1])
        label, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int32)), pa.array(cell), pa.array(total[label, cell])], names=["label", "cell", "n"])

    spread = sample.repartition(16)
    total = np.full((2, _LONG * _SAVED), 0.5)
    for r in spread.filter("half = 0").select("text", "label").mapInArrow(tidied(counted), "label int, cell long, n long").groupBy("label", "cell").agg(F.sum("n").alias("n")).collect():
        total[r["label"], r["cell"]] += r["n"]
    model.ratios = np.log(total[1] / total[1].sum()) - np.log(total[0] / total[0].sum())

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = model.cells()
        for batch in batches:
            rows = [model.features(cells.of(t)).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("label")], names=["x", "label"])
    rows = spread.filter("half = 1").select("text", "label").mapInArrow(tidied(described), "x array<double>, label int").collect()
    if len({r["label"] for r in rows}) < 2:
        rows = spread.select("text", "label").mapInArrow(tidied(described), "x array<double>, label int").collect()
    rows = sorted((r["label"], *r["x"]) for r in rows)  # one order in every run
    model.fit = Logistic(np.array([r[1:] for r in rows]), np.array([r[0] for r in rows], float))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, score (0 to 1) of every row; null and empty texts score as texts without windows. Other columns are not read."""
    kind = docs.schema[id_col].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = model.cells()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([model.score(cells.of(t.as_py())) for t in batch.column("text")], pa.float64())],
                                             names=["id", "score"])
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return read.mapInArrow(tidied(scored), f"id {kind}, score double").withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, score, predicted for every row of ``docs``."""
    scores = score(docs, train(docs, labels, id_col, text_col), id_col, text_col)
    return scores.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under 0.5, all columns unchanged."""
    model = train(docs, labels, id_col, text_col)
    schema = docs.schema

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = model.cells()
        at = schema.fieldNames().index(text_col)
        for batch in batches:
            yield batch.filter(pa.array([model.score(cells.of(t.as_py())) < 0.5 for t in batch.column(at)], pa.bool_()))
    return docs.mapInArrow(tidied(kept), schema)
