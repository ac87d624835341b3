"""Passages that repeat across documents, by a sparse suffix array.

Of each document's suffixes (by words) those are retained that begin at minimisers: where the hash of the next ``_GRAM`` words is
the smallest of a window sized so that any passage of ``least`` words holds one, the same one in every copy. A suffix carries the
hashes of the passages of ``least`` words whose minimiser it is, one per word of the document. Suffixes are sorted by the hash of
their first words; equal ones are runs, and a run of more than one document is parted by the passages' hashes. Each such group is
one passage of ``least`` words: its smallest id is the other document of all members but its own, whose other one is the next
smallest. So a run costs what its passages are, however many documents share one, and none is left out. A run of more suffixes
than are held at once leaves its passages to a second shuffle by passage. Periodic words repeat a suffix with its passages; such
repeats are one row with their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table, tidied
from .shingles import WordHashes, mix

LEAST = 50
_GRAM = 24
_RUN = 16_384  # suffixes of a run held at once
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Prefixes:
    """Hashes of any stretch of a document's words, from sums of scaled word hashes."""

    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, words: np.ndarray):
        n = len(words)
        if len(Prefixes._powers) < n + 1:
            size = max(n + 1, 2 * len(Prefixes._powers))
            Prefixes._powers = np.append(np.uint64(1), np.full(size - 1, _BASE).cumprod(dtype=np.uint64))
            Prefixes._inverse = np.append(np.uint64(1), np.full(size - 1, np.uint64(pow(int(_BASE), -1, 1 << 64))).cumprod(dtype=np.uint64))
        self.sums = np.append(np.uint64(0), (words * Prefixes._powers[:n]).cumsum(dtype=np.uint64))

    def all(self, length: int) -> np.ndarray:
        """Hashes of ``length`` words from each start that has so many."""
        return mix((self.sums[length:] - self.sums[:-length]) * Prefixes._inverse[:len(self.sums) - length])


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Of each window of ``window`` values the position of the smallest; the leftmost of equal ones."""
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    return views.argmin(axis=1) + np.arange(len(views))


def _retained(words: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Of each retained suffix its key, its first passage, how often it stands there in a row and its number of passages; and the
    passages' hashes, suffix by suffix."""
    sums = Prefixes(words)
    grams, passages = sums.all(_GRAM), sums.all(least)
    at = minimisers(grams, least - _GRAM + 1)  # one per passage, never falling
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    key, sizes = grams[at[first]], np.diff(np.append(first, len(at)))
    again = np.append(False, (key[1:] == key[:-1]) & (sizes[1:] == sizes[:-1]))
    if not again.any():
        return key, first, np.ones(len(first), np.int64), sizes, passages
    earlier = np.arange(len(at)) - np.repeat(sizes, sizes)
    again &= np.logical_and.reduceat((earlier >= 0) & (passages == passages[np.maximum(earlier, 0)]), first)
    lead = np.flatnonzero(~again)
    return key[lead], first[lead], np.diff(np.append(lead, len(first))), sizes[lead], passages[np.repeat(~again, sizes)]


def suffixes(docs: DataFrame, id_col: str, text_col: str, least: int = LEAST) -> DataFrame:
    """key, id, start, times, passages: retained suffixes with the hashes (64 bits each) of the passages from ``start`` on."""

    def retain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out, size = [], 0
            for key, text in zip(batch.column("id"), batch.column("text")):
                words = hashes.of(text.as_py(), lower=False)
                if len(words) < least:
                    continue
                out.append((*_retained(words, least), np.full(1, key.as_py(), np.int64)))
                size += len(words)
                if size > 500_000:
                    yield _columns(out)
                    out, size = [], 0
            if out:
                yield _columns(out)
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    return read.mapInArrow(tidied(retain), "key long, id long, start long, times long, passages binary")


def _columns(parts: list[tuple]) -> pa.RecordBatch:
    key, start, times, sizes, passages, ids = (np.concatenate(c) for c in zip(*parts))
    ids = np.repeat(ids, [len(p[0]) for p in parts])
    ends = np.append(0, 8 * sizes.cumsum()).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids), pa.array(start), pa.array(times),
                                       pa.Array.from_buffers(pa.binary(), len(key), [None, pa.py_buffer(ends), pa.py_buffer(passages)])],
                                      names=["key", "id", "start", "times", "passages"])


_SPANS = ["key", "passage", "id", "start", "stop", "other"]


def _passages(rows: pa.Table, least: int) -> tuple[np.ndarray, ...]:
    """key, passage, id, start, stop of each passage of suffixes; where a suffix is repeated, the repeats overlap in one stretch."""
    key, ids, start, times = (rows.column(c).to_numpy() for c in ("key", "id", "start", "times"))
    column = rows.column("passages").combine_chunks()
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    hashes = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(np.int64)
    sizes = np.diff(ends) // 8
    row = np.repeat(np.arange(len(key)), sizes)
    begin = start[row] + np.arange(len(row)) - (ends[:-1] - ends[0])[row] // 8
    return key[row], hashes, ids[row], begin, begin + ((times - 1) * sizes)[row] + least


def _linked(rows: pa.Table, least: int) -> pa.RecordBatch | None:
    """Stretches of whole runs, sorted by key, that stand in another document too, with the smallest id of those."""
    key, ids = rows.column("key").to_numpy(), rows.column("id").to_numpy()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    shared = np.minimum.reduceat(ids, first) < np.maximum.reduceat(ids, first)
    if not shared.any():
        return None
    columns = _passages(rows.filter(pa.array(np.repeat(shared, np.diff(np.append(first, len(key)))))), least)
    order = np.lexsort((columns[2], columns[1], columns[0]))
    key, passage, ids, start, stop = (c[order] for c in columns)
    new = np.append(True, (key[1:] != key[:-1]) | (passage[1:] != passage[:-1]))
    group, first = new.cumsum() - 1, np.flatnonzero(new)
    own = ids == ids[first][group]
    following = first + np.add.reduceat(own.astype(np.int64), first)  # place of the second smallest id
    several = following < np.append(first[1:], len(ids))
    other = np.where(own, ids[np.where(several, following, 0)][group], ids[first][group])
    keep = np.flatnonzero(several[group])
    if not len(keep):
        return None
    keep = keep[np.lexsort((start[keep], other[keep], ids[keep]))]
    ids, start, stop, other = ids[keep], start[keep], stop[keep], other[keep]
    head = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (other[1:] != other[:-1]) | (start[1:] > stop[:-1])))
    none = pa.nulls(len(head), pa.int64())
    return pa.RecordBatch.from_arrays([none, none, pa.array(ids[head]), pa.array(start[head]), pa.array(np.maximum.reduceat(stop, head)), pa.array(other[head])],
                                      names=_SPANS)


def _grouped(least: int, most: int):
    """Stretches with their other document; of runs over ``most`` suffixes the passages without it. Rows come sorted by key."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, long = [], 0, None

        def left(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            for start in range(0, len(rows), most):
                columns = _passages(rows.slice(start, most), least)
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(columns[0]), pa.int64())], names=_SPANS)

        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size < most:
                continue
            rows = pa.Table.from_batches(held)
            key = rows.column("key").to_numpy()
            begin = int(np.searchsorted(key, long, "right")) if long is not None else 0
            yield from left(rows.slice(0, begin))
            cut = int(np.searchsorted(key, key[-1]))
            if cut <= begin and len(key) - begin >= most:  # one run fills what is held
                yield from left(rows.slice(begin))
                cut, long = len(key), key[-1]
            elif cut > begin and (out := _linked(rows.slice(begin, cut - begin), least)) is not None:
                yield out
            held = rows.slice(max(cut, begin)).to_batches()
            size = sum(map(len, held))
        if size:
            rows = pa.Table.from_batches(held)
            begin = int(np.searchsorted(rows.column("key").to_numpy(), long, "right")) if long is not None else 0
            yield from left(rows.slice(0, begin))
            if begin < len(rows) and (out := _linked(rows.slice(begin), least)) is not None:
                yield out
    return match


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, held: int = _RUN) -> DataFrame:
    """``id_col``, start_word, n_words, other_id: stretches of words of a document that stand in another one too.

    A stretch is a union of passages of ``least`` words, each equal word by word (case counts, white space does not; compared
    through a 64-bit hash of the passage and another one of ``_GRAM`` words in it) to one in another document; ``other_id`` is
    the smallest id of those. Rows without an id or text take no part, documents with fewer words have none; rows repeated with
    one id are one document. Other columns are not read. At least ``_GRAM`` + 1 words must be asked for. ``held`` suffixes that
    begin alike are held at once; it does not change the result.
    """
    if least <= _GRAM:
        raise ValueError(f"least must exceed {_GRAM}")
    dealt = suffixes(docs, id_col, text_col, least).repartition("key").sortWithinPartitions("key")
    found = stage_table(dealt.mapInArrow(tidied(_grouped(least, held)), ", ".join(f"{c} long" for c in _SPANS)))
    left = found.filter("other IS NULL")
    groups = left.groupBy("key", "passage").agg(F.min("id").alias("lowest"), F.max("id").alias("_highest")).filter("lowest < _highest")
    members = left.drop("other").join(groups.drop("_highest"), ["key", "passage"])
    following = members.filter("id > lowest").groupBy("key", "passage").agg(F.min("id").alias("following"))
    linked = members.join(following, ["key", "passage"]).withColumn("other", F.expr("IF(id = lowest, following, lowest)"))
    columns = ["id", "start", "stop", "other"]
    spans = found.filter("other IS NOT NULL").select(*columns).union(linked.select(*columns))
    order = Window.partitionBy("id").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", (reach.isNull() | (F.col("start") > reach)).cast("int"))
    marked = marked.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = marked.groupBy("id", "part").agg(F.min("start").alias("start_word"), (F.max("stop") - F.min("start")).alias("n_words"), F.min("other").alias("other_id"))
    return out.select(F.col("id").alias(id_col), "start_word", "n_words", "other_id")
