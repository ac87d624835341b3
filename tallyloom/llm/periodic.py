"""Periodic runs of words by tiles scaled to the period.

Periods fall into octaves [2^k, 2^(k+1)). A run of an octave is at least four periods long, so it holds an *anchor*, a multiple of
S = 2^(k+1), with more than 2^k words that are repeated one period later. A document is exploded into overlapping tiles
around such anchors, S words back and 2.5 S ahead; hashes of blocks, doubled from octave to octave, tell in which octaves and
at which anchors that can be (they miss none), so text without periods makes no tiles. Tiles are rows of their own, dealt over all tasks
whatever document they come from. A tile is solved alone: Z-functions on both sides of its anchor give for every period
the words that agree, hence a fragment of a run, whole or cut off at the tile's border. Fragments are shuffled by document and
period, and those that overlap by a period are stitched; the runs of a document are then put together and taken back to its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, stage_table, tidied

_ROWS = 33           # bits for the number of a row inside its partition
_TOGETHER = 1 << 16  # words of documents whose anchors are found in one sweep
_ODD, _MULT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

Shape = Callable[[object, list[bytes]], list[bytes]]


def block_hashes(ids: np.ndarray) -> np.ndarray:
    """Hashes of single words, to be doubled by ``doubled``."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _ODD
    return (x ^ (x >> np.uint64(29))) * _MULT


def doubled(now: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all blocks of ``2 * width`` words from those of ``width`` words."""
    if len(now) <= width:
        return now[:0]
    x = (now[:-width] ^ (now[:-width] >> np.uint64(31))) * _ODD + now[width:]
    return (x ^ (x >> np.uint64(29))) * _MULT


def _repeated(hashes: np.ndarray, step: int, low: int) -> np.ndarray:
    """Multiples x of ``step`` whose block comes again at a place from x + low to x + 2 * low - 1."""
    # a block against all blocks a period of this octave later, place by place as rows of one table
    whole = max(0, (len(hashes) - 2 * low) // step + 1)
    at = np.arange(whole) * step
    later = np.lib.stride_tricks.as_strided(hashes[low:], (whole, low), (hashes.strides[0] * step, hashes.strides[0]))
    found = at[(later == hashes[at][:, None]).any(axis=1)]
    # blocks near the end have fewer places to come again
    rest = [x for x in range(whole * step, len(hashes) - low, step) if (hashes[x + low:] == hashes[x]).any()]
    return np.append(found, rest).astype(np.int64)


def anchors(ids: np.ndarray, starts: np.ndarray, times: int, least: int) -> Iterator[tuple[int, int, int]]:
    """(document, octave, place in ``ids``) of every tile that can hold a fragment of a run of ``times`` periods and ``least`` words.

    ``ids`` are the words of documents one after another, which begin at ``starts``; anchors are counted from the first word of all,
    so that a document's tiles depend on where it stands, but not the runs they make up. A run of an octave begins at
    most 2^k - 1 words before a multiple of 2^k, where more than 2^(k+1) words are repeated a period later. In
    a document without such a place an octave has no run, and no tiles.
    """
    longest = int(np.diff(np.append(starts, len(ids))).max(initial=0))
    hashes, k = block_hashes(ids), 0
    while max(least, times << k) <= longest:
        longer = doubled(hashes, 1 << k)
        marked = np.unique(np.searchsorted(starts, _repeated(longer, 1 << k, 1 << k), "right"))
        if len(marked):
            places = _repeated(hashes, 2 << k, 1 << k)
            own = np.searchsorted(starts, places, "right")
            at = np.isin(own, marked)
            for doc, x in zip((own[at] - 1).tolist(), places[at].tolist()):
                yield doc, k, x
        hashes, k = longer, k + 1


def tile_bounds(octave: int, anchor: int, n: int) -> tuple[int, int]:
    """First word of a tile and the one after its last."""
    step = 2 << octave
    return max(0, anchor - step), min(n, anchor + 2 * step + step // 2 + 1)


def z_function(s: list[int]) -> list[int]:
    """For each place, how many elements from there on agree with the beginning."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


@lru_cache(maxsize=4096)
def prime_factors(q: int) -> tuple[int, ...]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return tuple(out) + ((q,) if q > 1 else ())


def solve_tile(words: list[int], octave: int, at: int) -> Iterator[tuple[int, int, int]]:
    """(period, start, end) inside a tile of every stretch over its anchor ``at`` whose smallest period is of the octave and
    that repeats at least 2^octave words of the anchor."""
    low, step = 1 << octave, 2 << octave
    ahead = z_function(words[at:])
    back, near = words[:at][::-1], words[:at + step][::-1]
    behind = z_function(back + [-1] + near)
    for q in range(low, min(step, len(ahead))):
        if ahead[q] < low or any(ahead[q // f] >= q - q // f for f in prime_factors(q)):
            continue
        # the word before place at + q, in the second part of the reversed string
        place = len(back) + 1 + len(near) - at - q
        yield q, at - behind[place], at + q + ahead[q]


def _exploded(shape: Shape | None, times: int, least: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        number = TaskContext.get().partitionId() << _ROWS

        def rows():
            nonlocal schema
            held, size = [], 0
            for batch in batches:
                schema = schema or pa.schema([("no", pa.int64()), ("id", batch.schema.field("id").type), ("kept", pa.string()), ("sha", pa.string()),
                                              ("octave", pa.int32()), ("anchor", pa.int64()), ("n", pa.int64()), ("words", pa.binary())])
                for key, text in zip(batch.column("id"), batch.column("text")):
                    key = key.as_py()
                    words = (text.as_py() or "").encode().split()
                    held.append((key, shape(key, words) if shape else words))
                    size += len(words)
                    if size >= _TOGETHER or len(held) >= _TOGETHER // 64:
                        yield from exploded(held)
                        held, size = [], 0
            yield from exploded(held)

        def exploded(docs):
            nonlocal number
            known = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(words for _, words in docs)))}
            starts = np.cumsum([0] + [len(words) for _, words in docs])
            ids = np.fromiter(map(known.__getitem__, chain.from_iterable(words for _, words in docs)), np.int32, int(starts[-1]))
            tiled = set()
            for doc, k, x in anchors(ids, starts[:-1], times, least):
                first, n = int(starts[doc]), int(starts[doc + 1] - starts[doc])
                lo, hi = tile_bounds(k, x - first, n)
                tiled.add(doc)
                yield number + doc, None, None, None, k, x - first, n, ids[first + lo:first + hi].tobytes()
            for doc, (key, words) in enumerate(docs):
                joined = b" ".join(words)
                yield number + doc, key, joined.decode() if texts or doc in tiled else None, hashlib.sha256(joined).hexdigest(), None, None, None, None
            number += len(docs)

        stream = rows()
        first = next(stream, None)
        if first is not None:
            yield from arrow_batches(chain([first], stream), schema, weight=lambda r: len(r[2] or r[7] or ""))
    return run


_FRAGMENT = pa.schema([("no", pa.int64()), ("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _solved(times: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for no, k, x, n, raw in zip(*(batch.column(c) for c in ("no", "octave", "anchor", "n", "words"))):
                    no, k, x, n = no.as_py(), k.as_py(), x.as_py(), n.as_py()
                    lo, hi = tile_bounds(k, x, n)
                    for q, start, end in solve_tile(np.frombuffer(raw.as_py(), np.int32).tolist(), k, x - lo):
                        start, end = start + lo, end + lo
                        cut = (start == lo and lo > 0) or (end == hi and hi < n)
                        if cut or end - start >= max(least, times * q):
                            yield no, q, start, end
        yield from arrow_batches(rows(), _FRAGMENT)
    return run


def stitched(fragments: DataFrame, times: int = 4, least: int = 6) -> DataFrame:
    """no, period, start, length of the runs that ``fragments`` (no, period, start, end) make up.

    Fragments of one document and period belong together where they overlap by a period or more; two runs never do.
    """
    order = Window.partitionBy("no", "period").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col("start") > reach - F.col("period")).cast("int"), F.lit(1))
    numbered = fragments.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy("no", "period", "run").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"))
    return runs.filter(F.col("length") >= F.greatest(F.lit(least), times * F.col("period"))).select("no", "period", "start", "length")


_COLLAPSED = "no long, collapsed string"


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words that a run holds after its first period."""
    schema = pa.schema([("no", pa.int64()), ("collapsed", pa.string())])

    def rows():
        for batch in batches:
            for no, text, runs in zip(batch.column("no"), batch.column("kept"), batch.column("runs")):
                words = text.as_py().split(" ")
                edges = np.zeros(len(words) + 1, np.int64)
                for r in runs.as_py() or ():
                    edges[r["start"] + r["period"]] += 1
                    edges[r["start"] + r["length"]] -= 1
                stays = np.cumsum(edges)[:-1] == 0
                yield no.as_py(), " ".join([words[i] for i in np.flatnonzero(stays)])
    yield from arrow_batches(rows(), schema, weight=lambda r: len(r[1]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = 4, least: int = 6,
                  shape: Shape | None = None, texts: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256.

    A run is a stretch of words with smallest period q and at least ``max(least, times * q)`` words that no word next to it
    extends; ``times`` is 4 or more. start, length, period and exponent_milli are of the longest run (ties: the first,
    then the smallest period), null where there is none. Collapsed is the text without the words that some run holds after its
    first period, joined by single spaces; ``texts`` adds it and the runs (array of start, length, period).
    ``shape(id, words)`` may put other words in the place of a document's. A null or blank text has no words and no runs. Rows with
    a null id or the id of another row count for themselves. Other columns are not read. An empty table gives no rows.
    """
    if times < 4:
        raise ValueError("tiles are made for runs of four periods or more")
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = stage_table(own.mapInArrow(tidied(_exploded(shape, times, least, texts)),
                                      f"no long, id {kind}, kept string, sha string, octave int, anchor long, n long, words binary"))
    tiles = rows.filter(F.col("octave").isNotNull()).select("no", "octave", "anchor", "n", "words").repartition("no", "octave", "anchor")
    runs = stitched(tiles.mapInArrow(tidied(_solved(times, least)), "no long, period long, start long, end long"), times, least)
    listed = F.array_sort(F.collect_list(F.struct("start", "period", "length")))
    best = F.min_by(F.struct("start", "length", "period"), F.struct((-F.col("length")).alias("l"), "start", "period"))
    per = stage_table(runs.groupBy("no").agg(F.count("*").alias("n_runs"), best.alias("best"), listed.alias("runs")))

    # both sides grow with the documents, so they are shuffled at every size
    held = rows.filter(F.col("kept").isNotNull()).select("no", "kept").join(per.select("no", "runs").hint("merge"), "no")
    collapsed = held.mapInArrow(tidied(_collapse), _COLLAPSED)
    if not texts:
        collapsed = collapsed.select("no", F.sha2("collapsed", 256).alias("collapsed_sha256"))
    else:
        collapsed = collapsed.withColumn("collapsed_sha256", F.sha2("collapsed", 256))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    written = F.concat(F.array_join(F.transform("runs", line), "\n"), F.lit("\n"))
    facts = per.select("no", "n_runs", "best.start", "best.length", "best.period", F.sha2(F.coalesce(written, F.lit("")), 256).alias("runs_sha256"),
                       *(["runs"] if texts else []))
    heads = rows.filter(F.col("octave").isNull()).select("no", "id", "sha", *(["kept"] if texts else []))
    out = heads.join(facts.join(collapsed, "no"), "no", "left")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_runs", F.lit(0)).cast("long").alias("n_runs"), "start", "length", "period",
        F.floor(1000 * F.col("length") / F.col("period")).cast("long").alias("exponent_milli"),
        F.coalesce("runs_sha256", F.sha2(F.lit(""), 256)).alias("runs_sha256"), F.coalesce("collapsed_sha256", "sha").alias("collapsed_sha256"),
        *([F.coalesce("runs", F.array()).alias("runs"), F.coalesce("collapsed", "kept").alias("collapsed")] if texts else []))
