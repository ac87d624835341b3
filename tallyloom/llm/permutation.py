"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors. A vector is represented by its nearest pivots in order, and posted in the inverted
files of the first few of them. A query visits the files of many of its nearest pivots: queries are few, so replicating them
costs less than posting vectors often. In a file candidates are ranked by footrule distance (sum of differences of pivot
places) and the best share is compared on the original vectors. Long files are split into blocks that queries visit in turn, so
a third of all vectors being equal means more blocks, not a longer one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table, tidied

PIVOTS, ORDER, POST, PROBE = 256, 128, 2, 112
_BLOCK = 4096
_SAMPLE = 4  # rows looked at for each pivot wanted, as copies make one pivot


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec (doubles) of the rows that take part: an id, and finite components that are not all zero, in the most
    common dimension (of equally common ones the largest). Rows repeated whole count once."""
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).filter(
        "id IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0 AND exists(vec, x -> x <> 0) AND "
        "forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    top = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("vec") == (top["d"] if top else 0))


def choose_pivots(rows: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """At most ``pivots`` distinct vectors, those whose hash of the id is smallest."""
    got = rows.orderBy(F.xxhash64("id"), "id").select("vec").limit(pivots * _SAMPLE).collect()
    return np.array(list(dict.fromkeys(tuple(r["vec"]) for r in got))[:pivots], float)


def _nearest(x: np.ndarray, pivots: np.ndarray, order: int) -> np.ndarray:
    """Numbers of the nearest pivots of each row, nearest first."""
    far = (pivots ** 2).sum(axis=1) - 2.0 * x @ pivots.T
    return np.argsort(far, axis=1, kind="stable")[:, :order].astype(np.uint8)


def _places(nearest: np.ndarray, pivots: int) -> np.ndarray:
    """Place of each pivot in each row; pivots not among the nearest share the last place."""
    out = np.full((len(nearest), pivots), nearest.shape[1], np.int16)
    np.put_along_axis(out, nearest.astype(np.int64), np.arange(nearest.shape[1], dtype=np.int16)[None], 1)
    return out


def index(rows: DataFrame, pivots: np.ndarray, order: int = ORDER) -> DataFrame:
    """id, vec (bytes of doubles), near (bytes: the nearest pivots in order)."""
    def represent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                near = _nearest(x, pivots, order)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([v.tobytes() for v in x], pa.binary()),
                                                  pa.array([v.tobytes() for v in near], pa.binary())], names=["id", "vec", "near"])
    return rows.mapInArrow(tidied(represent), "id long, vec binary, near binary")


def _search(pivots: int, share: float, least: int, k: int):
    """Streams blocks: the posted vectors come first, then the queries that visit them, batch by batch."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vecs, places = None, None, None, None
        held: list[pa.RecordBatch] = []

        def answers(part: pa.RecordBatch) -> tuple[list, list, list]:
            out = ([], [], [])
            near = np.stack([np.frombuffer(b, np.uint8) for b in part.column("near").to_pylist()])
            own = _places(near, pivots)
            for q, v, place in zip(part.column("id").to_pylist(), part.column("vec").to_pylist(), own):
                far = np.abs(places - place).sum(axis=1, dtype=np.int64)
                keep = np.lexsort((ids, far))[:max(least, int(np.ceil(share * len(ids))))]
                keep = keep[ids[keep] != q]
                # original vectors, in double precision
                score = np.sqrt(((vecs[keep] - np.frombuffer(v, float)) ** 2).sum(axis=1))
                best = np.lexsort((ids[keep], score))[:k]
                out[0].extend([q] * len(best))
                out[1].extend(ids[keep][best].tolist())
                out[2].extend(score[best].tolist())
            return out

        for batch in batches:
            keys = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("asks").to_pylist()))
            start = 0
            for j in range(1, len(keys) + 1):
                if j < len(keys) and keys[j] == keys[start]:
                    continue
                part, here, asks = batch.slice(start, j - start), keys[start][:2], keys[start][2]
                start = j
                if here != key:
                    key, held, ids = here, [], None
                if not asks:
                    held.append(part)
                    continue
                if held:
                    posted, held = pa.Table.from_batches(held), []
                    ids = posted.column("id").to_numpy()
                    vecs = np.stack([np.frombuffer(b, float) for b in posted.column("vec").to_pylist()])
                    places = _places(np.stack([np.frombuffer(b, np.uint8) for b in posted.column("near").to_pylist()]), pivots)
                if ids is not None:
                    q, v, s = answers(part)
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                                                     names=["query_id", "vec_id", "score"])
    return search


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = PIVOTS,
                       order: int = ORDER, post: int = POST, probe: int = PROBE, share: float = 0.4, least: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest found for each row for which ``is_query(id column)`` holds.

    Score is the Euclidean distance in double precision, ties go to the smaller id, the query's own id is no answer. See
    ``usable`` for rows that take no part; repeated rows count once, an id on several vectors has one answer, its nearest.
    Other columns are not read. Of each visited block the ``share`` nearest by footrule, ``least`` at least, are compared.
    """
    rows = usable(vectors, id_col, vec_col)
    chosen = choose_pivots(rows, pivots)
    spark = vectors.sparkSession
    if not len(chosen):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    count = len(chosen)
    order, post, probe = min(order, count), min(post, count), min(probe, count)
    held = stage_table(index(rows, chosen, order))
    file_of = lambda n: F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda j: F.expr("0") + F.conv(F.hex(F.substring("near", j, 1)), 16, 10).cast("int")))
    posted = held.select("id", "vec", "near", file_of(post).alias("_p", "file"))
    sizes = posted.groupBy("file").count().collect()  # one row per pivot at most
    blocks = spark.createDataFrame([(r["file"], -(-r["count"] // _BLOCK)) for r in sizes], "file int, blocks int")
    posted = posted.join(F.broadcast(blocks), "file").select("file", F.expr("cast(pmod(xxhash64(id), blocks) as int)").alias("block"), F.lit(False).alias("asks"), "id", "vec", "near")
    asking = held.filter(is_query(F.col("id"))).select("id", "vec", "near", file_of(probe).alias("_p", "file")).join(F.broadcast(blocks), "file")
    asking = asking.select("file", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("asks"), "id", "vec", "near")
    dealt = posted.union(asking).repartition("file", "block").sortWithinPartitions("file", "block", "asks")
    found = dealt.mapInArrow(tidied(_search(count, share, least, k)), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
