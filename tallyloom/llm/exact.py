"""Exact de-duplication by content sort.

Rows are range-partitioned by sampled splitters over (first characters, 64-bit hash, id) of the normalised text, sorted inside
each partition by the same columns with the whole text before the id, and compared in full with the row before. Splitters
stay short however long the texts are, and the id in the key spreads one text that a third of all rows share over partitions.
Runs that cross a partition boundary are joined afterwards by grouping the whole texts of the first and last run of each
partition, two rows per partition at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, fresh, stage_table, tidied

_PREFIX = 32  # characters of the text in a splitter
_RUNS = 33    # bits for the number of a row or run inside its partition


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per input row, and at the end one with the text of the last run; texts only at the two ends."""
    schema = None

    def rows():
        nonlocal schema
        base = TaskContext.get().partitionId() << _RUNS
        pos = run = base - 1
        last = digest = None
        for batch in batches:
            schema = schema or pa.schema([("id", batch.schema.field("id").type), ("pos", pa.int64()), ("run", pa.int64()),
                                          ("digest", pa.binary()), ("edge", pa.string())])
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                pos += 1
                edge = None
                if text != last:
                    run += 1
                    last, digest = text, hashlib.sha256(text.encode()).digest()
                    edge = text if run == base else None
                yield key, pos, run, digest, edge
        if run > base:
            yield None, None, run, digest, last

    stream = rows()
    first = next(stream, None)
    if first is not None:
        def chained():
            yield first
            yield from stream
        yield from arrow_batches(chained(), schema, weight=lambda r: len(r[4] or ""))


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                 normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised forms are identical (``normalise`` maps a text column; none changes nothing);
    a null text counts as empty, and empty texts equal one another. Of equal texts the row with the smallest id stays
    (``keep="max"``: the largest). A null id loses to any other; where all ids are null, or an id occurs more than once,
    exactly one row stays. Other columns are not read. An empty table gives no rows.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = F.coalesce(normalise(text), F.lit("")) if normalise else text
    key = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    key = key.select(F.substring("text", 1, _PREFIX).alias("prefix"), F.xxhash64("text").alias("hash"), "text", "id")
    by_id = F.col("id").asc_nulls_first() if keep == "max" else F.col("id").asc_nulls_last()
    dealt = key.repartitionByRange("prefix", "hash", by_id).sortWithinPartitions("prefix", "hash", "text", by_id)
    kind = docs.schema[id_col].dataType.simpleString()
    marked = stage_table(dealt.select("id", "text").mapInArrow(tidied(_runs), f"id {kind}, pos long, run long, digest binary, edge string"))

    edges = marked.filter(F.col("edge").isNotNull()).select("run", "edge")
    roots = edges.groupBy("edge").agg(F.min("run").alias("root"))
    merged = edges.join(roots, "edge").filter("run <> root").select("run", "root").distinct()
    rows = (marked.filter(F.col("pos").isNotNull()).join(merged, "run", "left")
            .select("id", "pos", "digest", F.coalesce("root", "run").alias("class")))
    choose = F.max if keep == "max" else F.min
    groups = rows.groupBy("class").agg(F.count("*").alias("group_size"), choose("id").alias("keep_id"), choose("pos").alias("keep_pos"))
    return rows.join(groups, "class").select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("pos") == F.col("keep_pos")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of ``docs`` that stay, all their columns unchanged.

    An id that content_sort keeps once may stand on several rows: of rows with the same id and text one stays.
    """
    # the text of a dropped row is that of a kept one, so a row is known by its id and digest
    key, sha, other_key, other_sha = (fresh(n) for n in ("id", "sha", "id", "sha"))
    named = [F.col(id_col).alias(key), F.col("text_sha256").alias(sha)]
    ordered = content_sort(docs, id_col, text_col, keep)
    gone = stage_table(ordered.filter("NOT kept").select(*named))
    both = F.col(key).eqNullSafe(F.col(other_key)) & (F.col(sha) == F.col(other_sha))
    twice = stage_table(ordered.filter("kept").select(*named).join(gone.toDF(other_key, other_sha), both, "left_semi"))
    match = F.col(id_col).eqNullSafe(F.col(key)) & (F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256) == F.col(sha))
    stays = docs.join(gone, match, "left_anti")
    if twice.isEmpty():
        return stays
    # a whole row repeated, id included: one of its copies comes back
    return stays.unionByName(docs.join(twice, match, "left_semi").dropDuplicates([id_col, text_col]))
