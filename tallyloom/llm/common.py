"""What several operators share: Arrow output, staging, distributed prefix sums."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, stage_table

# A word is a longest run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "Remembered", "arrow_batches", "bounded_batches", "cut_lineage", "fresh", "prefix_sums", "stage_table", "texts_of", "tidied"]


def arrow_batches(rows: Iterable[tuple], schema: pa.Schema, most_rows: int = 4096, most_bytes: int = 16 << 20,
                  weight=None) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of bounded length and, where ``weight(row)`` is given, bounded bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row) if weight else 0
        if len(held) >= most_rows or size >= most_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


class Remembered(dict):
    """What a function gave for recent arguments, in bounded memory.

    Two generations of ``most / 2`` entries: what is asked for again moves to the younger one, the older one goes.
    """

    def __init__(self, most: int):
        super().__init__()
        self.half, self.old = most // 2, {}

    def compute(self, key):
        raise NotImplementedError

    def make_room(self, coming: int = 1) -> None:
        if len(self) + coming > self.half:
            self.old = dict(self)
            self.clear()

    def __missing__(self, key):
        self.make_room()
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches of 1000 rows where the session has Spark's default of 10,000.

    Rows here are whole texts; a batch lies in an executor's memory outside its heap, and once more in the Python worker.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")
    return spark


def tidied(task):
    """A task for mapInArrow that gives freed memory back to the system when it ends.

    Python workers live on from task to task, next to the executor's heap; what one leaves unused in its pools would count
    against the memory of the next.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
    return run


def fresh(name: str) -> str:
    """A column name that no table of the user has."""
    return f"{name}_{uuid.uuid4().hex}"


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[str | None]:
    """The texts of a batch one by one, so that they are not all in Python at once."""
    return (cell.as_py() for cell in batch.column(column))


def prefix_sums(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds to each row, for each name in ``sums``, the total of that column over all rows before it in ``order``.

    Rows are range-partitioned by sampled splitters; a window runs inside each partition, and another over one row per
    partition gives the offsets. ``order`` must be total. The result is staged once, as splitters may differ between runs.
    """
    held = stage_table(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = held.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    parts = parts.select("_part", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums])
    out = held.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(n) for n, c in sums.items()]).join(parts, "_part")
    return out.withColumns({n: F.col(n) + F.col(f"_o_{n}") for n in sums}).drop("_part", *[f"_o_{n}" for n in sums])
