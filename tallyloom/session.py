"""Session helpers: runtime tuning and the place for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings the operators rely on. All are plain SQL settings, so they
# can be applied to a session somebody else has started.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where that costs one more shuffle later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stage tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, which
    has a single machine anyway, may fall back on a fresh temporary folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current is not None:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
    return sc.getCheckpointDir()


_staged: ContextVar[list | None] = ContextVar("staged", default=None)


@contextmanager
def emptied_stages() -> Iterator[None]:
    """Stage tables written inside are emptied at the end, also after an error.

    They may hold person keys. What is needed of them must be written elsewhere before the end.
    """
    mine: list[tuple[str, DataFrame]] = []
    token = _staged.set(mine)
    try:
        yield
    finally:
        _staged.reset(token)
        for path, table in mine:
            table.sparkSession.createDataFrame([], table.schema).write.mode("overwrite").parquet(path)


def stage_table(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and go on from that table.

    Used where a wide result is read more than once: later steps read only the columns they need,
    know the size of the table, and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    if (mine := _staged.get()) is not None:
        mine.append((path, df))  # before the write, which may fail half way
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Bytes of the largest method that HotSpot compiles; larger ones are interpreted for every row.
COMPILED_METHOD = 8000
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """What runs inside generates no method for a pipeline that is too large to be compiled.

    Such a pipeline is evaluated operator by operator instead, whose methods Spark keeps small.
    """
    before = spark.conf.get(_METHOD_LIMIT)
    spark.conf.set(_METHOD_LIMIT, COMPILED_METHOD)
    try:
        yield
    finally:
        spark.conf.set(_METHOD_LIMIT, before)


def compiled_apart(df: DataFrame) -> DataFrame:
    """The same rows; what comes before and what comes after are methods of their own.

    Counting the rows on their way is an operator that Spark does not fuse with others, and it needs no shuffle.
    """
    return df.observe(f"rows-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, for the small state of an iteration."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
