"""Reading and writing tables."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaError(ValueError):
    """A table lacks something that its users need."""


def require_columns(df: DataFrame, required: Iterable[str], what: str = "table") -> DataFrame:
    """Fail at plan time when required columns are absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaError(f"{what} lacks columns: {', '.join(missing)}")
    return df


def scan_table(spark: SparkSession, path: str, required: Sequence[str] = (), columns: Sequence[str] | None = None,
               fmt: str = "parquet", schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Scan a Parquet or CSV table, checking its columns and reading only the ones asked for."""
    reader = spark.read.format(fmt).options(**({"header": True} if fmt == "csv" else {}) | options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
    except AnalysisException as exc:
        raise SchemaError(f"no readable table at {path}") from exc
    require_columns(df, [*required, *(columns or [])], path)
    return df.select(*columns) if columns else df


def scan_table_set(tables: Mapping[str, DataFrame], source_column: str = "source") -> DataFrame:
    """Stack a named set of tables by column name; absent columns become NULL."""
    tagged = [df.select(F.lit(name).alias(source_column), "*") for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("surv_id",), rows_per_file: int = 5_000_000,
                      rebalance: bool = False) -> None:
    """Write Parquet partitioned by ``by``, replacing only the partitions present in ``df``.

    Files are limited by row count; there is no shuffle to one task per partition value,
    so one large edition is written by as many tasks as hold its rows. With ``rebalance`` rows of
    one value meet in few files, and a large value is still split over several tasks.
    """
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in by])
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", rows_per_file)
       .partitionBy(*by).parquet(path))


def publish_by_key(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = ()) -> None:
    """Publish many small tables (code lists, margins) as one table, partitioned by key.

    The schema is kept with the table, as folder names lose the types of keys. A table that gains columns keeps the ones it had;
    a column that changes its type is an error.
    """
    spark = df.sparkSession
    known = published_schema(spark, path)
    fields = {f.name: f for f in known.fields} if known else {}
    changed = [f.name for f in df.schema if f.name in fields and fields[f.name].dataType != f.dataType]
    if changed:
        raise SchemaError(f"columns of {path} with another type: {', '.join(changed)}")
    if not known or any(f.name not in fields for f in df.schema):
        merged = T.StructType([T.StructField(f.name, f.dataType) for f in {**fields, **{f.name: f for f in df.schema}}.values()])
        spark.createDataFrame([(merged.json(),)], "value string").coalesce(1).write.mode("overwrite").text(_schema_path(path))
    df = df.hint("rebalance", *[F.col(k) for k in keys])
    if order:
        df = df.sortWithinPartitions(*keys, *order)
    write_partitioned(df, path, keys)


def _schema_path(path: str) -> str:
    return f"{path.rstrip('/')}/_schema"


def published_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept with a published table, if there is one."""
    try:
        kept = spark.read.text(_schema_path(path), wholetext=True).first()
    except AnalysisException:
        return None
    return T.StructType.fromJson(json.loads(kept[0])) if kept else None


def read_published(spark: SparkSession, path: str, drop_empty: bool = False, **key) -> DataFrame:
    """Read one published table back; partition pruning leaves only its own files.

    Columns have the types they were published with, keys that are not asked for too; in a table without kept schema
    keys have the type that their folder names suggest. With ``drop_empty`` the columns that hold no value for this key are left
    out, which takes one aggregate over the pruned files.
    """
    schema = published_schema(spark, path)
    df = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    for name, value in key.items():
        df = df.where(F.col(name) == F.lit(value).cast(df.schema[name].dataType)).drop(name)
    return drop_empty_columns(df) if drop_empty else df


def drop_empty_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Leave out the columns in which every row is NULL."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if c in keep or counts[c] > 0])


def write_csv(df: DataFrame, path: str) -> None:
    """Write a delimited text table with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)
