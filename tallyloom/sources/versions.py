"""Tables published whole: a version is readable only once all of it is there.

A version is written to a folder of its own, which nobody looks at. Then one commit row is written: its number, the folder,
the schema and the keys. Readers start from the commits, so that a writer that dies, or is still at work, changes nothing for
them: they see the last complete version, or any older one they ask for. Columns come back with the types they were
written in, partition keys too, as the schema is read from the commit and not guessed from folder names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import SchemaError, write_partitioned

COMMIT = "version long, folder string, schema string, keys array<string>, n_rows long"


class Conflict(RuntimeError):
    """Two writers committed the same version; the later one must look at the other's and try again."""


def commits(spark: SparkSession, path: str) -> DataFrame:
    """One row per complete version of the table at ``path``; none where there is no table."""
    try:
        return spark.read.schema(COMMIT).json(f"{path.rstrip('/')}/commits/*")
    except AnalysisException:
        return spark.createDataFrame([], COMMIT)


def latest(spark: SparkSession, path: str) -> int | None:
    """Number of the newest complete version."""
    return commits(spark, path).agg(F.max("version")).first()[0]


def write_data(df: DataFrame, path: str, keys: Sequence[str] = ()) -> dict:
    """The first half of publishing: the rows in a new folder. Gives the commit that would make them a version.

    Rows are counted from the footers of the files written.
    """
    folder = f"data-{uuid.uuid4().hex}"
    target = f"{path.rstrip('/')}/{folder}"
    if keys:
        write_partitioned(df, target, keys, rebalance=True)
    else:
        df.write.parquet(target)
    n_rows = df.sparkSession.read.schema(df.schema).parquet(target).count()
    return {"folder": folder, "schema": df.schema.json(), "keys": list(keys), "n_rows": n_rows}


def commit(spark: SparkSession, path: str, made: dict, after: int | None) -> int:
    """The second half: one row, in a file that appears at once. ``after`` is the version the writer knew as the newest."""
    number = (after or 0) + 1
    row = spark.createDataFrame([(number, made["folder"], made["schema"], made["keys"], made["n_rows"])], COMMIT)
    try:
        row.coalesce(1).write.mode("error").json(f"{path.rstrip('/')}/commits/{number:012d}")
    except AnalysisException as exc:
        raise Conflict(f"version {number} of {path} has been committed by another writer") from exc
    return number


def publish_version(df: DataFrame, path: str, keys: Sequence[str] = ()) -> int:
    """Publish ``df`` as the next version of the table at ``path``, partitioned by ``keys``; gives its number.

    Checks belong before it or, on the rows as written, between write_data and commit.
    """
    spark = df.sparkSession
    known = latest(spark, path)
    return commit(spark, path, write_data(df, path, keys), known)


def read_version(spark: SparkSession, path: str, version: int | None = None, **key) -> DataFrame:
    """A complete version (the newest unless given), or its rows with the given keys, without those columns.

    Conditions on keys leave only their own files. An unknown version, or a key that is no column, is an error.
    """
    known = commits(spark, path)
    wanted = known.where(F.col("version") == version) if version is not None else known
    made = wanted.orderBy(F.col("version").desc()).limit(1).collect()
    if not made:
        raise SchemaError(f"no complete version {'' if version is None else version} at {path}".replace("  ", " "))
    schema = T.StructType.fromJson(json.loads(made[0]["schema"]))
    unknown = [k for k in key if k not in schema.names]
    if unknown:
        raise SchemaError(f"{path} has no column: {', '.join(unknown)}")
    df = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{made[0]['folder']}").select(*schema.names)
    for name, value in key.items():
        df = df.where(F.col(name).eqNullSafe(F.lit(value).cast(schema[name].dataType))).drop(name)
    return df
