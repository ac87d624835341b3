"""Dense identifiers 1..n without a single-partition window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.nulls import join_null_safe

HEX_DIGITS = 4


def keyed_digest(keys: Sequence[str], salt: str) -> Column:
    """Hash of a row key under a secret salt; its order is a reproducible random permutation."""
    # each key goes with its length, and NULL has none: no two keys can be spelled alike
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.sha2(F.concat_ws("|", F.lit(salt), *parts), 256)


def dense_positions(df: DataFrame, keys: Sequence[str], salt: str, name: str, digits: int = HEX_DIGITS,
                    source: DataFrame | None = None) -> DataFrame:
    """Add the position 1..n of each row in the order of its keyed digest.

    ``keys`` identify a row. Digests spread evenly over ``16 ** digits`` buckets whatever the keys
    are; a bucket is ranked on its own and starts where the buckets before it end, so the only
    global scan is over that fixed number of bucket counts. ``source`` may name a cheaper table
    with the same keys for those counts.
    """
    bucket = F.substring(keyed_digest(keys, salt), 1, digits)
    # bounded by 16 ** digits rows, whatever the size of df
    counts = (df if source is None else source).groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__rows"))
    offsets = counts.select("__bucket", (F.sum("__rows").over(Window.orderBy("__bucket"))
                                         - F.col("__rows")).alias("__offset"))
    hashed = df.withColumn("__digest", keyed_digest(keys, salt)).withColumn("__bucket", F.substring("__digest", 1, digits))
    inside = Window.partitionBy("__bucket").orderBy("__digest")
    return (hashed.join(offsets, "__bucket")
            .withColumn(name, F.col("__offset") + F.row_number().over(inside))
            .drop("__digest", "__bucket", "__offset"))


def row_ids(df: DataFrame, keys: Sequence[str], name: str = "row_id", salt: str = "row") -> DataFrame:
    """Give every row a reproducible number 1..n."""
    return dense_positions(df, keys, salt, name)


def pseudonymous_ids(df: DataFrame, keys: Sequence[str], surv_id: str, salt: str,
                     targets: Mapping[str, str] | None = None, drop: Sequence[str] = (),
                     source: DataFrame | None = None) -> DataFrame:
    """Add unlinkable identifiers such as ``SV0001-0042`` and drop the original keys.

    One independent permutation per target. The permutations run on the keys alone; the
    wide rows are shuffled once, to receive all identifiers together. ``source`` may name a
    cheaper table with the same keys.
    """
    targets = targets or {"resp_id": "", "resp_id_suf": "SUF-", "resp_id_puf": "PUF-"}
    # rows with one key share their identifiers
    own = ids = (df if source is None else source).select(*keys).distinct()
    for name, infix in targets.items():
        ids = dense_positions(ids, keys, f"{salt}:{surv_id}:{name}", name, source=own)
        ids = ids.withColumn(name, F.format_string(f"{surv_id}-{infix}%04d", F.col(name)))
    return join_null_safe(df, ids, list(keys)).drop(*drop)
