"""Sharding by fixed virtual slots, by DataFrame operations alone.

A record's id hashes into one of thousands of slots, and stays there for good. Bytes are summed per slot, a table of fixed
length; a *map* gives every slot a shard. Maps are kept as versions of one table: the first one deals slots to shards by their
bytes, later ones are edits of the one before. An edit keeps as many slots as fit where they are: shards that hold more than
their share give slots up, and those go, heaviest first, to the shard with the least bytes among those that may take some.
Placing records under any version is a join with its map. Places inside a shard are distributed prefix sums.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import prefix_sums, stage_table

SLOTS = 4096


def record_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, size (bytes of the text and 8), text_crc32 for every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))


def slotted(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``records`` with _key (a hash of id and copy number) and virtual_slot.

    Rows with one id are numbered by size and checksum and hash with their number, so a frequent id, null among them, is
    spread over all slots. Ids that stand once need no numbering.
    """
    many = stage_table(records.groupBy("_id").agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col("_id").alias("_many")))
    plain, copies = records, None
    if not many.isEmpty():
        plain = records.join(many, F.col("_id").eqNullSafe(F.col("_many")), "left_anti")
        copies = records.join(many, F.col("_id").eqNullSafe(F.col("_many")), "left_semi")
        order = [F.col("_id").asc_nulls_first(), F.col("size"), F.col("text_crc32"), F.col("_tie")]
        placed = prefix_sums(stage_table(copies.withColumn("_tie", F.monotonically_increasing_id())), order, {"_place": F.lit(1)})
        first = placed.groupBy(F.col("_id").alias("_f")).agg(F.min("_place").alias("_first"))
        copies = placed.join(first, F.col("_id").eqNullSafe(F.col("_f"))).select("_id", "size", "text_crc32", (F.col("_place") - F.col("_first")).alias("_copy"))
    out = plain.withColumn("_copy", F.lit(0).cast("long"))
    if copies is not None:
        out = out.unionByName(copies.withColumn("_copy", F.col("_copy").cast("long")))
    key = F.md5(F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit(":"), F.col("_copy")))
    out = out.withColumn("_key", key)
    return out.withColumn("virtual_slot", (F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") % slots).cast("int")).drop("_copy")


def slot_bytes(records: DataFrame, spark: SparkSession, slots: int = SLOTS) -> DataFrame:
    """virtual_slot, slot_size for every slot, empty ones included."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("slot_size"))
    every = spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(sums, "virtual_slot", "left").select("virtual_slot", F.coalesce("slot_size", F.lit(0)).cast("long").alias("slot_size"))


def _dealt(loose: Column, loads: Column, takers: Column) -> Column:
    """(virtual_slot, shard) for the slots of an array, heaviest first, each to the least loaded of ``takers``."""
    def step(state, slot):
        best = F.array_min(F.transform(F.filter(state["loads"], lambda s: s["takes"]), lambda s: F.struct(s["bytes"], s["shard"])))
        loads = F.transform(state["loads"], lambda s: F.struct(
            s["shard"].alias("shard"), F.when(s["shard"] == best["shard"], s["bytes"] + slot["slot_size"]).otherwise(s["bytes"]).alias("bytes"), s["takes"].alias("takes")))
        return F.struct(loads.alias("loads"), F.concat(state["dealt"], F.array(F.struct(slot["virtual_slot"].alias("virtual_slot"), best["shard"].alias("shard")))).alias("dealt"))

    start = F.transform(loads, lambda s: F.struct(s["shard"].alias("shard"), s["bytes"].alias("bytes"), F.array_contains(takers, s["shard"]).alias("takes")))
    nothing = F.array().cast("array<struct<virtual_slot:int,shard:int>>")
    return F.aggregate(loose, F.struct(start.alias("loads"), nothing.alias("dealt")), step, lambda state: state["dealt"])


def edited_map(sizes: DataFrame, shards: int, current: DataFrame | None = None, slack: float = 0.0) -> DataFrame:
    """virtual_slot, shard: an edit of the map ``current`` (none: an empty one) for slots of ``sizes`` and shards 0 to ``shards`` - 1.

    A shard keeps slots, by number, as long as they fit into its share of all bytes and ``slack`` of it more; a shard that is
    no more keeps none. Where shards are new, only they take the slots given up, so that growth moves nothing between old shards.
    Without bytes all slots are dealt by number. The map has one row per slot, whatever the number of records.
    """
    spark = sizes.sparkSession
    every = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    if current is None:
        current = sizes.select("virtual_slot", F.lit(None).cast("int").alias("shard"))
    whole = sizes.agg(F.sum("slot_size").alias("whole")).first()["whole"] or 0
    order = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    fits = (F.sum("slot_size").over(order) <= F.lit(whole) / shards * (1 + slack)) & (F.col("shard") < shards)
    held = stage_table(sizes.join(current, "virtual_slot", "left").withColumn("stays", F.coalesce(fits, F.lit(False))))
    kept = held.filter("shard IS NOT NULL").groupBy(F.col("shard").alias("s")).agg(F.sum(F.when(F.col("stays"), F.col("slot_size"))).alias("bytes"))
    loads = every.join(kept, F.col("shard") == F.col("s"), "left").select(
        F.struct("shard", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes")).alias("load"), F.when(F.col("s").isNull(), F.col("shard")).alias("new"))
    loose = held.filter("NOT stays").select(F.struct((-F.col("slot_size")).alias("heavy"), "virtual_slot", "slot_size").alias("loose"))
    # one row: the slots to deal and the loads of all shards, both of fixed length
    summed = loads.unionByName(loose, allowMissingColumns=True).agg(
        F.array_sort(F.collect_list("load")).alias("loads"), F.collect_list("new").alias("new"), F.array_sort(F.collect_list("loose")).alias("loose"))
    takers = F.when(F.size("new") > 0, F.col("new")).otherwise(F.transform("loads", lambda s: s["shard"]))
    dealt = summed.select(F.explode(_dealt(F.col("loose"), F.col("loads"), takers)).alias("s")).select("s.virtual_slot", "s.shard")
    return held.filter("stays").select("virtual_slot", "shard").unionByName(dealt)


def write_version(slot_map: DataFrame, path: str, version: int) -> None:
    """Adds a version to the maps at ``path``; a version that is there already is an error."""
    slot_map.coalesce(1).write.mode("error").parquet(f"{path.rstrip('/')}/version={version}")


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    """virtual_slot, shard as version ``version`` has them."""
    return spark.read.schema("virtual_slot int, shard int").parquet(f"{path.rstrip('/')}/version={version}")


def placed(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``records`` with shard and slot: the place inside the shard, from 0 without gaps, by virtual slot and key."""
    own = records.join(slot_map, "virtual_slot")
    order = [F.col("shard"), F.col("virtual_slot"), F.col("_key"), F.col("_id").asc_nulls_first()]
    at = prefix_sums(own, order, {"_at": F.lit(1)})
    first = own.groupBy("shard").count().select("shard", (F.coalesce(F.sum("count").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_first"))
    return at.join(first, "shard").withColumn("slot", (F.col("_at") - F.col("_first")).cast("long")).drop("_at", "_first")


def shard_documents(docs: DataFrame, shards: int = 24, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text",
                    path: str | None = None) -> DataFrame:
    """One row per input row: ``id_col``, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, next_shard.

    The law is ``bytes``: slots are dealt so that shards hold nearly equal bytes. Version 1 of the map, which places the rows, and
    version 2, an edit for one more shard, which gives next_shard, are written below ``path`` (left out: a folder of
    the shared one). grown_shard is null under this law. A null text has no bytes. Equal texts are no unit: copies have
    keys of their own and a large group is spread over all shards. Rows with one id, null among them, are numbered by size and
    checksum. Other columns are not read. An empty table gives no rows, and maps that deal empty slots.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark).rstrip('/')}/slot-maps-{uuid.uuid4().hex}"
    records = stage_table(slotted(stage_table(record_table(docs, id_col, text_col)), slots))
    sizes = stage_table(slot_bytes(records, spark, slots))
    write_version(edited_map(sizes, shards), path, 1)
    write_version(edited_map(sizes, shards + 1, read_version(spark, path, 1)), path, 2)
    later = read_version(spark, path, 2).select("virtual_slot", F.col("shard").alias("next_shard"))
    return placed(records, read_version(spark, path, 1).join(later, "virtual_slot")).select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "next_shard")
