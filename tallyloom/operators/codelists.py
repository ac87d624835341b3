"""Code lists: integrity, membership, containment maps and assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.messages import OffendersError, require_none
from ..functions.nulls import join_null_safe
from ..session import stage_table

PREFIX = "cl_"
ID_COLUMNS = ("valuen", "value")


class CodelistError(OffendersError):
    """Code lists that contradict each other."""


def list_columns(skeleton: DataFrame) -> list[str]:
    """The membership columns of a skeleton."""
    return [f.name for f in skeleton.schema.fields if isinstance(f.dataType, T.BooleanType)]


def skeleton_orphans(skeletons: DataFrame, values: DataFrame) -> DataFrame:
    """Values used in skeletons (source, value) that the master list does not have."""
    return join_null_safe(skeletons.select("source", "value"), values.select("value").distinct(), ["value"], "left_anti")


def require_known_values(skeletons: DataFrame, values: DataFrame) -> None:
    require_none(skeleton_orphans(skeletons, values).distinct(), "skeleton values that no value list has", CodelistError)


def membership_long(skeleton: DataFrame, lists: Sequence[str] | None = None) -> DataFrame:
    """One row per value and code list it may belong to: (valuen, value, codelist, member)."""
    lists = list(lists or list_columns(skeleton))
    ids = [c for c in ID_COLUMNS if c in skeleton.columns]
    long = skeleton.unpivot(ids, lists, "codelist", "member")
    return long.withColumn("codelist", F.concat(F.lit(PREFIX), F.col("codelist")))


def contained_lists(skeleton: DataFrame, lists: Sequence[str] | None = None) -> DataFrame:
    """Pairs (codelist, target) in which every member of the target is a member of the code list.

    Works on postings (row, list), for any number of lists: a list that contains another one has all rows of it, and so the one
    that fewest lists have. That row names the candidates, and anti joins throw out those that lack another row. An unknown
    membership rules a pair out. Without rows there are no pairs; a list without members is contained in every other.
    """
    lists = list(lists or list_columns(skeleton))
    rows = skeleton.select(F.monotonically_increasing_id().alias("row"), *lists)
    postings = rows.unpivot(["row"], lists, "list", "member").where("member IS NULL OR member")
    postings = stage_table(postings.select("row", "list", F.coalesce("member", F.lit(False)).alias("sure")))
    sure = postings.where("sure").select("row", F.col("list").alias("codelist"))
    spread = sure.groupBy("row").agg(F.count("*").alias("n"))
    needed = postings.select("row", F.col("list").alias("target"))
    rarest = needed.join(spread, "row", "left").groupBy("target").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "row")).alias("rare"))
    candidates = stage_table(rarest.select("target", F.col("rare.row").alias("row")).join(sure, "row").where("codelist <> target").select("codelist", "target"))
    wanted = candidates.join(needed, "target")
    lacking = wanted.join(sure, ["row", "codelist"], "left_anti").select("codelist", "target").distinct()
    found = candidates.join(lacking, ["codelist", "target"], "left_anti")
    spark = skeleton.sparkSession
    met = {r[0] for r in postings.select("list").distinct().collect()}  # names of columns
    bare = [] if skeleton.isEmpty() else [c for c in lists if c not in met]
    every = spark.createDataFrame([(c,) for c in bare], "target string").select(
        F.explode(F.array(*[F.lit(c) for c in lists])).alias("codelist"), "target").where("codelist <> target")
    name = lambda c: F.concat(F.lit(PREFIX), F.col(c)).alias(c)
    return found.unionByName(every).select(name("codelist"), name("target"))


def containment_maps(skeleton: DataFrame, lists: Sequence[str] | None = None) -> DataFrame:
    """(codelist, value, target, target_value): where a code list contains another one, its values map to themselves."""
    members = membership_long(skeleton, lists).where("member").select(F.col("codelist").alias("target"), "value")
    return members.join(contained_lists(skeleton, lists), "target").select(
        "codelist", "value", "target", F.col("value").alias("target_value"))


def assemble_codelists(skeleton: DataFrame, values: DataFrame, lists: Sequence[str] | None = None) -> DataFrame:
    """Members of every code list with their labels, as one long table."""
    members = membership_long(skeleton, lists).where("member").drop("member")
    return join_null_safe(members, values.drop("valuen"), ["value"])


def codelist_wide(codelists: DataFrame, maps: DataFrame, codelist: str) -> DataFrame:
    """One code list with a column per list it maps into; lists it does not map into have no column."""
    own = codelists.where(F.col("codelist") == codelist).drop("codelist")
    own_maps = maps.where(F.col("codelist") == codelist).drop("codelist")
    targets = sorted(r["target"] for r in own_maps.select("target").distinct().collect())
    if not targets:
        return own
    wide = own_maps.groupBy("value").pivot("target", targets).agg(F.min("target_value"))
    return join_null_safe(own, wide, ["value"])


def map_between(maps: DataFrame, codelist: str, target: str) -> DataFrame:
    """(value, target_value) of one code list into another."""
    return maps.where((F.col("codelist") == codelist) & (F.col("target") == target)).select("value", "target_value")
