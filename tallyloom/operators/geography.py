"""Versioned geographic hierarchies and the maps between their versions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.nulls import join_null_safe
from ..functions.text import title_case
from ..session import stage_table
from ..sources.tables import drop_empty_columns
from .ordered import BLOCKS, last_seen

CODE = r"[0-9]{5}"


def level_column(prefix: str, level: int) -> str:
    return f"{prefix}lvl{level}"


def hierarchy_flatten(df: DataFrame, prefix: str, levels: Sequence[int] = range(5), pos: str = "pos",
                      by: Sequence[str] = (), blocks: int = BLOCKS) -> DataFrame:
    """Ancestor of each row per level, from a list in which every area follows its ancestors.

    The ancestor at level l is the last earlier row at level l or above, provided it is at level l
    itself. ``parent_id`` is the deepest ancestor above the own level.
    """
    seen = {f"__seen{lv}": F.when(F.col("level") <= lv, F.struct(F.col("level").alias("lv"), F.col("id").alias("id")))
            for lv in levels}
    marked = last_seen(df, pos, seen, by, blocks)
    ancestor = {lv: F.when(F.col(f"__seen{lv}.lv") == lv, F.col(f"__seen{lv}.id")) for lv in levels}
    above = [F.when(F.col("level") > lv, ancestor[lv]) for lv in reversed(list(levels))]
    return marked.withColumns({
        "parent_id": F.coalesce(*above),
        **{level_column(prefix, lv): e for lv, e in ancestor.items()},
    }).drop(*seen)


def attach_deepest(flat: DataFrame, detail: DataFrame, prefix: str, level: int = 5) -> DataFrame:
    """Add the finest areas below their parents, with title-cased labels; English label is the French one."""
    uppers = [level_column(prefix, lv) for lv in range(level)]
    parents = flat.where(F.col("level") == level - 1).select(*uppers, F.col(uppers[-1]).alias("parent_id"))
    labels = [c for c in detail.columns if c.startswith("label")]
    below = join_null_safe(detail.where("id IS NOT NULL").withColumns({c: title_case(F.col(c)) for c in labels}),
                           parents, ["parent_id"])
    below = below.withColumns({"level": F.lit(level), level_column(prefix, level): F.col("id")})
    stacked = flat.unionByName(below, allowMissingColumns=True)
    order = ["id", "level", "label_nl", "label_fr", "parent_id", *uppers, level_column(prefix, level)]
    return stacked.select(*order).withColumn("label_en", F.col("label_fr"))


def merger_recodes(df: DataFrame, old: str, new: str, old_out: str, new_out: str, sep: str = "+") -> DataFrame:
    """One row per merged area: five-digit codes taken from the texts of old areas and of their successor."""
    parts = df.select(F.explode_outer(F.split(F.col(old), re.escape(sep))).alias("__old"), F.col(new).alias("__new"))
    digits = lambda c: F.nullif(F.regexp_extract(c, f"({CODE})", 1), F.lit(""))
    return parts.select(digits("__old").alias(old_out), digits("__new").alias(new_out))


def successor_map(flat: DataFrame, recodes: DataFrame, newer: DataFrame, prefix: str, newer_prefix: str,
                  level: int = 4) -> DataFrame:
    """Successor of every area at ``level`` (itself when not merged) with the successor's ancestors."""
    old, new = level_column(prefix, level), level_column(newer_prefix, level)
    own = flat.where(F.col("level") == level)
    renamed = join_null_safe(own, recodes.select(F.col(old).alias("id"), new), ["id"]).withColumn(
        new, F.coalesce(F.col(new), F.col("id")))
    uppers = newer.where(F.col("level") == level).select(*[level_column(newer_prefix, lv) for lv in range(level + 1)])
    return join_null_safe(renamed, uppers, [new]).withColumn(newer_prefix, F.col(new))


def set_equality_crosswalk(members: DataFrame, levels: Sequence[int], prefix: str, newer_prefix: str) -> DataFrame:
    """(level, old, new): areas of two versions with exactly the same members; ``new`` is NULL without one.

    ``members`` has one row per member with its areas in both versions. Two areas have the same
    members when both have as many rows as they share, so counts decide: nothing is gathered per
    area. The members are aggregated to pairs of areas first; everything else runs on those pairs.
    """
    cells = F.array(*[F.struct(F.lit(lv).alias("level"), F.col(level_column(prefix, lv)).alias("old"),
                               F.col(level_column(newer_prefix, lv)).alias("new")) for lv in levels])
    pairs = members.select(F.inline(cells)).groupBy("level", "old", "new").agg(F.count(F.lit(1)).alias("n"))
    sized = pairs.withColumns({f"n_{side}": F.sum("n").over(Window.partitionBy("level", side)) for side in ("old", "new")})
    equal = (F.col("n") == F.col("n_old")) & (F.col("n") == F.col("n_new"))
    return sized.where("old IS NOT NULL").groupBy("level", "old").agg(F.max(F.when(equal, F.col("new"))).alias("new"))


def upper_level_maps(flat: DataFrame, crosswalk: DataFrame, prefix: str, newer_prefix: str,
                     levels: Sequence[int] = range(4), depth: int = 5) -> DataFrame:
    """Map the higher areas and each of their ancestors through the crosswalk.

    All columns to map are made long, so that the crosswalk is joined once.
    """
    own = flat.where(F.col("level").isin(list(levels)))
    sources = {level_column(newer_prefix, lv): level_column(prefix, lv) for lv in range(depth + 1)
               if level_column(prefix, lv) in flat.columns}
    sources[newer_prefix] = "id"
    cells = F.array(*[F.struct(F.lit(t).alias("__target"), F.col(c).alias("__old")) for t, c in sources.items()])
    long = own.select(F.col("id").alias("__id"), F.inline(cells))
    found = long.join(crosswalk.where("new IS NOT NULL").select(F.col("old").alias("__old"), "new"), "__old")
    wide = found.groupBy("__id").agg(*[F.max(F.when(F.col("__target") == t, F.col("new"))).alias(t) for t in sources])
    return join_null_safe(own, wide, {"id": "__id"})


def deepest_level_map(flat: DataFrame, successors: DataFrame, prefix: str, newer_prefix: str, level: int = 5) -> DataFrame:
    """The finest areas inherit the successor of their parent and keep their own code."""
    parent, own = level_column(prefix, level - 1), level_column(prefix, level)
    newer = [level_column(newer_prefix, lv) for lv in range(level)]
    below = join_null_safe(flat.where(F.col("level") == level), successors.select(parent, *newer), [parent])
    return below.withColumns({level_column(newer_prefix, level): F.col(own), newer_prefix: F.col(own)})


def version_map(flat: DataFrame, recodes: DataFrame, newer: DataFrame, prefix: str, newer_prefix: str) -> DataFrame:
    """A version with, for every area at every level, its counterpart in the next version.

    The successors are the members of the crosswalk, rows of the result and the parents of the finest level: computed once.
    """
    successors = stage_table(successor_map(flat, recodes, newer, prefix, newer_prefix))
    crosswalk = set_equality_crosswalk(successors, range(4), prefix, newer_prefix)
    uppers = upper_level_maps(flat, crosswalk, prefix, newer_prefix)
    out = uppers.unionByName(successors, allowMissingColumns=True)
    if level_column(prefix, 5) not in flat.columns:
        return out
    return out.unionByName(deepest_level_map(flat, successors, prefix, newer_prefix), allowMissingColumns=True)


def chained_map(first: DataFrame, second: DataFrame, middle: str, last: str) -> DataFrame:
    """Extend a map old -> middle by a map middle -> last."""
    onward = second.select(F.col("id").alias(middle), *[c for c in second.columns if c.startswith(last)])
    return join_null_safe(first, onward, [middle])


def version_chains(steps: DataFrame, versions: Sequence[int], id_col: str = "id", next_col: str = "next_id") -> DataFrame:
    """(version, id, target, target_id): what every area of every version is in each later one.

    ``steps`` has version, id and next_id: an area and what it became in the version after its own. ``versions`` lists
    the registered versions. Areas that merged share a successor; one that was divided has several rows, and so have all chains
    through it. An area without successor, or whose successor the next version does not list, ends there. Chains of up to
    2^k steps are joined with those of 2^k steps to make all longer ones up to twice as long, so any number of versions takes
    as many rounds as its logarithm, each of them one equi join over a staged table; every chain is made once.
    """
    ranks = {v: i for i, v in enumerate(sorted(versions))}
    rank = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair]) if ranks else F.lit(None).cast("map<int,int>")
    own = steps.select(F.try_element_at(rank, F.col("version").cast("int")).alias("from"), F.col(id_col).alias("id"), F.col(next_col).alias("to_id"))
    chains = own.where("from IS NOT NULL AND id IS NOT NULL AND to_id IS NOT NULL").distinct()
    chains = stage_table(chains.select("from", "id", (F.col("from") + 1).alias("to"), "to_id").where(F.col("to") < len(ranks)))
    length = 1
    while length < len(ranks) - 1:
        head = chains.where(F.col("to") - F.col("from") == length).select("from", "id", F.col("to").alias("mid"), F.col("to_id").alias("mid_id"))
        tail = chains.select(F.col("from").alias("mid"), F.col("id").alias("mid_id"), "to", "to_id")
        longer = head.join(tail, ["mid", "mid_id"]).select("from", "id", "to", "to_id")
        chains = stage_table(chains.unionByName(longer.distinct()))
        length *= 2
    names = F.array(*[F.lit(v) for v in ranks]) if ranks else F.array().cast("array<int>")
    at = lambda c: F.get(names, F.col(c)).alias({"from": "version", "to": "target"}[c])
    return chains.select(at("from"), F.col("id").alias(id_col), at("to"), F.col("to_id").alias("target_id"))


@dataclass(frozen=True)
class MergedVersion:
    """An earlier version in which some areas were one and a level did not exist."""

    members: tuple[str, ...]
    code: str
    label_nl: str
    label_fr: str
    region: str
    parent: str
    dropped_level: int = 1
    level: int = 2


# The single province before its division.
BRABANT = MergedVersion(members=("20001", "20002"), code="20000", label_nl="Provincie Brabant",
                        label_fr="Province du Brabant", region="04000", parent="01000")


def derive_earlier_version(df: DataFrame, spec: MergedVersion, prefix: str, base: str, later: Sequence[str]) -> DataFrame:
    """Build the earlier version from the oldest listed one; maps that the merger breaks become NULL."""
    at_level = F.col("level") == spec.level
    merged = F.when(F.col("id").isin(list(spec.members)), F.lit(spec.code)).otherwise(F.col("id"))
    is_merged = F.col("id") == spec.code
    out = df.where(F.col("level") != spec.dropped_level).withColumn("id", merged)
    out = out.withColumns({
        "label_nl": F.when(is_merged, spec.label_nl).when(~is_merged, F.col("label_nl")),
        "label_fr": F.when(is_merged, spec.label_fr).when(~is_merged, F.col("label_fr")),
        "label_en": F.when(is_merged, spec.label_fr).when(~is_merged, F.col("label_en")),
        "parent_id": F.when(at_level, spec.parent)
                      .when(F.col("parent_id").isin([*spec.members, spec.region]), spec.code)
                      .otherwise(F.col("parent_id")),
    })
    own = {level_column(prefix, lv): F.col(level_column(base, lv)) for lv in range(6) if level_column(base, lv) in df.columns}
    own[level_column(prefix, spec.dropped_level)] = F.lit(None).cast("string")
    own[level_column(prefix, spec.level)] = (
        F.when(F.col(level_column(base, spec.dropped_level)) == spec.region, spec.code)
        .when(F.col(level_column(base, spec.level)).isin(list(spec.members)), spec.code)
        .otherwise(F.col(level_column(base, spec.level))))
    broken = [level_column(v, lv) for v in (base, *later) for lv in (spec.dropped_level, spec.level)] + list(later)
    blanked = {c: F.when(~at_level, F.col(c)) for c in broken if c in df.columns}
    return out.withColumns({**own}).withColumns({**blanked, base: F.when(~at_level, F.col("id"))}).distinct()


def level_table(df: DataFrame, year: int, level: int, prefix: str = "NIS") -> DataFrame:
    """The code list of one version and level: no self map, no parent, no empty columns."""
    own = df.where(F.col("level") == level).drop("level", "parent_id", level_column(f"{prefix}{year}", level))
    names = {c: re.sub(rf"^{prefix}(\d{{4}})", r"cl_refnis\1", c) for c in own.columns}
    return drop_empty_columns(own.withColumnsRenamed({**names, "id": "value"}))


def publish_long(df: DataFrame, year: int) -> DataFrame:
    """All levels of a version as one long table, ready to be partitioned by year and level."""
    return df.select(F.lit(year).alias("year"), "*")
