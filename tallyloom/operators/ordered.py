"""Running computations along a position, without putting a whole table in one task.

Splitters are sampled from the positions (approximate quantiles, one aggregate), so that a block between two of them
holds about as many rows as any other, however sparse or crowded the positions are. Each block of a group is summarised by
an aggregate; the summaries, at most ``blocks + 2`` a group whatever the number of rows, are scanned in order; and
every block then goes on from the state its predecessors left behind. What is carried must be associative: the last value
seen, a count, a sum. Rows with one position are in one block; rows without a position come first, in no order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.nulls import join_null_safe

BLOCKS = 1024
_ACCURACY = 100_000  # of the quantiles: a rank is off by a hundred thousandth of all rows at most


def _constant(values: Sequence, kind: str) -> Column:
    """An array that the planner sees as one text, not as a thousand expressions."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def splitters(df: DataFrame, pos: str, blocks: int = BLOCKS) -> list:
    """Positions that part the rows into about equal blocks, ascending; at most ``blocks - 1``."""
    if blocks < 2:
        return []
    cuts = df.agg(F.percentile_approx(pos, _constant([k / blocks for k in range(1, blocks)], "double"), _ACCURACY).alias("cuts")).first()["cuts"]
    return sorted(set(cuts or []))


def with_blocks(df: DataFrame, pos: str, cuts: list, block: str = "__block") -> DataFrame:
    """Adds the number of the block of each position: -1 without one, else how many of ``cuts`` are not above it.

    A binary search, one projection per step; a step reads one cut from an array.
    """
    kind = df.schema[pos].dataType.simpleString()
    array = _constant(cuts, kind)
    out, step = df.withColumn(block, F.when(F.col(pos).isNull(), -1).otherwise(0)), 1
    while step <= len(cuts):
        step *= 2
    while step := step // 2:
        further = F.get(array, F.col(block) + (step - 1)) <= F.col(pos)
        out = out.withColumn(block, F.col(block) + F.when(further, step).otherwise(0))
    return out


def _blocked(df: DataFrame, pos: str, blocks: int) -> DataFrame:
    return with_blocks(df, pos, splitters(df, pos, blocks))


def _windows(order: Sequence[str], by: Sequence[str]):
    inside = Window.partitionBy(*by, "__block").orderBy(*order)
    before = Window.partitionBy(*by).orderBy("__block")
    return inside, before


def last_seen(df: DataFrame, pos: str, values: dict[str, Column], by: Sequence[str] = (),
              blocks: int = BLOCKS, tie: Sequence[str] = ()) -> DataFrame:
    """Per output column: the last non-NULL value of its expression up to and including the row.

    Rows of one position follow each other by ``tie``, which must then be total.
    """
    blocked = _blocked(df, pos, blocks)
    inside, before = _windows([pos, *tie], by)
    marks = {f"__carry_{name}": expr for name, expr in values.items()}
    found = blocked.withColumns({f"__now_{name}": expr for name, expr in values.items()})
    place = F.struct(pos, *tie) if tie else F.col(pos)
    summary = found.groupBy(*by, "__block").agg(*[
        F.max_by(F.col(f"__now_{name}"), F.when(F.col(f"__now_{name}").isNotNull(), place)).alias(f"__carry_{name}")
        for name in values])
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(*by, "__block", *[
        F.last(m, ignorenulls=True).over(earlier).alias(m) for m in marks])
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = join_null_safe(found, carried, [*by, "__block"])
    done = joined.withColumns({
        name: F.coalesce(F.last(f"__now_{name}", ignorenulls=True).over(upto), F.col(f"__carry_{name}"))
        for name in values})
    return done.drop("__block", *marks, *[f"__now_{name}" for name in values])


def running_totals(df: DataFrame, pos: str, sums: dict[str, Column], by: Sequence[str] = (), blocks: int = BLOCKS,
                   tie: Sequence[str] = ()) -> DataFrame:
    """Per output column: the sum of its expression over the rows of the group up to and including the row."""
    blocked = _blocked(df, pos, blocks).withColumns({f"__now_{name}": expr for name, expr in sums.items()})
    inside, before = _windows([pos, *tie], by)
    summary = blocked.groupBy(*by, "__block").agg(*[F.sum(f"__now_{name}").alias(f"__sum_{name}") for name in sums])
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(*by, "__block", *[F.sum(f"__sum_{name}").over(earlier).alias(f"__carry_{name}") for name in sums])
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = join_null_safe(blocked, offsets, [*by, "__block"])
    done = joined.withColumns({
        name: F.coalesce(F.sum(f"__now_{name}").over(upto) + F.col(f"__carry_{name}"), F.sum(f"__now_{name}").over(upto), F.col(f"__carry_{name}"))
        for name in sums})
    return done.drop("__block", *[f"__{kind}_{name}" for name in sums for kind in ("now", "carry")])


def number_rows(df: DataFrame, pos: str, by: Sequence[str] = (), number: str = "row_number", total: str = "n",
                following: dict[str, str] | None = None, blocks: int = BLOCKS) -> DataFrame:
    """Rank by position within the group, size of the group, and values of the following row.

    A position stands once in a group.
    """
    following = following or {}
    blocked = _blocked(df, pos, blocks)
    inside, before = _windows([pos], by)
    first = [F.min_by(F.col(source), F.col(pos)).alias(f"__first_{target}") for target, source in following.items()]
    summary = blocked.groupBy(*by, "__block").agg(F.count(F.lit(1)).alias("__rows"), *first)
    whole = Window.partitionBy(*by)
    offsets = summary.select(
        *by, "__block", "__rows",
        (F.sum("__rows").over(before) - F.col("__rows")).alias("__offset"),
        F.sum("__rows").over(whole).alias(total),
        *[F.lead(f"__first_{t}").over(before).alias(f"__after_{t}") for t in following])
    joined = join_null_safe(blocked, offsets, [*by, "__block"])
    ranked = joined.withColumn("__inside", F.row_number().over(inside))
    ranked = ranked.withColumns({
        number: F.col("__offset") + F.col("__inside"),
        **{t: F.when(F.col("__inside") == F.col("__rows"), F.col(f"__after_{t}"))
              .otherwise(F.lead(s).over(inside)) for t, s in following.items()},
    })
    return ranked.drop("__block", "__rows", "__offset", "__inside", *[f"__after_{t}" for t in following])


def last_before(rows: DataFrame, at: str, events: DataFrame, since: str, values: Sequence[str], by: Sequence[str] = (),
                until: str | None = None, blocks: int = BLOCKS) -> DataFrame:
    """Adds to each row the ``values`` of the newest event of its group that is not after it: an as-of join by one scan.

    Rows and events go into one ordered scan, events before rows of the same moment, and every row takes what was seen
    last; no row meets an interval, so there is no range join, and a frequent group is split into blocks like any other. Of
    events of one group and moment the one with the greatest values holds. A row without a moment, or after the
    moment in ``until`` of its event, gets NULL. NULL is a group like any other.
    """
    kind, held = rows.schema[at].dataType, [c for c in rows.columns if c not in by]
    own = rows.select(*by, F.col(at).alias("__at"), F.lit(1).alias("__turn"), F.struct(*held).alias("__row"))
    carried = F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)], *([F.col(until).alias("until")] if until else []))
    seen = events.where(F.col(since).isNotNull()).select(*by, F.col(since).cast(kind).alias("__at"), F.lit(0).alias("__turn"), carried.alias("__event"))
    both = own.unionByName(seen, allowMissingColumns=True)
    scanned = last_seen(both, "__at", {"__last": F.col("__event")}, by, blocks, ["__turn", "__event"])
    valid = F.col("__at").isNotNull()
    if until:
        valid = valid & F.coalesce(F.col("__at") <= F.col("__last.until").cast(kind), F.lit(True))
    return scanned.where("__turn = 1").select(
        *[F.col(c) if c in by else F.col("__row")[c].alias(c) for c in rows.columns],
        *[F.when(valid, F.col("__last")[f"v{i}"]).alias(v) for i, v in enumerate(values)])
