"""Top rows per group and counts per group, safe for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import join_null_safe


def slice_best(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows that are greatest in ``order`` within each group; ties are kept, NULL ranks last.

    The best value per group is found by an aggregate with map-side combine, and a left-semi
    equi join on group plus best value keeps the rows that have it. No task ever sees a whole
    group: the join key contains the order values, and a run of tied rows is on the left side,
    where adaptive execution may split it.
    """
    marks = [f"__order_{i}" for i in range(len(order))]
    marked = df.withColumns(dict(zip(marks, order)))
    if len(marks) == 1:
        # a single number is aggregated by hashing; several need a struct, which is sorted
        best = marked.groupBy(*by).agg(F.max(marks[0]).alias(marks[0]))
    else:
        best = (marked.groupBy(*by)
                .agg(F.max(F.struct(*marks)).alias("__best"))
                .select(*by, *[F.col(f"__best.{m}").alias(m) for m in marks]))
    return join_null_safe(marked, best, [*by, *marks], "left_semi").drop(*marks)


def earliest(column: Column) -> Column:
    """Order expression under which the earliest date is greatest and NULL still ranks last."""
    return -F.unix_date(column)


def group_size(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def duplicate_keys(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return group_size(df, by, name).where(F.col(name) > 1)
