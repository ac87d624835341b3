"""Missing-value conventions: three-valued logic and joins in which NULL equals NULL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

On = str | Sequence[str] | Mapping[str, str]


def any_of(conditions: Iterable[Column]) -> Column:
    """TRUE if any condition is TRUE, NULL if none is TRUE but one is NULL, else FALSE."""
    return reduce(or_, conditions)


def row_sum(columns: Iterable[Column]) -> Column:
    """Sum over columns of one row; NULL as soon as one of them is NULL."""
    return reduce(add, columns)


def filter_out(df: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows for which the condition is TRUE; rows with a NULL condition stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def key_pairs(on: On) -> list[tuple[str, str]]:
    """Normalise a join key specification to (left, right) column pairs."""
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(name, name) for name in on]


def join_null_safe(left: DataFrame, right: DataFrame, on: On, how: str = "left",
                   prefer: str = "error") -> DataFrame:
    """Equi join in which two NULL keys match, as survey metadata expects.

    The right key columns are not returned. ``prefer`` says what happens to other
    columns that exist on both sides: ``"error"``, ``"left"`` or ``"right"`` wins.
    """
    pairs = key_pairs(on)
    right_keys = {r for _, r in pairs}
    left_keys = {lf for lf, _ in pairs}
    if how not in ("left_semi", "left_anti"):
        have = set(left.columns)
        shared = [c for c in right.columns if c in have and c not in right_keys and c not in left_keys]
        if shared and prefer == "error":
            raise ValueError(f"columns on both sides of the join: {', '.join(shared)}")
        if prefer == "right":
            left = left.drop(*shared)
        else:
            right = right.drop(*shared)
    renamed = {r: f"__right_{r}" for r in right_keys}
    right = right.withColumnsRenamed(renamed)
    condition = reduce(and_, [left[lf].eqNullSafe(right[renamed[r]]) for lf, r in pairs])
    joined = left.join(right, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*renamed.values())
