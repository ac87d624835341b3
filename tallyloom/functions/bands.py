"""Cutting a number into labelled, left-closed intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(column: Column, breaks: Sequence[float], labels: Sequence[str]) -> Column:
    """Label ``[breaks[i], breaks[i+1])``; the last interval is open, lower values give NULL."""
    if len(breaks) != len(labels):
        raise ValueError("one label per lower bound is needed")
    expr = F.when(column < F.lit(breaks[0]), F.lit(None).cast("string"))
    for upper, label in zip(breaks[1:], labels):
        expr = expr.when(column < F.lit(upper), F.lit(label))
    return expr.when(column >= F.lit(breaks[-1]), F.lit(labels[-1]))


def _ranges(breaks: Sequence[int], prefix: str = "", dash: str = "-", last: str = "+") -> list[str]:
    closed = [f"{prefix}{lo}{dash}{hi - 1}" for lo, hi in zip(breaks, breaks[1:])]
    return [*closed, f"{prefix}{breaks[-1]}{last}"]


def _scheme(breaks: Sequence[int], **style) -> tuple[list[int], list[str]]:
    return list(breaks), _ranges(list(breaks), **style)


# Lower bounds of the age bands and the style of their labels.
_CODE = {"prefix": "a", "dash": "_", "last": "plus"}
SCHEMES: dict[str, tuple[list[int], list[str]]] = {
    "agecat7from18": _scheme([18, 25, 35, 45, 55, 65, 75], **_CODE),
    "agecat4from18": _scheme([18, 35, 50, 65], **_CODE),
    "agecat5yr": _scheme(range(0, 101, 5)),
    "agecat3a": _scheme([0, 18, 67]),
    "agecat3b": _scheme([0, 20, 65]),
    "agecat4a": _scheme([0, 18, 40, 67]),
    "agecat5yrfrom18": _scheme([18, *range(25, 91, 5)]),
    "agecat9from18": _scheme([18, 25, *range(30, 91, 10)]),
}


def age_band(column: Column, scheme: str) -> Column:
    """Apply a named age-band scheme."""
    return cut(column, *SCHEMES[scheme])
