"""Check-all-that-apply batteries and filtered questions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import any_of


@dataclass(frozen=True)
class Battery:
    """Options of one check-all-that-apply question, with its don't-know and none options."""

    options: tuple[str, ...]
    dk: str
    none: str | None = None


@dataclass(frozen=True)
class FilteredQuestion:
    """Questions asked only where a condition holds; ``asked`` builds it from the column names present."""

    columns: tuple[str, ...]
    needs: tuple[str, ...]
    answers: tuple[str, ...]
    negate: bool = False
    na_value: str = "na"
    na_as_false: bool = False

    def condition(self) -> Column:
        """Any needed column has one of the answers (or, negated, none has any); three-valued."""
        has = any_of([F.col(c) == a for c in self.needs for a in self.answers])
        return ~has if self.negate else has


def _present(columns: set[str], battery: Battery) -> Battery | None:
    """The part of a battery the data has; None when there is nothing to clean."""
    options = tuple(c for c in battery.options if c in columns)
    if not options or battery.dk not in columns:
        return None
    return Battery(options, battery.dk, battery.none if battery.none in columns else None)


def _columns(battery: Battery) -> set[str]:
    return {*battery.options, battery.dk, *([battery.none] if battery.none else [])}


def _clean_together(df: DataFrame, batteries: Sequence[Battery]) -> DataFrame:
    """Batteries without common columns, in two projections: their flags once, then all outputs."""
    flags, out = {}, {}
    for i, b in enumerate(batteries):
        flags[f"__ticked_{i}"] = any_of([F.col(c) == "yes" for c in b.options])
        flags[f"__dk_{i}"] = F.col(b.dk) == "yes"
        if b.none:
            flags[f"__none_{i}"] = F.col(b.none) == "yes"
        ticked, unknown, none = (F.col(f"__{n}_{i}") for n in ("ticked", "dk", "none"))
        for c in b.options:
            expr = F.when(F.col(c) == "yes", "yes").when(unknown, "dkn")
            out[c] = (expr.when(none | ticked, "no") if b.none else expr.when(ticked, "no"))
        out[b.dk] = F.when(unknown, "yes").when(none | ticked if b.none else ticked, "no")
        if b.none:
            out[b.none] = F.when(ticked, "no").when(unknown, "dkn").when(none, "yes")
    return df.withColumns(flags).withColumns(out).drop(*flags)


def clean_battery(df: DataFrame, options: Sequence[str], dk: str, none: str | None = None) -> DataFrame:
    """Recode ticked/unticked options to yes, no, don't know or NULL.

    Nothing changes when no option or no don't-know column is present. All outputs are computed
    from the incoming columns.
    """
    return clean_batteries(df, [Battery(tuple(options), dk, none)])


def clean_batteries(df: DataFrame, batteries: Sequence[Battery]) -> DataFrame:
    """Clean batteries in order; those without common columns share their projections."""
    group: list[Battery] = []
    columns = set(df.columns)
    for b in filter(None, (_present(columns, b) for b in batteries)):
        if any(_columns(b) & _columns(g) for g in group):
            df, group = _clean_together(df, group), []
        group.append(b)
    return _clean_together(df, group) if group else df


def _filter_together(df: DataFrame, filters: Sequence[tuple[Sequence[str], Column, str]]) -> DataFrame:
    """Filters (questions, condition, value) that do not see each other: conditions once, then all questions."""
    flags, out = {}, {}
    for i, (columns, asked, na_value) in enumerate(filters):
        flags[f"__asked_{i}"] = asked
        flag = F.col(f"__asked_{i}")
        out.update({c: F.when(flag, F.col(c)).when(~flag, F.lit(na_value)) for c in columns})
    return df.withColumns(flags).withColumns(out).drop(*flags)


def clean_filtered(df: DataFrame, columns: Sequence[str], condition: Column, na_value: str = "na",
                   na_as_false: bool = False) -> DataFrame:
    """Keep values where the condition holds and set ``na_value`` where it does not.

    An unknown condition gives NULL, or ``na_value`` with ``na_as_false``.
    """
    have = set(df.columns)
    present = [c for c in columns if c in have]
    if not present:
        return df
    asked = F.coalesce(condition, F.lit(False)) if na_as_false else condition
    return _filter_together(df, [(present, asked, na_value)])


def clean_filters(df: DataFrame, filters: Sequence[FilteredQuestion]) -> DataFrame:
    """Apply configured filters in order; later ones see earlier results.

    A filter is skipped when its questions are not in the edition. When they are but the column
    that steers them is not, the configuration does not fit the data, which is an error. Filters
    that touch nothing an earlier one wrote share its projections.
    """
    have, group, written = set(df.columns), [], set()
    for f in filters:
        present = [c for c in f.columns if c in have]
        if not present:
            continue
        absent = [c for c in f.needs if c not in have]
        if absent:
            raise ValueError(f"filter of {', '.join(f.columns)} needs columns {', '.join(absent)}")
        if written & {*f.needs, *present}:
            df, group, written = _filter_together(df, group), [], set()
        asked = F.coalesce(f.condition(), F.lit(False)) if f.na_as_false else f.condition()
        group.append((present, asked, f.na_value))
        written |= set(present)
    return _filter_together(df, group) if group else df
