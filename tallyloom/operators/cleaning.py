"""Corrections of raw responses: typing errors, timers, merging and household consistency."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import any_of, join_null_safe
from ..functions.recode import replace_values
from .joins import left_join_many

HOUSEHOLD = r"^hh_[a-z]+$"
HOUSEHOLD_COUNTS = ["nhh_nchld", "nhh_nadlt", "nhh_nsnr"]


def replace_in(df: DataFrame, replacements: Mapping[str, Mapping]) -> DataFrame:
    """Replace values column by column in one projection; unlisted values are kept."""
    present = {c: m for c, m in replacements.items() if c in df.columns}
    types = dict(df.dtypes)
    return df.withColumns({c: replace_values(F.col(c), m).cast(types[c]) for c, m in present.items()}) if present else df


def fill_missing(df: DataFrame, column: str, default: str, recode: Mapping | None = None) -> DataFrame:
    """NULL becomes a default code, then further codes may be folded into it."""
    filled = F.coalesce(F.col(column), F.lit(default))
    return df.withColumn(column, replace_values(filled, recode) if recode else filled)


def source_code(df: DataFrame, column: str, rules: Sequence[tuple[Column, str]]) -> DataFrame:
    """Set a column from ordered conditions; NULL when none holds."""
    expr = F
    for condition, value in rules:
        expr = expr.when(condition, F.lit(value))
    return df.withColumn(column, expr)


def multi_response_concat(df: DataFrame, key: str, columns: Sequence[str], out: str, sep: str = "; ") -> DataFrame:
    """Names of the answered columns of a row, joined in column order; rows without any are dropped.

    ``df`` has one row per key, so no shuffle is needed.
    """
    names = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns]))
    return df.select(key, names.alias("__names")).where(F.size("__names") > 0).select(
        key, F.array_join("__names", sep).alias(out))


def in_sample(df: DataFrame, sample: DataFrame, key: str = "pseudo_id") -> DataFrame:
    """Rows whose id belongs to the sample."""
    return join_null_safe(df, sample.select(key), [key], "left_semi")


def link_ids(df: DataFrame, links: DataFrame, on: str) -> DataFrame:
    """Attach the sample id through a respondent number."""
    return join_null_safe(df, links, [on])


def cumulative_timers(df: DataFrame, start: str, timers: Sequence[str]) -> DataFrame:
    """Seconds per module become moments: each is the previous one plus its own seconds; NULL carries on.

    The start itself becomes a date.
    """
    moments, total = {}, F.lit(0).cast("decimal(18,6)")
    for t in timers:
        total = (total + F.col(t).cast("decimal(18,6)")).cast("decimal(18,6)")
        moments[t] = F.col(start) + F.make_dt_interval(secs=total)
    return df.withColumns({**moments, start: F.to_date(F.col(start))})


def drop_technical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def merge_sources(sample: DataFrame, survey: DataFrame, edition: DataFrame, contacts: DataFrame, surv_id: str) -> DataFrame:
    """Sample left join responses, plus edition and contact dates; later sources win on equal names."""
    own = sample.drop("surv_id").select(F.lit(surv_id).alias("surv_id"), "*")
    merged = left_join_many(own, survey, ["pseudo_id"])
    merged = join_null_safe(merged, edition.select("surv_id", "fw_period", "surv_year", "surv_semester"),
                            ["surv_id"], prefer="right")
    return join_null_safe(merged, contacts, ["fw_period"], prefer="right")


def fix_birth_year(df: DataFrame, youngest: int = 18, oldest: int = 120) -> DataFrame:
    """Birth years that give an impossible age become NULL."""
    if "bth_year" not in df.columns:
        return df
    age = F.col("surv_year") - F.col("bth_year")
    return df.withColumn("bth_year", F.when((age < youngest) | (age > oldest), None).otherwise(F.col("bth_year")))


def fix_household_counts(df: DataFrame, counts: Sequence[str] = HOUSEHOLD_COUNTS, pattern: str = HOUSEHOLD) -> DataFrame:
    """A missing count is zero when any household question was answered with yes."""
    asked = [c for c in df.columns if re.search(pattern, c)]
    present = [c for c in counts if c in df.columns]
    if not asked or not present:
        return df
    answered = any_of([F.col(c) == "yes" for c in asked])
    types = dict(df.dtypes)
    return df.withColumns({
        c: F.when(answered & F.col(c).isNull(), F.lit(0).cast(types[c])).otherwise(F.col(c)) for c in present})


def child_from_count(df: DataFrame, flag: str = "hh_child", count: str = "nhh_nchld") -> DataFrame:
    """Children are present when their number is above zero."""
    if flag not in df.columns or count not in df.columns:
        return df
    return df.withColumn(flag, F.when(F.col(count) > 0, F.lit("yes")).otherwise(F.col(flag)))


def not_alone(df: DataFrame, flag: str = "hh_alone", counts: Sequence[str] = HOUSEHOLD_COUNTS) -> DataFrame:
    """Nobody lives alone who counts other household members."""
    if flag not in df.columns or any(c not in df.columns for c in counts):
        return df
    others = any_of([F.col(c) > 0 for c in counts])
    return df.withColumn(flag, F.when(others, F.lit("no")).otherwise(F.col(flag)))


def correct_inconsistencies(df: DataFrame) -> DataFrame:
    """All household and age corrections, in their order."""
    return (df.transform(fix_birth_year).transform(fix_household_counts)
            .transform(child_from_count).transform(not_alone))

