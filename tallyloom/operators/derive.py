"""Derived variables of a cleaned response."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import age_band
from ..functions.nulls import any_of, join_null_safe, row_sum
from ..functions.recode import recode_strict, replace_values

# Recodes of education and employment, and counts of yes per battery.
EDUCATION = {
    "nodip": "loweduc", "primary": "loweduc", "lowrsec": "loweduc",
    "uprsec": "mededuc",
    "nonuniv": "hieduc", "univ": "hieduc",
    "otherdipl": "othereduc",
    "invalid": None, None: None,
}
EMPLOYMENT = {code: "otherempl" for code in ("jobseek", "student", "homemkr", "disabil")}
YES_NO = {"yes": 1, "no": 0, "dkn": None, None: None}
YES_NO_NA = {"yes": 1, "no": 0, "na": 0, "dkn": None, None: None}
HOUSEHOLD_FLAGS = ["hh_partn", "hh_child", "hh_par", "hh_sib", "hh_fam", "hh_frnd", "hh_oth", "hh_alone"]
# What a frequency of cultural activity says (weekly, monthly, participant, answered).
CULTURE = {
    "daily": (1, 1, 1, 1),
    "weekly": (1, 1, 1, 1),
    "monthly": (0, 1, 1, 1),
    "yearly": (0, 0, 1, 1),
    "never": (0, 0, 0, 1),
    "dkn": (None, None, None, 0),
    "invalid": (None, None, None, None),
    None: (None, None, None, None),
}


def geo_rollup(df: DataFrame, mapping: DataFrame, detail: str, target: str) -> DataFrame:
    """Attach the higher area of each area; ``mapping``: (value, target_value) for one level pair."""
    areas = mapping.select(F.col("value").alias(detail), F.col("target_value").alias(target))
    return join_null_safe(df, areas, [detail])


def municipality_columns(columns: Sequence[str]) -> list[tuple[str, str]]:
    """(municipality, province) column pairs found by name, e.g. refnis2019lvl4 and refnis2019lvl2."""
    return [(c, re.sub("lvl4$", "lvl2", c)) for c in columns if re.fullmatch(r"refnis\d{4}lvl4", c)]


def nationality_group(df: DataFrame, countries: DataFrame, nationality: str = "natlty", out: str = "natltygrp") -> DataFrame:
    """Attach the country category; ``countries``: (value, target_value)."""
    groups = countries.select(F.col("value").alias(nationality), F.col("target_value").alias(out))
    return join_null_safe(df, groups, [nationality])


def age_bands(df: DataFrame, year: str = "surv_year", birth: str = "bth_year") -> DataFrame:
    """Age in the survey year, in seven and in four bands."""
    if year not in df.columns or birth not in df.columns:
        return df
    age = F.col(year) - F.col(birth)
    return df.withColumns({"age": age, "agecat7": age_band(age, "agecat7from18"), "agecat4": age_band(age, "agecat4from18")})


def education_level(df: DataFrame, levels: DataFrame | None = None, column: str = "sr_educ",
                    codes: Mapping = EDUCATION) -> DataFrame:
    """Education in four levels (an unknown code fails) and, through a code-list map, in three."""
    if column not in df.columns:
        return df
    out = df.withColumn("sr_edlv4", recode_strict(F.col(column), codes, column))
    if levels is None:
        return out
    three = levels.select(F.col("value").alias("sr_edlv4"), F.col("target_value").alias("sr_edlv3"))
    return join_null_safe(out, three, ["sr_edlv4"])


def employment(df: DataFrame, column: str = "sr_empl", out: str = "sr_emplb", codes: Mapping = EMPLOYMENT) -> DataFrame:
    """Small employment groups collapse to one."""
    return df.withColumn(out, replace_values(F.col(column), codes)) if column in df.columns else df


def household_position(df: DataFrame) -> DataFrame:
    """Household position by ordered rules, and a form that folds living with parents into other."""
    have = set(df.columns)
    if not {"hh_alone", "hh_partn", "hh_child", "hh_par"} <= have:
        return df
    is_ = lambda c, v: F.col(c) == v
    others = any_of([is_(c, "yes") for c in HOUSEHOLD_FLAGS if c in have])
    position = (F.when(is_("hh_alone", "yes"), "alone")
                .when(is_("hh_partn", "yes") & is_("hh_child", "no"), "partnr")
                .when(is_("hh_partn", "yes") & is_("hh_child", "yes"), "partkid")
                .when(is_("hh_partn", "no") & is_("hh_child", "yes"), "sinparn")
                .when(is_("hh_partn", "no") & is_("hh_par", "yes"), "wparnt")
                .when(others, "otherhhpos"))
    return df.withColumn("hhpos", position).withColumn(
        "hhposb", replace_values(F.col("hhpos"), {"wparnt": "otherhhpos"}))


def count_yes(df: DataFrame, columns: Sequence[str], out: str, codes: Mapping = YES_NO) -> DataFrame:
    """Number of yes answers; NULL when one is unknown, an error on a code that is not listed."""
    if not set(columns) <= set(df.columns):
        return df
    return df.withColumn(out, row_sum([recode_strict(F.col(c), codes, c, "int") for c in columns]))


def culture_participation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Participant, core public, interested participant and non-participant.

    An unknown code fails. A count of activities is unknown as soon as one activity is, in which
    case the rules on that count do not fire.
    """
    if not set(columns) <= set(df.columns):
        return df

    def listed(column: str, codes: Sequence[str]) -> str:
        return f"`{column}` IN ({', '.join(repr(c) for c in codes)})"

    def number(flag: int) -> str:
        codes = [code for code, flags in CULTURE.items() if code is not None and flags[flag] == 1]
        return " + ".join(f"int(coalesce({listed(c, codes)}, false))" for c in columns)

    known_codes = [code for code in CULTURE if code is not None]
    strange = " OR ".join(f"NOT {listed(c, known_codes)}" for c in columns)
    missing = " OR ".join(f"`{c}` IS NULL OR `{c}` = 'invalid'" for c in columns)
    unsure = " OR ".join(f"`{c}` = 'dkn'" for c in columns)
    state = (f"CASE WHEN {strange} THEN string(raise_error('culture: unknown frequency code')) "
             f"WHEN {missing} THEN 'missing' WHEN {unsure} THEN 'unsure' ELSE 'known' END")
    # one projection per step, so that a count is computed once and not inside every rule
    counted = df.selectExpr("*", f"{state} AS __state", f"{number(0)} AS __weekly", f"{number(1)} AS __monthly",
                            f"{number(2)} AS __part")
    known = F.col("__state") == "known"
    rest = lambda e: e.when(known, "no").when(F.col("__state") == "unsure", "dkn")
    main = counted.withColumns({
        "cultpart": rest(F.when(known & (F.col("__part") >= 1), "yes")),
        "cultcore": rest(F.when(known & ((F.col("__weekly") >= 1) | (F.col("__monthly") >= 2)), "yes")),
    })
    part, core = F.col("cultpart"), F.col("cultcore")
    return main.withColumns({
        "cultintp": (F.when((part == "yes") & (core == "yes"), "no").when((part == "yes") & (core == "no"), "yes")
                     .when((part == "yes") & (core == "dkn"), "dkn").when((part == "no") & (core == "no"), "no")
                     .when((part == "dkn") & (core == "dkn"), "dkn")),
        "cultnonp": F.when(part == "yes", "no").when(part == "no", "yes").when(part == "dkn", "dkn"),
    }).drop("__weekly", "__monthly", "__part", "__state")
