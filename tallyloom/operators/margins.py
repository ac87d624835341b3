"""Population margins from a person register."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.bands import age_band
from ..functions.nulls import join_null_safe
from ..functions.recode import recode

# Sex codes of the register.
SEX = {1: "male", 2: "female"}


def register_covariates(register: DataFrame, areas: DataFrame, nationalities: DataFrame,
                        province: str = "province", keep: Sequence[str] = (), scope: Sequence[str] = ()) -> DataFrame:
    """Adults living in the listed areas, with sex, age band, nationality group and province.

    ``areas``: (value, target_value), one row per municipality in scope, or one per municipality and
    value of the ``keep`` and ``scope`` columns (years, versions) where it has those; ``nationalities``: (value,
    target_value). ``scope`` columns are not returned. The filter on areas is the join that attaches the province.
    """
    adults = register.where(F.col("MS_AGE") >= 18).select(*keep, *scope, "CD_REFNIS", "CD_SEX", "MS_AGE", "CD_NATLTY")
    extra = [c for c in (*keep, *scope) if c in areas.columns]
    placed = join_null_safe(adults, areas.select(*extra, F.col("value").alias("CD_REFNIS"),
                                                 F.col("target_value").alias(province)),
                            [*extra, "CD_REFNIS"], "inner")
    grouped = join_null_safe(placed, nationalities.select(
        F.col("value").alias("CD_NATLTY"), F.col("target_value").alias("natltygrp")), ["CD_NATLTY"])
    return grouped.select(*keep, recode(F.col("CD_SEX"), SEX).alias("sex"),
                          age_band(F.col("MS_AGE"), "agecat7from18").alias("agecat7"), "natltygrp", province)


def population_cells(df: DataFrame, covariates: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Number of persons ``n`` in every cell of covariates that occurs: what margins need to know of the persons."""
    return df.groupBy(*by, *covariates).agg(F.count(F.lit(1)).alias("n"))


def margins_of_cells(cells: DataFrame, covariates: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per covariate, the share of each category; unknown categories do not count.

    Cells may come in any number of rows each (several years, several deliveries): their numbers add up.
    """
    long = cells.select(*by, *covariates, F.col("n").alias("__n")).unpivot([*by, "__n"], list(covariates), "covariate", "category")
    counts = long.where("category IS NOT NULL").groupBy(*by, "covariate", "category").agg(F.sum("__n").alias("n"))
    # one row per category from here on
    total = F.sum("n").over(Window.partitionBy(*by, "covariate"))
    return counts.select(*by, "covariate", "category", "n", (F.col("n") / total).alias("p"))


def population_margins(df: DataFrame, covariates: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per covariate, the share of each category; unknown categories do not count.

    One scan and one aggregate over the persons, down to the cells that occur; all margins (and,
    with ``by``, all years) then come from the cells.
    """
    return margins_of_cells(population_cells(df, covariates, by), covariates, by)


def normalise_margins(margins: DataFrame, covariates: Sequence[str] | None = None) -> DataFrame:
    """Shares of the covariates in use, scaled to sum to one."""
    used = margins if covariates is None else margins.where(F.col("covariate").isin(list(covariates)))
    total = F.sum("p").over(Window.partitionBy("covariate"))
    return used.select("covariate", "category", (F.col("p") / total).alias("p"))


def raking_frame(df: DataFrame, covariates: Sequence[str], row_key: str = "resp_id",
                 where: Mapping[str, str] | None = None) -> DataFrame:
    """Respondents with all covariates known."""
    conditions = {"resp_stat": "resp"} if where is None else where
    for column, value in conditions.items():
        df = df.where(F.col(column) == value)
    return df.select(row_key, *covariates).dropna(subset=list(covariates))
