"""Register years to weighting margins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.margins import margins_of_cells, population_cells, register_covariates
from ..sources.tables import scan_table_set, write_partitioned

COVARIATES = ("sex", "agecat7", "natltygrp", "province")


def _year_cells(registers: Mapping[int, DataFrame], areas: DataFrame, nationalities: DataFrame, covariates: Sequence[str]) -> DataFrame:
    versions = sorted(r[0] for r in areas.select("version").where("version IS NOT NULL").distinct().collect())
    lists = {y: max((v for v in versions if v <= y), default=None) for y in registers}
    kind = areas.schema["version"].dataType
    stacked = scan_table_set({str(y): df.withColumn("__version", F.lit(lists[y]).cast(kind)) for y, df in registers.items()}, "year").withColumn(
        "year", F.col("year").cast("int"))
    return population_cells(
        register_covariates(stacked, areas.withColumnRenamed("version", "__version"), nationalities, keep=["year"], scope=["__version"]),
        covariates, ["year"])


def margins_all_years(registers: Mapping[int, DataFrame], areas: DataFrame, nationalities: DataFrame,
                      covariates: Sequence[str] = COVARIATES) -> DataFrame:
    """Margins of every year in one job, each with the area list valid in that year.

    ``areas``: (version, value, target_value). Which list holds in which year is decided once, on the versions alone; a year before
    the first list has no areas, and so no persons in scope. The year is one more grouping column, so the registers are scanned
    once and no year waits for another.
    """
    return margins_of_cells(_year_cells(registers, areas, nationalities, covariates), covariates, ["year"])


def store_years(registers: Mapping[int, DataFrame], areas: DataFrame, nationalities: DataFrame, path: str,
                covariates: Sequence[str] = COVARIATES) -> None:
    """Adds years to the table of cells at ``path``: number of persons per year and cell, a partition per year.

    Only the registers given are read. A year that is there already is replaced, the others stay as they are.
    """
    write_partitioned(_year_cells(registers, areas, nationalities, covariates), path, ["year"])


def stored_margins(spark: SparkSession, path: str, covariates: Sequence[str] = COVARIATES) -> DataFrame:
    """Margins of all stored years, from their cells: no register is read again."""
    cells = spark.read.schema(", ".join([*(f"{c} string" for c in covariates), "n long", "year int"])).parquet(path)
    return margins_of_cells(cells, covariates, ["year"])
