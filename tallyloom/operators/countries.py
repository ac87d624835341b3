"""Country code lists and their chains of categories."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import join_null_safe


def _without_labels(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith("label_") and c != "valuen"])


def country_categories(categories1: DataFrame, categories2: DataFrame) -> DataFrame:
    """The finer categories with the coarser category and home country behind them."""
    up = categories1.select("value", "cl_belgium")
    return join_null_safe(categories2, up, {"cl_countrycat1": "value"})


def country_chain(categories1: DataFrame, categories2: DataFrame, iso: DataFrame) -> DataFrame:
    """ISO countries with all categories; categories without country stay as rows without code."""
    wide = country_categories(categories1, categories2)
    up = _without_labels(wide).withColumnRenamed("value", "__cat")
    # in a full outer join neither side of a hot category could be split or broadcast
    placed = iso.join(up, iso["cl_countrycat2"].eqNullSafe(up["__cat"]), "left").drop("__cat")
    used = iso.select(F.col("cl_countrycat2").alias("__used")).distinct()
    unused = up.join(used, F.col("__cat").eqNullSafe(F.col("__used")), "left_anti").withColumnRenamed("__cat", "cl_countrycat2")
    return placed.unionByName(unused, allowMissingColumns=True)


def by_code(chain: DataFrame, value: str, other: str, other_name: str) -> DataFrame:
    """The same table keyed by one of the two codes, with the other one as a map in last place."""
    out = chain.withColumnsRenamed({value: "value", other: other_name})
    return out.select(*[c for c in out.columns if c != other_name], other_name)


def multi_code_enrich(df: DataFrame, key: Sequence[str], codes: str, lookup: DataFrame, lookup_key: str,
                      columns: Sequence[str], sep: str = ";") -> DataFrame:
    """Look up every code of a ``;`` list and join the distinct results again, in code order.

    One unknown result makes the joined text NULL. Results are made distinct per key by an
    aggregate, so only distinct values of the lookup meet in a group.
    """
    single = df.select(*key, F.posexplode_outer(F.split(F.col(codes), re.escape(sep))).alias("__pos", codes))
    found = join_null_safe(single, lookup.select(F.col(lookup_key).alias("__code"), *columns), {codes: "__code"})
    cells = F.array(*[F.struct(F.lit(c).alias("__column"), F.col(c).cast("string").alias("__value"))
                      for c in [codes, *columns]])
    long = found.select(*key, "__pos", F.inline(cells))
    first = long.groupBy(*key, "__column", "__value").agg(F.min("__pos").alias("__pos"))
    ordered = F.array_sort(F.collect_list(F.struct("__pos", "__value")))
    text = F.when(~F.bool_or(F.col("__value").isNull()), F.array_join(F.transform(ordered, lambda r: r["__value"]), sep))
    joined = first.groupBy(*key, "__column").agg(text.alias("__text"))
    return joined.groupBy(*key).pivot("__column", [codes, *columns]).agg(F.min("__text"))


def defaults_above(df: DataFrame, number: str, limit: float, defaults: Mapping[str, str]) -> DataFrame:
    """Fill unknown categories of statistical codes from ``limit`` on."""
    above = F.col(number) >= limit
    return df.withColumns({c: F.when(above & F.col(c).isNull(), F.lit(v)).otherwise(F.col(c)) for c, v in defaults.items()})


# Categories of codes that are no country.
NO_COUNTRY = {"cl_countrycat2": "other", "cl_countrycat1": "notEU27", "cl_belgium": "notBelgium"}
FIRST_NO_COUNTRY = {"country": 700, "nationality": 8700}
