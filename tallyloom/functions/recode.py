"""Value recoding as CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _chain(column: Column, mapping: Mapping, start: Column | None = None) -> Column:
    expr = start
    for old, new in mapping.items():
        hit = column.isNull() if old is None else column == F.lit(old)
        expr = F.when(hit, F.lit(new)) if expr is None else expr.when(hit, F.lit(new))
    return expr


def recode(column: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Map values; anything not listed becomes ``default`` (NULL if not given)."""
    expr = _chain(column, mapping)
    return expr if default is None else expr.otherwise(default)


def replace_values(column: Column, mapping: Mapping) -> Column:
    """Map values; anything not listed is kept. A target may be None."""
    return _chain(column, mapping).otherwise(column)


def recode_strict(column: Column, mapping: Mapping, name: str, dtype: str = "string") -> Column:
    """Map values; a value that is not listed fails the query. List None to allow NULL."""
    problem = F.concat(F.lit(f"{name}: no recode for value "), F.coalesce(column.cast("string"), F.lit("NULL")))
    return _chain(column, mapping).otherwise(F.raise_error(problem).cast(dtype)).cast(dtype)


def replace_everywhere(df: DataFrame, mapping: Mapping) -> DataFrame:
    """Apply one replacement table to every text column, in a single projection."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[
        replace_values(F.col(c), mapping).alias(c) if c in text else F.col(c) for c in df.columns
    ])
