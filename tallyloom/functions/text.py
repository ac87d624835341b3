"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squish(column: Column) -> Column:
    """Trim and collapse every run of white space to one space."""
    return F.trim(F.regexp_replace(column, r"\s+", " "))


def sentence_case(column: Column) -> Column:
    """First character upper case, the rest lower case."""
    return F.concat(F.upper(F.substring(column, 1, 1)), F.lower(F.substring(column, 2, 2_147_483_647)))


def title_case(column: Column) -> Column:
    """Upper case at each word start, also after a hyphen; an apostrophe does not start a word."""
    words = F.split(column, r"(?<![\p{L}\p{M}\p{N}'’])(?=\p{L})")
    return F.array_join(F.transform(words, sentence_case), "")
