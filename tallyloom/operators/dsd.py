"""Lint rules for the data structure definition."""

from __future__ import annotations

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.messages import OffendersError, require_none
from ..functions.nulls import join_null_safe

# The types a concept may have.
TYPES = ["character", "date", "datetime", "codelist", "integer", "numeric"]
NUMERIC_TYPES = ["integer", "numeric"]


class DsdError(OffendersError):
    """The data structure definition breaks a rule."""


def _invalid_patterns(patterns: DataFrame, column: str) -> DataFrame:
    """The patterns that Spark's ``rlike`` cannot compile, decided by the compiler it uses.

    Patterns are metadata, one per text concept at most; each distinct one is compiled once on the driver.
    """
    spark = patterns.sparkSession
    compile_ = spark.sparkContext._jvm.java.util.regex.Pattern.compile
    bad = []
    for row in patterns.select(column).distinct().collect():
        try:
            compile_(row[0])
        except IllegalArgumentException:  # what a pattern that does not compile comes back as
            bad.append((row[0],))
    return spark.createDataFrame(bad, f"{column} string")


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("NULL"))


def _row_rules() -> dict[str, tuple[Column, Column]]:
    """Rule name -> (broken, message) for the rules that look at one row only."""
    cid, kind = _text("concept_id"), F.col("constraint_type")
    is_type = F.coalesce(kind.isin(TYPES), F.lit(False))
    is_codelist = F.coalesce(kind == "codelist", F.lit(False))
    is_text = F.coalesce(kind == "character", F.lit(False))
    is_number = F.coalesce(kind.isin(NUMERIC_TYPES), F.lit(False))
    has = {c: F.col(f"constraint_{c}").isNotNull() for c in ("codelist", "regex", "min", "max")}
    concept = lambda tail: F.concat(F.lit("Concept '"), cid, F.lit(f"' {tail}"))
    return {
        "type": (~is_type, F.concat(F.lit("Type '"), _text("constraint_type"), F.lit("' of concept '"), cid,
                                    F.lit("' is not known"))),
        "codelist_on_other_type": (has["codelist"] & ~is_codelist, concept("has a code list but is not of type codelist")),
        "codelist_missing": (is_codelist & ~has["codelist"], concept("does not have a code list")),
        "regex_on_other_type": (has["regex"] & ~is_text, concept("has a regex but is not of type character")),
        "min_on_other_type": (has["min"] & ~is_number, concept("has a minimum but is not numeric")),
        "max_on_other_type": (has["max"] & ~is_number, concept("has a maximum but is not numeric")),
        "min_above_max": (has["min"] & has["max"] & (F.col("constraint_min") > F.col("constraint_max")),
                          concept("has a minimum above its maximum")),
    }


def _column_rules(dsd: DataFrame) -> list[tuple[str, str]]:
    kinds = {f.name: f.dataType for f in dsd.schema.fields}
    bad = [(f"{c}_not_numeric", f"Column constraint_{c} is not numeric") for c in ("min", "max")
           if not isinstance(kinds[f"constraint_{c}"], T.NumericType)]
    if not isinstance(kinds["constraint_allow_missings"], T.BooleanType):
        bad.append(("allow_missings_not_logical", "Column constraint_allow_missings is not logical"))
    return bad


def dsd_lint(dsd: DataFrame, codelists: DataFrame) -> DataFrame:
    """All broken rules as (rule, concept_id, message); empty when the DSD is sound.

    ``codelists`` holds the published list names in a column ``codelist``.
    """
    column_rules = _column_rules(dsd)
    row_rules = {k: v for k, v in _row_rules().items()
                 if not (column_rules and k == "min_above_max")}
    hits = F.array_compact(F.array(*[
        F.when(broken, F.struct(F.lit(rule).alias("rule"), message.alias("message")))
        for rule, (broken, message) in row_rules.items()]))
    found = dsd.select("concept_id", F.explode(hits).alias("hit")).select("hit.rule", "concept_id", "hit.message")

    # the second and later occurrences of a concept, counted without putting them in one group
    counts = dsd.groupBy("concept_id").agg(F.count(F.lit(1)).alias("n"))
    repeats = counts.where("n > 1").select(
        F.lit("duplicate").alias("rule"), "concept_id",
        F.concat(F.lit("concept_id '"), _text("concept_id"), F.lit("' is not unique ("), F.col("n").cast("string"),
                 F.lit(" rows)")).alias("message"))

    named = dsd.where("constraint_codelist IS NOT NULL").select("concept_id", "constraint_codelist")
    absent = join_null_safe(named, codelists.select("codelist").distinct(), {"constraint_codelist": "codelist"}, "left_anti")
    absent = absent.select(
        F.lit("codelist_unknown").alias("rule"), "concept_id",
        F.concat(F.lit("Code list of concept '"), _text("concept_id"), F.lit("' does not exist: '"),
                 F.col("constraint_codelist"), F.lit("'")).alias("message"))

    broken = _invalid_patterns(dsd.where("constraint_regex IS NOT NULL"), "constraint_regex")
    invalid = join_null_safe(dsd.select("concept_id", "constraint_regex"), broken, ["constraint_regex"], "left_semi")
    invalid = invalid.select(
        F.lit("regex_invalid").alias("rule"), "concept_id",
        F.concat(F.lit("Regex of concept '"), _text("concept_id"), F.lit("' is not valid: '"),
                 F.col("constraint_regex"), F.lit("'")).alias("message"))

    report = found.unionByName(repeats).unionByName(absent).unionByName(invalid)
    if column_rules:
        rows = [(rule, None, message) for rule, message in column_rules]
        report = report.unionByName(dsd.sparkSession.createDataFrame(
            rows, "rule string, concept_id string, message string"))
    return report


def publish_dsd(dsd: DataFrame, codelists: DataFrame, path: str) -> None:
    """Write the DSD, or fail with the broken rules."""
    require_none(dsd_lint(dsd, codelists), "broken rules of the DSD", DsdError)
    dsd.write.mode("overwrite").parquet(path)
