"""The codebook of an edition as a table."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.messages import OffendersError, require_none
from ..functions.nulls import join_null_safe


_COPIES = 32  # of the code lists, among which variables are dealt


class CodebookError(OffendersError):
    """Metadata that does not allow a codebook."""


def concepts_without_question(variables: DataFrame, questions: DataFrame) -> DataFrame:
    return join_null_safe(variables.select("concept_id").distinct(), questions.select("concept_id").distinct(),
                          ["concept_id"], "left_anti")


def asked_variables(variables: DataFrame, dsd: DataFrame, questions: DataFrame) -> DataFrame:
    """Variables with the constraints and the question of their concept."""
    concept = join_null_safe(variables, dsd.select("concept_id", "constraint_type", "constraint_codelist"), ["concept_id"])
    return join_null_safe(concept, questions.select("concept_id", "varlabel", "question", "question_item"), ["concept_id"])


def listed_codes(codelists: DataFrame) -> DataFrame:
    return codelists.select(F.col("codelist").alias("__list"), F.col("pos").alias("code_pos"), "valuen", "value")


def expanded_variables(variables: DataFrame, dsd: DataFrame, questions: DataFrame, codelists: DataFrame) -> DataFrame:
    """One row per variable and code; variables without code list keep one row."""
    asked, codes = asked_variables(variables, dsd, questions), listed_codes(codelists)
    return asked.join(codes, asked["constraint_codelist"] == codes["__list"], "left").drop("__list")


def with_lists(variables: DataFrame, lists: DataFrame, own: str, how: str) -> DataFrame:
    """Variables next to the rows of their list, dealt over copies of the lists, as most variables may share one list or have none."""
    dealt = variables.withColumn("__copy", F.pmod(F.xxhash64("pos", "variable", "concept_id"), F.lit(_COPIES)))
    copies = lists.withColumn("__copy", F.explode(F.array(*[F.lit(i).cast("long") for i in range(_COPIES)])))
    return join_null_safe(dealt, copies, {own: "__list", "__copy": "__copy"}, how).drop("__copy")


def values_without_label(expanded: DataFrame, answers: DataFrame) -> DataFrame:
    used = expanded.where("value IS NOT NULL").select("value").distinct()
    return join_null_safe(used, answers.select("value").distinct(), ["value"], "left_anti")


def codebook(variables: DataFrame, dsd: DataFrame, questions: DataFrame, answers: DataFrame, codelists: DataFrame,
             check: bool = True) -> DataFrame:
    """Columns varname, varlabel, question, valn, valc in questionnaire order (pos, code_pos).

    Name, label and question stand on the first row of a concept only. That row is found among the
    variables, with the first code of their list, before codes multiply the rows; labels are joined
    to the lists. So what is sorted and shuffled is as long as the variables, not as the codebook.
    """
    if check:
        require_none(concepts_without_question(variables, questions), "concepts without question", CodebookError)
    asked, codes = asked_variables(variables, dsd, questions), listed_codes(codelists).where("__list IS NOT NULL")
    if check:
        used = codes.join(asked.select(F.col("constraint_codelist").alias("__list")).distinct(), "__list", "left_semi")
        require_none(values_without_label(used, answers), "code values without answer label", CodebookError)
    rank = lambda code: F.struct("pos", F.coalesce("question", F.lit("")).alias("q"), F.coalesce(code, F.lit(0)).alias("c"))
    lists = codes.groupBy("__list").agg(F.min(F.coalesce("code_pos", F.lit(0))).alias("__code")).withColumn("__own", F.col("__list"))
    # __own is NULL where a variable has no list or one without codes; such rows meet an entry without code
    listed = with_lists(asked, lists, "constraint_codelist", "left")
    first = listed.groupBy("concept_id").agg(F.min(rank("__code")).alias("__first"))
    marked = join_null_safe(listed.drop("__code"), first, ["concept_id"])
    uncoded = codes.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in codes.schema.fields])
    entries = join_null_safe(codes.unionByName(uncoded), answers.select("value", "vallabel"), ["value"])
    marked = with_lists(marked, entries, "__own", "inner").withColumn("__rank", rank("code_pos"))
    on_first = lambda e: F.when(F.col("__rank") == F.col("__first"), e).otherwise("")
    number = F.col("valuen").cast("double")
    code = (F.when(F.pmod(number, F.lit(1.0)) == 0, F.format_string("%.0f", number))
            .when(F.pmod(number, F.lit(1.0)) != 0, F.format_string("%.2f", number))
            .otherwise(F.concat(F.lit("["), F.col("constraint_type"), F.lit("]"))))
    return marked.select(
        "pos", "code_pos", "concept_id",
        on_first(F.col("variable")).alias("varname"), on_first(F.col("varlabel")).alias("varlabel"),
        on_first(F.concat_ws(" ", "question", "question_item")).alias("question"),
        code.alias("valn"), F.col("vallabel").alias("valc"))


# Wording of the title lines; placeholders are columns of the edition table.
TITLE_LINES = {
    "TITEL": "Codeboek {surv_id} ({surv_semester} {surv_year})",
    "BESCHRIJVING": "Bevraging bij {sample_n} personen",
    "CONTACTPERSOON": "{cntctprs}",
    "VELDWERKBUREAU": "{fw_org}",
}


def _fill(template: str) -> Column:
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.col(p).cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def title_block(editions: DataFrame, lines: Mapping[str, str] = TITLE_LINES) -> DataFrame:
    """Title lines of the codebook of each edition, as (surv_id, line, key, value)."""
    rows = F.array(*[F.struct(F.lit(i + 1).alias("line"), F.lit(k).alias("key"), _fill(v).alias("value"))
                     for i, (k, v) in enumerate(lines.items())])
    return editions.select("surv_id", F.inline(rows))
