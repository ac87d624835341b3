"""Versioned registries, edition lookups, mailings and the data structure definition (DSD)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.messages import OffendersError, require_none
from ..functions.nulls import filter_out, join_null_safe
from ..sources.tables import require_columns
from .ordered import last_before
from .ranking import group_size, slice_best

# Required columns of each metadata table.
REQUIRED = {
    "editions": ["surv_id", "fw_period", "surv_year", "surv_semester", "sample_n"],
    "mailings": ["fw_period", "contact", "date"],
    "questions": ["concept_id", "from_surv_id", "varlabel", "question_module", "question", "question_item"],
    "answers": ["value", "from_surv_id", "vallabel"],
    "survey_variables": ["variable", "concept_id"],
    "sample_variables": ["concept_id", "variable"],
    "dsd": ["concept_id", "label_nl", "constraint_type", "constraint_codelist", "constraint_regex",
            "constraint_min", "constraint_max", "constraint_allow_missings"],
}
# Contacts of one field work period, in order.
CONTACTS = ["invitation", "reminder_1", "reminder_2"]


class MetadataError(OffendersError):
    """Metadata that does not allow the edition to be processed."""


def asof_version(df: DataFrame, key: Sequence[str], version: str, as_of: Column | str) -> DataFrame:
    """Per key, the rows of the newest version that is not after ``as_of``; the version is dropped."""
    limit = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return slice_best(df.where(F.col(version) <= limit), key, [F.col(version)]).drop(version)


def asof_questions(questions: DataFrame, surv_id: str) -> DataFrame:
    return asof_version(questions, ["concept_id"], "from_surv_id", surv_id)


def asof_answers(answers: DataFrame, surv_id: str) -> DataFrame:
    return asof_version(answers, ["value"], "from_surv_id", surv_id)


def version_intervals(versions: DataFrame, start: str, by: Sequence[str] = (), end: str = "end") -> DataFrame:
    """Last year in which each version holds: one before the next start, NULL for the current one.

    ``versions`` is a registry, one row per version.
    """
    return versions.withColumn(end, F.lead(start).over(Window.partitionBy(*by).orderBy(start)) - 1)


def version_as_of(requests: DataFrame, versions: DataFrame, year: str, version: str,
                  out: str = "version") -> DataFrame:
    """For every requested year, the newest version not after it (NULL if there is none).

    Versions become intervals, intervals become years, and years join by equality.
    """
    newest = requests.agg(F.max(year).alias("__newest"))
    spans = version_intervals(versions.select(version).distinct(), version, end="__end")
    last = F.least(F.coalesce(F.col("__end"), F.col("__newest")), F.col("__newest"))
    valid = (spans.withColumn("__newest", newest.scalar())
             .where(F.col(version) <= last)
             .select(F.col(version).alias(out), F.explode(F.sequence(F.col(version), last)).alias("__year")))
    return join_null_safe(requests, valid, {year: "__year"})


def valid_versions(rows: DataFrame, at: str, versions: DataFrame, since: str, values: Sequence[str], by: Sequence[str] = (),
                   until: str | None = None) -> DataFrame:
    """Adds to each row the ``values`` of the version of its key that holds at the row's own date; NULL if none does.

    A version holds from ``since`` to the next one of its key, or to ``until`` where that comes first. See last_before.
    """
    return last_before(rows, at, versions, since, values, by, until)


def lookup_counts(requested: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """For every requested key the number of registry rows and a status: missing, ok or multiple."""
    found = join_null_safe(requested.select(key).distinct(), group_size(registry, [key], "n"), [key])
    n = F.coalesce(F.col("n"), F.lit(0))
    status = F.when(n == 0, "missing").when(n == 1, "ok").otherwise("multiple")
    return found.select(key, n.cast("long").alias("n"), status.alias("status"))


def exactly_one(registry: DataFrame, key: str, value, what: str = "registry") -> DataFrame:
    """The single row for ``value``; fails when it is absent or occurs more than once."""
    rows = registry.where(F.col(key) == F.lit(value))
    found = len(rows.select(key).limit(2).collect())
    if found == 0:
        raise MetadataError(f"the {what} knows no {value}")
    if found > 1:
        raise MetadataError(f"the {what} has more than one {value}")
    return rows


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of missing values, from one aggregate."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot([], list(columns), "column", "n_missing")


def require_no_nulls(df: DataFrame, columns: Sequence[str], what: str = "table") -> DataFrame:
    bad = [r["column"] for r in null_counts(df, columns).where("n_missing > 0").collect()]
    if bad:
        raise MetadataError(f"Missing values in {what}: {', '.join(sorted(bad))}")
    return df


def contact_problems(mailings: DataFrame, period: str = "fw_period", contact: str = "contact",
                     contacts: Sequence[str] = CONTACTS) -> DataFrame:
    """Per field work period, the expected contacts that do not occur exactly once."""
    counts = group_size(mailings.where(F.col(contact).isin(list(contacts))), [period, contact])
    expected = mailings.select(period).distinct().select(
        period, F.explode(F.array(*[F.lit(c) for c in contacts])).alias(contact))
    n = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    message = F.concat(F.col(contact), F.when(n == 0, F.lit(": no mailing")).otherwise(F.lit(": several mailings")))
    joined = join_null_safe(expected, counts, [period, contact])
    return filter_out(joined.select(period, contact, n.alias("n"), message.alias("message")), F.col("n") == 1)


def mailings_wide(mailings: DataFrame, period: str = "fw_period", contact: str = "contact", date: str = "date",
                  contacts: Sequence[str] = CONTACTS) -> DataFrame:
    """One column per contact with its date. Two dates of one contact are an error when the result is computed."""
    listed = F.coalesce(F.col(contact).isin(list(contacts)), F.lit(False))
    one = F.when(F.min(date).eqNullSafe(F.max(date)) | ~listed, F.min(date)).otherwise(
        F.raise_error(F.lit("a contact has several dates")).cast(mailings.schema[date].dataType))
    single = mailings.groupBy(period, contact).agg(one.alias(date))
    return single.groupBy(period).pivot(contact, list(contacts)).agg(F.min(date))


def read_mailings(mailings: DataFrame, fw_period: str) -> DataFrame:
    """The contact dates of one field work period, after the completeness check."""
    require_columns(mailings, REQUIRED["mailings"], "mailings")
    own = mailings.where(F.col("fw_period") == fw_period)
    if own.isEmpty():
        raise MetadataError(f"field work period {fw_period} has no mailing at all")
    require_none(contact_problems(own), f"contacts of field work period {fw_period} without exactly one mailing", MetadataError)
    return mailings_wide(own)


def missing_concepts(wanted: DataFrame, dsd: DataFrame) -> DataFrame:
    """Requested concepts the DSD does not know."""
    return join_null_safe(wanted.select("concept_id").distinct(), dsd.select("concept_id").distinct(),
                          ["concept_id"], "left_anti")


def load_dsd(dsd: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """The DSD rows of the requested concepts, which must all exist."""
    require_columns(dsd, REQUIRED["dsd"], "the DSD")
    if wanted is None:
        return dsd
    require_none(missing_concepts(wanted, dsd), "concepts without a DSD row", MetadataError)
    return join_null_safe(dsd, wanted.select("concept_id").distinct(), ["concept_id"], "left_semi")


def dsd_with_codelists(dsd: DataFrame, codelists: DataFrame, fields: Sequence[str] = ("valuen", "value"),
                       order: str = "pos", out: str = "constraint_codelist_ds") -> DataFrame:
    """Attach each code list as a nested, ordered array; concepts without a list get an empty one."""
    present = [f for f in fields if f in codelists.columns]
    packed = codelists.groupBy("codelist").agg(F.array_sort(F.collect_list(F.struct(order, *present))).alias("__rows"))
    packed = packed.select("codelist", F.transform("__rows", lambda r: F.struct(*[r[f].alias(f) for f in present])).alias(out))
    joined = dsd.join(packed, dsd["constraint_codelist"] == packed["codelist"], "left").drop("codelist")
    return joined.withColumn(out, F.coalesce(F.col(out), F.array().cast(packed.schema[out].dataType)))


def edition_structure(skeleton: DataFrame, concepts: DataFrame, format_column: str) -> DataFrame:
    """Older form of an edition's DSD: its variables with the labels and format of their concepts."""
    joined = join_null_safe(skeleton.select("variable", "concept_id"),
                            concepts.select("concept_id", "label_nl", "label_fr", "label_en", format_column),
                            ["concept_id"])
    return joined.select(F.col("variable").alias("concept_id"), "label_nl", "label_fr", "label_en",
                         F.col(format_column).alias("format"))
