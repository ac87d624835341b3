"""One edition from raw sample and responses to weighted, published microdata."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cleaning, derive, identifiers, margins, raking, responses, validation
from ..operators.batteries import clean_batteries, clean_filters
from ..operators.responses import Question
from ..session import compiled_apart, compiled_methods, emptied_stages, stage_table
from ..sources.tables import write_partitioned
from .config import EditionConfig


@dataclass
class EditionInputs:
    """Tables of one edition. Maps are (value, target_value); targets are (covariate, category, p)."""

    sample: DataFrame
    survey: DataFrame
    edition: DataFrame
    contacts: DataFrame
    targets: DataFrame
    countries: DataFrame | None = None
    areas: dict[str, DataFrame] | None = None
    education: DataFrame | None = None


@dataclass
class EditionMetadata:
    """What a run is checked against: the DSD of the raw survey and that of the result, with the code lists of both.

    ``answers`` is (value, vallabel), ``variables`` (variable, concept_id), ``editions`` has surv_id and sample_n.
    """

    survey_dsd: DataFrame
    published_dsd: DataFrame
    codelists: DataFrame
    answers: DataFrame
    variables: DataFrame
    editions: DataFrame
    technical: tuple[str, ...] = ("resp_qrurl",)


def clean_responses(df: DataFrame, cfg: EditionConfig) -> DataFrame:
    """Corrections, batteries, filters: expressions over the columns of one row.

    The rules of a whole row are more code than the JIT compiles in one method, so they go in parts.
    """
    return (df.transform(cleaning.correct_inconsistencies)
            .transform(clean_batteries, cfg.batteries).transform(compiled_apart)
            .transform(clean_filters, cfg.filters))


def analyse_responses(df: DataFrame, questions: Sequence[Question], cfg: EditionConfig) -> DataFrame:
    """Completion, disposition, status and wave, also over the columns of one row."""
    return (df.transform(responses.response_profile, questions, cfg.demographics).transform(compiled_apart)
            .transform(responses.disposition).transform(responses.status).transform(responses.response_wave)
            .drop("resp_demo", "resp_share", "invitation", "reminder_1", "reminder_2", "resp_fwdisp"))


def derive_variables(df: DataFrame, inputs: EditionInputs, cfg: EditionConfig) -> DataFrame:
    """Derived variables of the de-duplicated responses: expressions and joins to small code lists."""
    out = df
    for detail, target in derive.municipality_columns(out.columns):
        if inputs.areas and detail in inputs.areas:
            out = derive.geo_rollup(out, inputs.areas[detail], detail, target)
    if inputs.countries is not None and "natlty" in out.columns:
        out = derive.nationality_group(out, inputs.countries)
    out = derive.age_bands(out)
    out = derive.education_level(out, inputs.education)
    out = derive.household_position(derive.employment(out))
    for name, (columns, codes) in cfg.counts.items():
        out = derive.count_yes(out, columns, name, codes)
    return derive.culture_participation(out, cfg.culture)


def weight_responses(df: DataFrame, targets: DataFrame, cfg: EditionConfig) -> DataFrame:
    """Raked weights for respondents whose covariates are known.

    Covariates are those of the configuration and those found by name, as far as there are targets.
    """
    found = [c for c in df.columns if re.fullmatch(cfg.found_covariates, c) and c not in cfg.covariates]
    used = raking.usable_covariates(df, targets, [*cfg.covariates, *found])
    frame = margins.raking_frame(df, used, cfg.response)
    goals = margins.normalise_margins(targets, used)
    cells = raking.rake_cells(frame, goals, used, cfg.cap, cfg.tol, cfg.max_sweeps)
    return raking.attach_cell_weights(df, cells, used, F.col("resp_stat") == "resp")


def name_responses(df: DataFrame, cfg: EditionConfig, source: DataFrame) -> DataFrame:
    """Pseudonymous identifiers instead of the person and response keys, which leave the data."""
    return identifiers.pseudonymous_ids(df, [cfg.person, cfg.response], cfg.surv_id, cfg.salt,
                                        drop=[cfg.person, cfg.response], source=source)


def process_edition(inputs: EditionInputs, questions: Sequence[Question], cfg: EditionConfig) -> DataFrame:
    """The whole chain.

    Two stages are written to the shared folder, as later steps read them more than once: the
    analysed responses (best response per person, then all its columns) and the single responses
    (raking cells, identifiers, result). Identifiers come last, so that raking does not wait for them.
    """
    merged = cleaning.merge_sources(inputs.sample, inputs.survey, inputs.edition, inputs.contacts, cfg.surv_id)
    with compiled_methods(merged.sparkSession):
        analysed = stage_table(analyse_responses(clean_responses(compiled_apart(merged), cfg), questions, cfg))
        single = stage_table(responses.dedupe_responses(analysed, cfg.person, cfg.response if cfg.break_ties else None))
    weighted = weight_responses(derive_variables(single, inputs, cfg), inputs.targets, cfg)
    return name_responses(weighted, cfg, single)


def publish_edition(df: DataFrame, editions: DataFrame, dsd: DataFrame, codelists: DataFrame, path: str) -> DataFrame:
    """Check the number of persons and the DSD, then write the edition's partition.

    The checks read the columns they are about from a staged table, not the whole chain again.
    """
    df = stage_table(df)
    wrong = validation.sample_size_check(df, editions).join(df.select("surv_id").distinct(), "surv_id", "left_semi").collect()
    if wrong:
        raise validation.ValidationError("\n".join(
            f"{r['surv_id']}: {r['n']} sample members in data, {r['sample_n']} in metadata" for r in wrong))
    checked = validation.validate(df, dsd, codelists)
    write_partitioned(checked, path, ["surv_id"])
    return checked


def relabel_survey(survey: DataFrame, dsd: DataFrame, codelists: DataFrame, answers: DataFrame,
                   variables: DataFrame) -> DataFrame:
    """Raw survey with displayed labels -> code values under concept names."""
    named = {r["variable"]: r["concept_id"] for r in
             variables.where(F.col("variable").isin(survey.columns)).select("variable", "concept_id").collect()}
    concepts = {c.concept_id: c for c in validation.concepts_for(dsd, list(named.values()))}
    lists = {v: concepts[c].codelist for v, c in named.items() if c in concepts and concepts[c].kind == "codelist"}
    # looked up once per column, so computed once
    displays = stage_table(validation.display_values(codelists, answers))
    return survey.transform(validation.relabel_codes, lists, displays).withColumnsRenamed(named)


def read_survey(survey: DataFrame, meta: EditionMetadata) -> DataFrame:
    """Raw responses with displayed labels -> checked responses with code values under concept names.

    The cross-field rules, the raw DSD and the labels are checked first, so no unknown label is lost as NULL.
    """
    named = validation.rename_to_concepts(validation.require_consistent(survey), meta.variables)
    displays = stage_table(validation.display_values(meta.codelists, meta.answers))
    checked = validation.validate(named, meta.survey_dsd, displays.select("codelist", F.col("display").alias("value")))
    lists = {c.concept_id: c.codelist for c in validation.concepts_for(meta.survey_dsd, checked.columns) if c.kind == "codelist"}
    return cleaning.drop_technical(validation.relabel_codes(checked, lists, displays), meta.technical)


def run_edition(inputs: EditionInputs, meta: EditionMetadata, questions: Sequence[Question], cfg: EditionConfig, path: str) -> DataFrame:
    """The chain with its checks before and after: the raw survey in ``inputs`` -> the edition's published partition, read back.

    Stage tables, which hold answers next to person keys, are empty when this returns or fails.
    """
    with emptied_stages():
        out = process_edition(replace(inputs, survey=read_survey(inputs.survey, meta)), questions, cfg)
        publish_edition(out, meta.editions, meta.published_dsd, meta.codelists, path)
    return inputs.sample.sparkSession.read.parquet(path).where(F.col("surv_id") == cfg.surv_id)
