"""A small edition from labelled raw data to a published partition."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import validation as v
from tallyloom.operators.batteries import Battery, FilteredQuestion
from tallyloom.operators.responses import question_list, question_progress
from tallyloom.plans.config import BATTERIES, COUNTS, FILTERS, EditionConfig
from tallyloom.plans.edition import EditionInputs, EditionMetadata, analyse_responses, clean_responses, process_edition, publish_edition, read_survey, relabel_survey
from tallyloom.plans.population import margins_all_years
from tallyloom.session import COMPILED_METHOD, compiled_apart, compiled_methods, emptied_stages, stage_table
from tallyloom.workload import q_editions

DSD = "concept_id string, label_nl string, constraint_type string, constraint_codelist string, constraint_regex string, " \
      "constraint_min double, constraint_max double, constraint_allow_missings boolean"
CONCEPTS = {"surv_id": "character", "sex": "yn", "bth_year": "integer", "resp_mode": "character", "resp_date": "date", "fw_period": "character", "surv_year": "integer",
            "surv_semester": "character", "sr_sex": "yn", "hh_partn": "yn", "hh_child": "yn", "hh_par": "yn", "hh_dk": "yn", "hh_alone": "yn", "sr_chron": "yn",
            "sr_illim": "yn", "resp_pct": "numeric", "resp_drop": "character", "resp_disp": "character", "resp_stat": "character", "resp_time": "character",
            "age": "integer", "agecat7": "character", "agecat4": "character", "hhpos": "character", "hhposb": "character", "psweight": "numeric",
            "resp_id": "character", "resp_id_suf": "character", "resp_id_puf": "character"}


def _dsd(spark):
    rows = [(c, c, "codelist" if k == "yn" else k, "yn" if k == "yn" else None, None, None, 5.0 if c == "psweight" else None, c not in ("surv_id", "resp_id"))
            for c, k in CONCEPTS.items()]
    return spark.createDataFrame(rows, DSD)


def _raw(spark):
    def answer(i, k):
        return {0: "Ja", 1: "Neen", 2: "Weet niet", 3: None}[(i * 7 + k * 3) % 4]
    names = ["V1", "V2", "V3", "V4", "V5", "V6", "V7", "V8"]
    rows = [(i * 10 + d, i, "online", dt.date(2024, 1, 1 + d), "answer", *[answer(i + d, k) or ("Ja" if k == 0 else None) for k in range(8)])
            for i in range(40) if i % 4 for d in range(1 + i % 3)]
    return spark.createDataFrame(rows, "row_id int, pseudo_id int, resp_mode string, resp_date date, resp_fwdisp string, " + ", ".join(f"{n} string" for n in names))


def test_edition_end_to_end(spark, rows, tmp_path):
    lists = spark.createDataFrame([("yn", 1, 1.0, "yes"), ("yn", 2, 2.0, "no"), ("yn", 3, 9.0, "dkn"), ("yn", 4, 8.0, "na")],
                                  "codelist string, pos int, valuen double, value string")
    answers = spark.createDataFrame([("yes", "Ja"), ("no", "Neen"), ("dkn", "Weet niet")], "value string, vallabel string")
    asked = ["sr_sex", "hh_partn", "hh_child", "hh_par", "hh_dk", "hh_alone", "sr_chron", "sr_illim"]
    variables = spark.createDataFrame([(i, f"V{i + 1}", c) for i, c in enumerate(asked)], "pos int, variable string, concept_id string")
    questions = spark.createDataFrame([(c, "m") for c in asked], "concept_id string, question_module string")

    survey = relabel_survey(_raw(spark), _dsd(spark), lists, answers, variables)
    assert set(asked) <= set(survey.columns)
    assert {r for r, in rows(survey.select("sr_sex").distinct())} == {"yes", "no", "dkn"}

    sample = spark.createDataFrame([(i, "yes" if i % 2 else "no", 1950 + i) for i in range(40)], "pseudo_id int, sex string, bth_year int")
    edition = spark.createDataFrame([("SV0001", "P1", 2024, "spring", 40)], "surv_id string, fw_period string, surv_year int, surv_semester string, sample_n int")
    contacts = spark.createDataFrame([("P1", dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3))],
                                     "fw_period string, invitation date, reminder_1 date, reminder_2 date")
    targets = spark.createDataFrame([("sex", "yes", 0.5), ("sex", "no", 0.5)], "covariate string, category string, p double")
    cfg = EditionConfig("SV0001", "salt", demographics=("sr_sex",), covariates=("sex",))
    out = process_edition(EditionInputs(sample, survey, edition, contacts, targets), question_list(question_progress(variables, questions)), cfg)

    table = out.toPandas()
    assert len(table) == 40 and table.resp_id.nunique() == 40 and "pseudo_id" not in table and "row_id" not in table
    assert sorted(table.resp_id)[0] == "SV0001-0001" and (table.resp_disp == "refusal").sum() == 10
    weighted = table[table.psweight.notna()]
    assert set(weighted.resp_stat) == {"resp"} and len(weighted) == (table.resp_stat == "resp").sum()
    assert weighted.groupby("sex").psweight.sum().tolist() == pytest.approx([len(weighted) / 2] * 2)
    # the filtered question was asked of the chronically ill only
    assert set(table[table.sr_chron == "no"].sr_illim) <= {"na"}

    path = str(tmp_path / "cleaned")
    publish_edition(out, edition, _dsd(spark), lists, path)
    back = spark.read.parquet(path)
    assert back.where("surv_id = 'SV0001'").count() == 40
    with pytest.raises(v.ValidationError, match="40 sample members in data, 41 in metadata"):
        publish_edition(out, edition.withColumn("sample_n", F.lit(41)), _dsd(spark), lists, path)
    with pytest.raises(v.ValidationError, match="extra: concept without column"):
        publish_edition(out, edition, _dsd(spark).union(spark.createDataFrame([("extra", "x", "character", None, None, None, None, True)], DSD)), lists, path)


def test_default_configuration():
    assert [len(b.options) for b in BATTERIES] == [7, 13, 15, 7, 5, 11, 2, 14]
    assert all(isinstance(b, Battery) for b in BATTERIES) and all(isinstance(f, FilteredQuestion) for f in FILTERS)
    assert len(FILTERS) == 9 and set(COUNTS) == {"netntot", "patot", "memtot"}


def test_each_year_uses_its_own_area_list(spark, rows):
    register = spark.createDataFrame([(1, 1, 30, 5), (2, 2, 40, 5), (3, 1, 50, None), (1, 1, 10, 5)], "CD_REFNIS int, CD_SEX int, MS_AGE int, CD_NATLTY int")
    areas = spark.createDataFrame([(2019, 1, "p1"), (2019, 2, "p2"), (2022, 1, "q1"), (2022, 3, "q3")], "version int, value int, target_value string")
    groups = spark.createDataFrame([(5, "home")], "value int, target_value string")
    out = margins_all_years({2021: register, 2023: register}, areas, groups)
    assert rows(out.where("covariate = 'province'"), "year", "category", "p") == [(2021, "p1", 0.5), (2021, "p2", 0.5), (2023, "q1", 0.5), (2023, "q3", 0.5)]
    assert rows(out.where("covariate = 'natltygrp'"), "year", "n", "p") == [(2021, 2, 1.0), (2023, 1, 1.0)]


def _metadata(spark):
    lists = spark.createDataFrame([("yn", "yes"), ("yn", "no"), ("yn", "dkn")], "codelist string, value string")
    answers = spark.createDataFrame([("yes", "Ja"), ("no", "Neen"), ("dkn", "Weet niet")], "value string, vallabel string")
    kinds = {"row_id": "integer", "resp_mode": "character", "resp_date": "date", "resp_fwdisp": "character", "resp_qrurl": "character", "sr_sex": "codelist"}
    survey = spark.createDataFrame([(c, c, k, "yn" if k == "codelist" else None, None, None, None, c != "row_id") for c, k in kinds.items()], DSD)
    variables = spark.createDataFrame([("V1", "sr_sex")], "variable string, concept_id string")
    return EditionMetadata(survey, survey, lists, answers, variables, spark.createDataFrame([("SV0001", 1)], "surv_id string, sample_n int"))


def _survey(spark, label, mode="online"):
    return spark.createDataFrame([(1, mode, dt.date(2024, 1, 1), "answer", "url", label), (2, mode, dt.date(2024, 1, 1), "answer", "url", None)],
                                 "row_id int, resp_mode string, resp_date date, resp_fwdisp string, resp_qrurl string, V1 string")


def test_raw_survey_is_checked_before_labels_become_codes(spark, rows):
    meta = _metadata(spark)
    assert rows(read_survey(_survey(spark, "Ja"), meta), "row_id", "sr_sex") == [(1, "yes"), (2, None)]
    assert "resp_qrurl" not in read_survey(_survey(spark, "Ja"), meta).columns
    with pytest.raises(v.ValidationError, match="sr_sex: codelist"):
        read_survey(_survey(spark, "Misschien"), meta)
    with pytest.raises(v.ValidationError, match="not online but with date: 2 responses"):
        read_survey(_survey(spark, "Ja", "paper"), meta)


def test_stages_are_empty_after_their_scope(spark):
    df = spark.range(10).selectExpr("id", "id % 2 AS k")
    outside = stage_table(df)
    with pytest.raises(ZeroDivisionError), emptied_stages():
        plain, parted = stage_table(df), stage_table(df, ("k",))
        assert plain.count() == parted.count() == 10
        raise ZeroDivisionError
    for staged in (plain, parted):
        folder = staged.inputFiles()[0].split("/stage-")[0] + "/stage-" + staged.inputFiles()[0].split("/stage-")[1].split("/")[0]
        assert spark.read.schema(df.schema).parquet(folder).count() == 0
    assert outside.count() == 10


def _method_sizes(spark, df):
    """Bytes of the largest method generated for each pipeline of a plan."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a plan that is still open shows no code
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = df.select("*")._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def test_rules_of_a_row_are_methods_the_jit_compiles(spark):
    texts = [*q_editions._ASKED_CODES, "surv_id", "sex", "resp_mode", "resp_fwdisp", "fw_period", "surv_semester"]
    dates = ["resp_date", "invitation", "reminder_1", "reminder_2"]
    numbers = ["row_id", "pseudo_id", "bth_year", "nhh_nchld", "nhh_nadlt", "nhh_nsnr", "surv_year"]
    merged = spark.range(3).select(*[F.when(F.col("id") > 0, F.concat(F.lit("yes"), F.col("id"))).alias(c) for c in texts],
                                   *[F.current_date().alias(c) for c in dates], *[F.col("id").cast("int").alias(c) for c in numbers])
    merged = stage_table(merged)
    df = analyse_responses(clean_responses(compiled_apart(merged), q_editions.CONFIG), q_editions.QUESTIONS, q_editions.CONFIG)
    sizes = _method_sizes(spark, df)
    assert len(sizes) > 1 and max(sizes) <= COMPILED_METHOD
    assert df.count() == 3


def test_limit_of_methods_is_put_back(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), compiled_methods(spark):
        assert spark.conf.get(name) == str(COMPILED_METHOD)
        raise RuntimeError
    assert spark.conf.get(name) == before
