"""One edition from sample and raw responses to weighted microdata."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators.derive import YES_NO
from ..operators.margins import population_margins, register_covariates
from ..operators.responses import Question
from ..plans.config import EditionConfig
from ..plans.edition import EditionInputs, EditionMetadata, process_edition, run_edition
from ..session import compiled_methods, stage_table
from . import sqltext as t
from .inputs import oracle
from .registry import query

SWEEPS = 12  # enough for weights to settle to the digits shown
PROVINCE = "refnis2019lvl2"
COVARIATES = ("sex", "agecat7", "natltygrp", PROVINCE)
ASKED = ["sr_sex", "sr_byear", "sr_bmnth", "hh_partn", "hh_child", "hh_par", "sptfreq", "spt_walk", "mem_sport", "mem_hobby"]
QUESTIONS = [Question(q, round((i + 1) / len(ASKED), 3), ASKED[i + 1] if i + 1 < len(ASKED) else None) for i, q in enumerate(ASKED)]
CONFIG = EditionConfig("SV0001", "secret", counts={"memtot": (("mem_sport", "mem_hobby"), YES_NO)}, covariates=COVARIATES[:3], tol=1e-7)

_SAMPLE = """SELECT c_custkey AS pseudo_id, CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex, CAST(1920 + c_custkey % 100 AS INT) AS bth_year,
  c_nationkey AS refnis2019lvl4, CAST(c_custkey % 25 AS INT) AS natlty FROM customer"""
_SURVEY = """SELECT r.row_id, r.pseudo_id, resp_mode, resp_date, resp_fwdisp, COALESCE(q1, f2) AS sr_sex, COALESCE(q2, f3) AS sr_byear, COALESCE(q3, f4, f5) AS sr_bmnth,
  q4 AS hh_partn, q5 AS hh_child, q6 AS hh_par, q7 AS hh_dk, CASE WHEN f1 = 'never' THEN 'yes' END AS hh_alone,
  t5 % 3 AS nhh_nchld, t6 % 2 AS nhh_nadlt, t7 % 4 AS nhh_nsnr, f1 AS sptfreq, CASE WHEN f2 IN ('daily', 'weekly') THEN 'yes' END AS spt_walk,
  CASE WHEN f2 = 'dkn' THEN 'yes' END AS spt_dk, CASE WHEN t1 % 2 = 0 THEN 'yes' END AS mem_sport, CASE WHEN t2 % 3 = 0 THEN 'yes' END AS mem_hobby,
  CASE WHEN t3 % 5 = 0 THEN 'yes' END AS mem_none, CASE WHEN t4 % 7 = 0 THEN 'yes' END AS mem_dk
FROM responses r LEFT JOIN answers a ON r.row_id = a.row_id"""

_PERSONS = f"""SELECT CASE CD_SEX WHEN 1 THEN 'male' WHEN 2 THEN 'female' END AS sex, {t.AGE7.format('MS_AGE')} AS agecat7,
  nt.target_value AS natltygrp, a.target_value AS {PROVINCE}
FROM register JOIN areas a ON a.value = CD_REFNIS LEFT JOIN nationalities nt ON nt.value = CD_NATLTY WHERE MS_AGE >= 18"""
_STACK = "\nUNION ALL ".join(f"SELECT '{c}' AS covariate, {c} AS category FROM persons" for c in COVARIATES)
_TARGETS = f"""SELECT covariate, category, COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY covariate) AS DOUBLE) AS p
FROM ({_STACK}) l WHERE category IS NOT NULL GROUP BY covariate, category"""

_HH = "(hh_partn = 'yes' OR hh_child = 'yes' OR hh_par = 'yes' OR hh_dk = 'yes' OR hh_alone = 'yes')"
_ZERO = lambda c: f"CASE WHEN {_HH} AND {c} IS NULL THEN 0 ELSE {c} END AS {c}"
_replace = lambda exprs: ", ".join(f"{e} AS {c}" for c, e in exprs.items())
_OFTEN = "sptfreq = 'yearly' OR sptfreq = 'monthly' OR sptfreq = 'weekly' OR sptfreq = 'daily'"
_IDS = {"resp_id": ""}

_SQL = f"""
WITH smp AS ({_SAMPLE}), srv AS ({_SURVEY}),
merged AS (SELECT s.*, srv.* EXCLUDE (pseudo_id), DATE '1995-01-01' AS invitation, DATE '1997-01-01' AS reminder_1, DATE '1999-01-01' AS reminder_2
  FROM smp s LEFT JOIN srv ON s.pseudo_id = srv.pseudo_id),
i1 AS (SELECT * REPLACE (CASE WHEN 2024 - bth_year < 18 OR 2024 - bth_year > 120 THEN NULL ELSE bth_year END AS bth_year,
  {_ZERO('nhh_nchld')}, {_ZERO('nhh_nadlt')}, {_ZERO('nhh_nsnr')}) FROM merged),
i2 AS (SELECT * REPLACE (CASE WHEN nhh_nchld > 0 THEN 'yes' ELSE hh_child END AS hh_child,
  CASE WHEN nhh_nchld > 0 OR nhh_nadlt > 0 OR nhh_nsnr > 0 THEN 'no' ELSE hh_alone END AS hh_alone) FROM i1),
b AS (SELECT * REPLACE ({_replace({**t.battery(['hh_partn', 'hh_child', 'hh_par'], 'hh_dk', 'hh_alone'),
                                    **t.battery(['mem_sport', 'mem_hobby'], 'mem_dk', 'mem_none'), **t.battery(['spt_walk'], 'spt_dk')})}) FROM i2),
f AS (SELECT * REPLACE ({t.filtered('spt_walk', _OFTEN)} AS spt_walk) FROM b),
pr AS ({t.profile(ASKED, ['sr_sex', 'sr_byear', 'sr_bmnth'], 'f', ['*'])}),
d AS (SELECT * REPLACE (COALESCE(resp_pct, 0) AS resp_pct), {t.DISPOSITION} AS resp_disp FROM pr),
st AS (SELECT *, {t.STATUS} AS resp_stat, {t.WAVE} AS resp_time FROM d),
one AS (SELECT * FROM (SELECT *, {t.BEST} AS best FROM st) z WHERE best = 1),
numbered AS (SELECT *, {t.select(t.ids('one', ['pseudo_id', 'row_id'], 'SV0001', 'secret', _IDS))} FROM one),
der AS (SELECT n.*, ar.target_value AS {PROVINCE}, nt.target_value AS natltygrp, 2024 - bth_year AS age, {t.AGE7.format('(2024 - bth_year)')} AS agecat7,
  CASE WHEN hh_alone = 'yes' THEN 'alone' WHEN hh_partn = 'yes' AND hh_child = 'no' THEN 'partnr' WHEN hh_partn = 'yes' AND hh_child = 'yes' THEN 'partkid'
    WHEN hh_partn = 'no' AND hh_child = 'yes' THEN 'sinparn' WHEN hh_partn = 'no' AND hh_par = 'yes' THEN 'wparnt'
    WHEN hh_partn = 'yes' OR hh_child = 'yes' OR hh_par = 'yes' OR hh_alone = 'yes' THEN 'otherhhpos' END AS hhpos,
  CASE mem_sport WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END + CASE mem_hobby WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS memtot
  FROM numbered n LEFT JOIN areas ar ON ar.value = refnis2019lvl4 LEFT JOIN nationalities nt ON nt.value = natlty),
persons AS ({_PERSONS}), targets AS ({_TARGETS}),
frame AS (SELECT resp_id, {', '.join(COVARIATES)} FROM der WHERE resp_stat = 'resp' AND {' AND '.join(f'{c} IS NOT NULL' for c in COVARIATES)}),
{t.rake('frame', 'resp_id', 'targets', COVARIATES, 5.0, SWEEPS)}
"""
_OUT = ["resp_id", "resp_disp", "resp_stat", "resp_time", "resp_pct", "resp_drop", "sex", "age", "agecat7", "natltygrp", PROVINCE, "hhpos", "memtot",
        "spt_walk", "hh_alone"]


def edition_inputs(x) -> EditionInputs:
    contacts = x.view("mailings").groupBy("fw_period").pivot("contact", ["invitation", "reminder_1", "reminder_2"]).agg(F.min("mail_date"))
    edition = x.spark.createDataFrame([("SV0001", "P1", 2024, "spring")], "surv_id string, fw_period string, surv_year int, surv_semester string")
    persons = register_covariates(x.view("register"), x.view("areas"), x.view("nationalities"), province=PROVINCE)
    return EditionInputs(sample=x.sql(_SAMPLE), survey=x.sql(_SURVEY), edition=edition, contacts=contacts,
                         targets=population_margins(persons, list(COVARIATES)), countries=x.view("nationalities"),
                         areas={"refnis2019lvl4": x.view("areas")})


@query("edition", oracle(_SQL + f"SELECT {', '.join('der.' + c for c in _OUT)}, ROUND(psweight, 4) AS psweight FROM der LEFT JOIN raked ON raked.resp_id = der.resp_id"))
def edition(x):
    """The whole chain: merge, correct, recode, classify, de-duplicate, derive, weight."""
    out = process_edition(edition_inputs(x), QUESTIONS, CONFIG)
    return out.select(*_OUT, F.round("psweight", 4).alias("psweight"))


# The raw survey as respondents saw it: displayed labels under the names of a questionnaire.
LABELS = {"yes": "Ja", "no": "Neen", "dkn": "Weet niet", "invalid": "Ongeldig", "daily": "Dagelijks", "weekly": "Wekelijks", "monthly": "Maandelijks",
          "yearly": "Jaarlijks", "never": "Nooit"}
_ASKED_CODES = ["sr_sex", "sr_byear", "sr_bmnth", "hh_partn", "hh_child", "hh_par", "hh_dk", "hh_alone", "sptfreq", "spt_walk", "spt_dk", "mem_sport",
                "mem_hobby", "mem_none", "mem_dk"]
VARIABLES = {f"V{i + 1}": c for i, c in enumerate(_ASKED_CODES)}
_LABEL = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in LABELS.items())
_RAW = f"""SELECT row_id, pseudo_id, resp_mode, resp_date, resp_fwdisp, CASE WHEN resp_mode = 'online' THEN 'url' END AS resp_qrurl,
  nhh_nchld, nhh_nadlt, nhh_nsnr, {', '.join(f"CASE {c} {_LABEL} END AS {v}" for v, c in VARIABLES.items())}
FROM ({_SURVEY}) s"""

# (concepts, kind of constraint or code list, may be missing)
_ANSWERED = [(_ASKED_CODES, "answer", True), (["nhh_nchld", "nhh_nadlt", "nhh_nsnr"], "integer", True)]
_SURVEY_DSD = [*_ANSWERED, (["row_id", "pseudo_id"], "integer", False), (["resp_mode"], "mode", False), (["resp_date"], "date", True),
               (["resp_fwdisp"], "character", False), (["resp_qrurl"], "character", True)]
_PUBLISHED_DSD = [*_ANSWERED, (["surv_id", "resp_id", "resp_id_suf", "resp_id_puf", "fw_period", "surv_semester", "resp_disp", "resp_stat"], "character", False),
                  (["resp_time", "resp_drop", "agecat7", "agecat4", "natltygrp", PROVINCE, "hhpos", "hhposb"], "character", True),
                  (["sex"], "sex", True), (["resp_mode"], "mode", True), (["resp_date"], "date", True), (["surv_year", "refnis2019lvl4", "natlty"], "integer", False),
                  (["bth_year", "age", "memtot"], "integer", True), (["resp_pct", "psweight"], "numeric", True)]
CODELISTS = {"answer": [*LABELS, "na"], "mode": ["online", "paper"], "sex": ["male", "female"]}


def _dsd(spark, groups):
    rows = [(c, c, "codelist" if kind in CODELISTS else kind, kind if kind in CODELISTS else None, None, 0.0 if kind == "numeric" else None, None, missing)
            for concepts, kind, missing in groups for c in concepts]
    return spark.createDataFrame(rows, "concept_id string, label_nl string, constraint_type string, constraint_codelist string, constraint_regex string, "
                                       "constraint_min double, constraint_max double, constraint_allow_missings boolean")


def edition_metadata(x) -> EditionMetadata:
    make = x.spark.createDataFrame
    return EditionMetadata(
        _dsd(x.spark, _SURVEY_DSD), _dsd(x.spark, _PUBLISHED_DSD), make([(name, v) for name, values in CODELISTS.items() for v in values], "codelist string, value string"),
        make(list(LABELS.items()), "value string, vallabel string"), make(list(VARIABLES.items()), "variable string, concept_id string"),
        make([("SV0001", x.table("customer").count())], "surv_id string, sample_n long"))


@query("edition_published", oracle(_SQL.replace(t.BEST, t.BEST.removesuffix(")") + ", row_id)") + f"""SELECT 'SV0001' AS surv_id, {', '.join('der.' + c for c in [*_OUT, *_ASKED_CODES] if c not in ('spt_walk', 'hh_alone'))},
  der.spt_walk, der.hh_alone, ROUND(psweight, 4) AS psweight FROM der LEFT JOIN raked ON raked.resp_id = der.resp_id"""))
def edition_published(x):
    """From raw responses with displayed labels to the published partition: checks, codes, chain, checks, write, read back.

    Persons are counted before publishing, so equally good responses of one person leave one.
    """
    with compiled_methods(x.spark):
        raw = stage_table(x.sql(_RAW))  # a raw survey arrives as a table
    out = run_edition(replace(edition_inputs(x), survey=raw), edition_metadata(x), QUESTIONS, replace(CONFIG, break_ties=True), x.folder())
    return out.select("surv_id", *dict.fromkeys([*_OUT, *_ASKED_CODES]), F.round("psweight", 4).alias("psweight"))
