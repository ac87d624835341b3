"""Population margins and raked weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bands import age_band
from ..operators import margins as m
from ..operators import raking
from . import sqltext as t
from .inputs import oracle
from .registry import query

COVARIATES = ["sex", "agecat7", "natltygrp", "province"]
SWEEPS, CAPPED_SWEEPS = 14, 40  # enough for weights to settle to the digits shown

_PERSONS = f"""SELECT CASE CD_SEX WHEN 1 THEN 'male' WHEN 2 THEN 'female' END AS sex, {t.AGE7.format('MS_AGE')} AS agecat7,
  nt.target_value AS natltygrp, a.target_value AS province
FROM register JOIN areas a ON a.value = CD_REFNIS LEFT JOIN nationalities nt ON nt.value = CD_NATLTY WHERE MS_AGE >= 18"""
_STACK = "\nUNION ALL ".join(f"SELECT '{c}' AS covariate, {c} AS category FROM persons" for c in COVARIATES)
_MARGINS = f"""SELECT covariate, category, COUNT(*) AS n, COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY covariate) AS DOUBLE) AS p
FROM ({_STACK}) l WHERE category IS NOT NULL GROUP BY covariate, category"""


def _persons(x):
    return m.register_covariates(x.view("register"), x.view("areas"), x.view("nationalities"))


def _margins(x):
    return m.population_margins(_persons(x), COVARIATES)


@query("population_filter", oracle(f"SELECT sex, agecat7, natltygrp, province, COUNT(*) AS n FROM ({_PERSONS}) p GROUP BY ALL"))
def persons(x):
    return _persons(x).groupBy(*COVARIATES).agg(F.count("*").alias("n"))


@query("population_margins", oracle(f"WITH persons AS ({_PERSONS})\nSELECT covariate, category, n, ROUND(p, 6) AS p FROM ({_MARGINS}) m"))
def margins(x):
    return _margins(x).withColumn("p", F.round("p", 6))


@query("normalise_margins", oracle(f"""
WITH persons AS ({_PERSONS}), m AS ({_MARGINS})
SELECT covariate, category, ROUND(p / SUM(p) OVER (PARTITION BY covariate), 6) AS p FROM m WHERE covariate <> 'province' AND category <> 'a75plus'"""))
def normalised(x):
    return m.normalise_margins(_margins(x).where("category <> 'a75plus'"), COVARIATES[:3]).withColumn("p", F.round("p", 6))


# respondents: everybody in the sample with an order of high priority
_FRAME = f"""SELECT pseudo_id, CASE WHEN n > 0 THEN 'resp' ELSE 'nonresp' END AS resp_stat, sex, {t.AGE7.format('(2024 - bth_year)')} AS agecat7, natltygrp, geo_lvl2 AS province
FROM sample LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM') GROUP BY o_custkey) o ON o_custkey = pseudo_id"""
_COMPLETE = f"""SELECT pseudo_id, sex, agecat7, natltygrp, province FROM ({_FRAME}) f WHERE resp_stat = 'resp' AND sex IS NOT NULL
  AND agecat7 IS NOT NULL AND natltygrp IS NOT NULL AND province IS NOT NULL"""


def _people(x):
    answered = x.table("orders").where(F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM")).select(
        F.col("o_custkey").alias("pseudo_id")).distinct().withColumn("resp_stat", F.lit("resp"))
    people = x.view("sample").join(answered, "pseudo_id", "left")
    return people.select("pseudo_id", F.coalesce("resp_stat", F.lit("nonresp")).alias("resp_stat"), "sex",
                         age_band(F.lit(2024) - F.col("bth_year"), "agecat7from18").alias("agecat7"), "natltygrp",
                         F.col("geo_lvl2").alias("province"))


def _frame(x):
    return m.raking_frame(_people(x), COVARIATES, "pseudo_id")


@query("raking_frame", oracle(_COMPLETE))
def frame(x):
    return _frame(x)


_RAKE = "WITH persons AS ({p}), targets AS ({m}), frame AS ({f}),\n{r}\n"


def _raked(cap: float, sweeps: int, body: str) -> str:
    return oracle(_RAKE.format(p=_PERSONS, m=_MARGINS, f=_COMPLETE, r=t.rake("frame", "pseudo_id", "targets", COVARIATES, cap, sweeps)) + body)


_WEIGHTS = "SELECT pseudo_id, ROUND(psweight, 4) AS psweight FROM raked"


@query("rake_weights", _raked(5.0, SWEEPS, _WEIGHTS))
def weights(x):
    return _settled(x, 5.0).withColumn("psweight", F.round("psweight", 4))


def _settled(x, cap):
    return raking.rake_weights(_frame(x), m.normalise_margins(_margins(x)), COVARIATES, "pseudo_id", cap=cap, tol=1e-7)


@query("rake_weights_capped", _raked(4.0, CAPPED_SWEEPS, _WEIGHTS))
def capped(x):
    """A cap low enough to bind."""
    return _settled(x, 4.0).withColumn("psweight", F.round("psweight", 4))


@query("attach_weights", _raked(5.0, SWEEPS, f"""SELECT f.pseudo_id, f.resp_stat, ROUND(psweight, 4) AS psweight
FROM ({_FRAME}) f LEFT JOIN raked ON raked.pseudo_id = f.pseudo_id"""))
def attached(x):
    return raking.attach_weights(_people(x), _settled(x, 5.0), "pseudo_id").select(
        "pseudo_id", "resp_stat", F.round("psweight", 4).alias("psweight"))


@query("weighted_margins", oracle(f"WITH persons AS ({_PERSONS})\nSELECT covariate, category, ROUND(p, 5) AS p FROM ({_MARGINS}) m"))
def check(x):
    """Weighted sample margins: they must be the population margins."""
    rows = _frame(x)
    w = raking.rake_weights(rows, m.normalise_margins(_margins(x)), COVARIATES, "pseudo_id", tol=1e-9)
    return raking.weighted_margins(raking.attach_weights(rows, w, "pseudo_id"), COVARIATES).withColumn("p", F.round("p", 5))
