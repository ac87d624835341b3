"""Derived variables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bands import SCHEMES, age_band
from ..operators import derive as d
from ..operators import identifiers
from . import sqltext as t
from .inputs import oracle
from .registry import query

ID_NAMES = {"resp_id": "", "resp_id_suf": "SUF-", "resp_id_puf": "PUF-"}


@query("pseudonymous_ids", "SELECT c_nationkey, " + t.select(t.ids("customer", ["c_custkey"], "SV0001", "secret", ID_NAMES)) + " FROM customer")
def pseudonyms(x):
    return identifiers.pseudonymous_ids(x.table("customer").select("c_custkey", "c_nationkey"), ["c_custkey"], "SV0001", "secret",
                                        drop=["c_custkey"])


@query("geo_rollup", oracle("""
SELECT c_custkey, CD_REFNIS AS refnis2019lvl4, target_value AS refnis2019lvl2 FROM register LEFT JOIN areas ON value = CD_REFNIS"""))
def provinces(x):
    df = x.view("register").select("c_custkey", F.col("CD_REFNIS").alias("refnis2019lvl4"))
    for detail, target in d.municipality_columns(df.columns):
        df = d.geo_rollup(df, x.view("areas"), detail, target)
    return df


@query("nationality_group", oracle("""
SELECT c_custkey, CD_NATLTY AS natlty, target_value AS natltygrp FROM register LEFT JOIN nationalities ON value = CD_NATLTY"""))
def nationality(x):
    return d.nationality_group(x.view("register").select("c_custkey", F.col("CD_NATLTY").alias("natlty")), x.view("nationalities"))


@query("age_bands", oracle(f"""
SELECT pseudo_id, 2020 - bth_year AS age, {t.AGE7.format('(2020 - bth_year)')} AS agecat7, {t.AGE4.format('(2020 - bth_year)')} AS agecat4 FROM sample"""))
def ages(x):
    return d.age_bands(x.view("sample").select("pseudo_id", "bth_year", F.lit(2020).alias("surv_year"))).select(
        "pseudo_id", "age", "agecat7", "agecat4")


def _scheme_sql(column: str, name: str) -> str:
    breaks, labels = SCHEMES[name]
    steps = " ".join(f"WHEN {column} < {hi} THEN '{lb}'" for hi, lb in zip(breaks[1:], labels))
    return f"CASE WHEN {column} < {breaks[0]} THEN NULL {steps} WHEN {column} >= {breaks[-1]} THEN '{labels[-1]}' END AS {name}"


_OTHER = [s for s in SCHEMES if s not in ("agecat7from18", "agecat4from18")]


@query("age_bands_other", "SELECT o_orderkey, " + ", ".join(_scheme_sql("(o_custkey % 130 - 8)", s) for s in _OTHER) + " FROM orders")
def other_ages(x):
    age = F.col("o_custkey") % 130 - 8
    return x.table("orders").select("o_orderkey", *[age_band(age, s).alias(s) for s in _OTHER])


_EDUC = """SELECT l_orderkey, l_linenumber, CASE CAST(l_quantity AS INT) % 9 WHEN 0 THEN 'nodip' WHEN 1 THEN 'primary' WHEN 2 THEN 'lowrsec'
  WHEN 3 THEN 'uprsec' WHEN 4 THEN 'nonuniv' WHEN 5 THEN 'univ' WHEN 6 THEN 'otherdipl' WHEN 7 THEN 'invalid' END AS sr_educ FROM lineitem"""
# education in three levels, from the levels that occur in the data
_LEVELS = """SELECT DISTINCT CASE CAST(l_quantity AS INT) % 3 WHEN 0 THEN 'loweduc' WHEN 1 THEN 'mededuc' ELSE 'hieduc' END AS value,
  CASE CAST(l_quantity AS INT) % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'mid' ELSE 'high' END AS target_value FROM lineitem"""


@query("education_level", f"""
SELECT l_orderkey, l_linenumber, sr_educ, e AS sr_edlv4, CASE e WHEN 'loweduc' THEN 'low' WHEN 'mededuc' THEN 'mid' WHEN 'hieduc' THEN 'high' END AS sr_edlv3
FROM (SELECT *, CASE WHEN sr_educ IN ('nodip', 'primary', 'lowrsec') THEN 'loweduc' WHEN sr_educ = 'uprsec' THEN 'mededuc'
  WHEN sr_educ IN ('nonuniv', 'univ') THEN 'hieduc' WHEN sr_educ = 'otherdipl' THEN 'othereduc' END AS e FROM ({_EDUC}) s) z""")
def education(x):
    return d.education_level(x.sql(_EDUC), x.sql(_LEVELS))


@query("employment_collapse", """
SELECT c_custkey, e AS sr_empl, CASE WHEN e IN ('jobseek', 'student', 'homemkr', 'disabil') THEN 'otherempl' ELSE e END AS sr_emplb
FROM (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'employed' WHEN 1 THEN 'jobseek' WHEN 2 THEN 'student' WHEN 3 THEN 'homemkr'
  WHEN 4 THEN 'disabil' WHEN 5 THEN 'retired' END AS e FROM customer) s""")
def employed(x):
    df = x.sql("""SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'employed' WHEN 1 THEN 'jobseek' WHEN 2 THEN 'student' WHEN 3 THEN 'homemkr'
  WHEN 4 THEN 'disabil' WHEN 5 THEN 'retired' END AS sr_empl FROM customer""")
    return d.employment(df)


_HH = "SELECT row_id, q1 AS hh_alone, q2 AS hh_partn, q3 AS hh_child, q4 AS hh_par, q5 AS hh_sib FROM answers"


@query("household_position", oracle(f"""
SELECT row_id, hhpos, CASE hhpos WHEN 'wparnt' THEN 'otherhhpos' ELSE hhpos END AS hhposb FROM (
  SELECT row_id, CASE WHEN hh_alone = 'yes' THEN 'alone' WHEN hh_partn = 'yes' AND hh_child = 'no' THEN 'partnr'
    WHEN hh_partn = 'yes' AND hh_child = 'yes' THEN 'partkid' WHEN hh_partn = 'no' AND hh_child = 'yes' THEN 'sinparn'
    WHEN hh_partn = 'no' AND hh_par = 'yes' THEN 'wparnt'
    WHEN hh_partn = 'yes' OR hh_child = 'yes' OR hh_par = 'yes' OR hh_sib = 'yes' OR hh_alone = 'yes' THEN 'otherhhpos' END AS hhpos FROM ({_HH}) h) p"""))
def positions(x):
    return d.household_position(x.sql(_HH)).select("row_id", "hhpos", "hhposb")


_YES = ["q1", "q2", "q3"]
_VALID = "SELECT row_id, " + ", ".join(f"CASE WHEN {q} = 'invalid' THEN 'na' ELSE {q} END AS {q}" for q in _YES) + " FROM answers"


@query("count_yes", oracle("SELECT row_id, " + " + ".join(
    f"CASE {q} WHEN 'yes' THEN 1 WHEN 'no' THEN 0 WHEN 'na' THEN 0 END" for q in _YES) + f" AS total FROM ({_VALID}) v"))
def yes_count(x):
    return d.count_yes(x.sql(_VALID), _YES, "total", d.YES_NO_NA).select("row_id", "total")


_ACT = [f"c{i}" for i in range(11)]


def _culture_sum(values: dict[str, int]) -> str:
    return "(" + " + ".join("CASE " + a + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END" for a in _ACT) + ")"


_W = _culture_sum({"daily": 1, "weekly": 1, "monthly": 0, "yearly": 0, "never": 0})
_M = _culture_sum({"daily": 1, "weekly": 1, "monthly": 1, "yearly": 0, "never": 0})
_P = _culture_sum({"daily": 1, "weekly": 1, "monthly": 1, "yearly": 1, "never": 0})
_A = _culture_sum({"daily": 1, "weekly": 1, "monthly": 1, "yearly": 1, "never": 1, "dkn": 0})


@query("culture_participation", oracle(f"""
WITH s AS (SELECT id, {_W} AS w, {_M} AS m, {_P} AS p, {_A} AS a FROM culture),
f AS (SELECT id, CASE WHEN p >= 1 THEN 'yes' WHEN a = 11 THEN 'no' WHEN a < 11 THEN 'dkn' END AS cultpart,
  CASE WHEN w >= 1 THEN 'yes' WHEN m >= 2 THEN 'yes' WHEN a = 11 THEN 'no' WHEN a < 11 THEN 'dkn' END AS cultcore FROM s)
SELECT id, cultpart, cultcore,
  CASE WHEN cultpart = 'yes' AND cultcore = 'yes' THEN 'no' WHEN cultpart = 'yes' AND cultcore = 'no' THEN 'yes'
    WHEN cultpart = 'yes' AND cultcore = 'dkn' THEN 'dkn' WHEN cultpart = 'no' AND cultcore = 'no' THEN 'no'
    WHEN cultpart = 'dkn' AND cultcore = 'dkn' THEN 'dkn' END AS cultintp,
  CASE cultpart WHEN 'yes' THEN 'no' WHEN 'no' THEN 'yes' WHEN 'dkn' THEN 'dkn' END AS cultnonp FROM f"""))
def culture(x):
    return d.culture_participation(x.view("culture"), _ACT).select("id", "cultpart", "cultcore", "cultintp", "cultnonp")
