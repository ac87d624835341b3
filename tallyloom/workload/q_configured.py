"""The default configuration of an edition, on a questionnaire that has all its questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derive, validation
from ..operators import metadata as m
from ..operators.batteries import clean_batteries, clean_filters
from ..plans import config as c
from . import sqltext as t
from .inputs import oracle
from .registry import query

_FREQ = ["sptfreq", "icarefreq", "netfreq"]
_SINGLE = ["sr_chron", "sr_illim", "memboard", "icarerel", "wb_work", "wb_schhm", "nethome"]
_TICKED = [q for b in c.BATTERIES for q in (*b.options, b.dk, *([b.none] if b.none else []))]

# every question of the configuration, answered from the seven choices and seven frequencies of a response;
# a battery question counts as ticked or left empty
_ALL = "SELECT row_id, " + ", ".join([
    *[f"CASE WHEN q{i % 7 + 1} IN ('yes', 'no') THEN q{i % 7 + 1} END AS {q}" if i % 3 else
      f"CASE WHEN f{i % 7 + 1} IN ('daily', 'weekly') THEN 'yes' END AS {q}" for i, q in enumerate(_TICKED)],
    *[f"q{i + 1} AS {q}" for i, q in enumerate(_SINGLE)],
    *[f"f{i + 1} AS {q}" for i, q in enumerate(_FREQ)],
    "CASE f4 WHEN 'daily' THEN 'employed' WHEN 'weekly' THEN 'student' END AS sr_empl", "'text ' || f5 AS spt_othx",
]) + " FROM answers"

_CLEAN: dict[str, str] = {}
for _b in c.BATTERIES:
    _CLEAN.update(t.battery(list(_b.options), _b.dk, _b.none))
_BATTERIES = f"SELECT * REPLACE ({', '.join(f'{e} AS {q}' for q, e in _CLEAN.items())}) FROM ({_ALL}) raw_answers"


def _filter_sql() -> str:
    """One nested projection per filter, as later filters see the results of earlier ones."""
    text = f"({_BATTERIES}) b"
    for i, f in enumerate(c.FILTERS):
        condition = " OR ".join(f"{n} = '{a}'" for n in f.needs for a in f.answers)
        condition = f"NOT ({condition})" if f.negate else condition
        text = f"(SELECT * REPLACE ({', '.join(f'{t.filtered(q, condition, f.na_value)} AS {q}' for q in f.columns)}) FROM {text}) f{i}"
    return f"SELECT * FROM {text}"


_COUNTED = ", ".join(
    " + ".join("CASE " + q + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in codes.items() if k is not None and v is not None) + " END" for q in columns)
    + f" AS {name}" for name, (columns, codes) in c.COUNTS.items())


@query("configured_batteries", oracle(_BATTERIES))
def batteries(x):
    return clean_batteries(x.sql(_ALL), c.BATTERIES)


@query("configured_filters", oracle(_filter_sql()))
def filters(x):
    return clean_filters(clean_batteries(x.sql(_ALL), c.BATTERIES), c.FILTERS)


@query("configured_counts", oracle(f"SELECT row_id, {_COUNTED} FROM ({_filter_sql()}) z"))
def counts(x):
    df = clean_filters(clean_batteries(x.sql(_ALL), c.BATTERIES), c.FILTERS)
    for name, (columns, codes) in c.COUNTS.items():
        df = derive.count_yes(df, columns, name, codes)
    return df.select("row_id", *c.COUNTS)


@query("rename_to_concepts", oracle("SELECT row_id, q1 AS concept_1, q2 AS concept_2, q3 AS concept_3 FROM answers"))
def renamed(x):
    variables = x.sql("""SELECT DISTINCT CONCAT('q', CAST(l_linenumber AS VARCHAR(4))) AS variable,
        CONCAT('concept_', CAST(l_linenumber AS VARCHAR(4))) AS concept_id FROM lineitem""")
    return validation.rename_to_concepts(x.view("answers").select("row_id", "q1", "q2", "q3"), variables)


@query("extend_dsd", oracle("""
SELECT concept_id, constraint_type FROM dsd WHERE label_nl LIKE 'small%' UNION ALL SELECT concept_id, constraint_type FROM dsd WHERE concept_id = 'c1'"""))
def extended(x):
    dsd = x.view("dsd").select("concept_id", "label_nl", "constraint_type")
    return validation.extend_dsd(dsd.where(F.col("label_nl").startswith("small")), dsd, ["c1"], self_made=["c1", "c2"]).select(
        "concept_id", "constraint_type")


@query("load_dsd", oracle("SELECT concept_id, constraint_type, constraint_min FROM dsd WHERE concept_id IN (SELECT CONCAT('c', CAST(o_custkey AS VARCHAR)) FROM orders WHERE o_custkey % 10 <> 9)"))
def loaded(x):
    """Only requested concepts; every one of them exists."""
    wanted = x.sql("SELECT CONCAT('c', CAST(o_custkey AS VARCHAR(20))) AS concept_id FROM orders WHERE o_custkey % 10 <> 9")
    return m.load_dsd(x.view("dsd"), wanted).select("concept_id", "constraint_type", "constraint_min")
