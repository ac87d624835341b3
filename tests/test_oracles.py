"""Every registered query against DuckDB on the same tables, and the plans of all of them."""

import ast
import math
import os
import pathlib
from collections import Counter

import duckdb
import pytest

from tallyloom import workload
from tallyloom.workload import ORACLES, QUERIES, load_all
from tallyloom.workload.inputs import SCHEMAS

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
load_all()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = _table(df.columns, df.collect())
    assert got, "a query without rows shows nothing"
    assert name in ORACLES
    answer = duck.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == _table(columns, answer.fetchall())


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join(spark, plan, name):
    text = plan(QUERIES[name](spark, DATA.replace("0.01", "0.001") if name not in ("edition", "rake_weights", "rake_weights_capped", "attach_weights", "weighted_margins") else DATA))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_texts_of_the_workload_are_named_once():
    """A query reads its texts when it runs, so a later one of the same name would take the place of its own."""
    for path in sorted(pathlib.Path(workload.__file__).parent.glob("*.py")):
        names = [t.id for node in ast.parse(path.read_text()).body if isinstance(node, ast.Assign) for t in node.targets if isinstance(t, ast.Name)]
        assert not [n for n, times in Counter(names).items() if times > 1], path.name
