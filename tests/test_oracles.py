"""Every registered query with a SQL twin gives the same rows in DuckDB; the others give rows."""

import ast
import pathlib

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from oracle_check import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()
ROOT = pathlib.Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SMALL), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(SQL) <= set(QUERIES)


# Where results may come to the driver: small summaries only.
COLLECTS = {
    "encode.py": 1, "neighbors.py": 3, "resample.py": 2, "glm.py": 3, "poisson_tree.py": 1, "search.py": 1, "encoding.py": 0,
}


def test_rows_stay_on_the_cluster():
    for path in (ROOT / "ratewell").rglob("*.py"):
        tree = ast.parse(path.read_text())
        calls = [n.func.attr for n in ast.walk(tree) if isinstance(n, ast.Call) and isinstance(n.func, ast.Attribute)]
        assert not {"localCheckpoint", "crossJoin", "toLocalIterator"} & set(calls), path
        bulk = sum(c in ("collect", "toPandas") for c in calls)
        assert bulk <= COLLECTS.get(path.name, 0) + 1, (path, bulk)
