"""Every registered query against its SQL on DuckDB, and the registry itself."""

from __future__ import annotations

import contextlib
import io

import pytest

import __spark_entry__ as entry_points
from compare import connect, difference
from conftest import SMALL
from roadpulse.plans.queries import registry

# optional queries have their tests in a folder of their own
QUERIES = {name: query for name, query in entry_points.queries().items() if name in registry()}
ORACLE = {name: sql for name, sql in entry_points.oracle_sql().items() if name in registry()}
# no plan has a cross join or calls Python per row
AVOIDED = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
)


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 15


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    result = QUERIES[name](spark, SMALL)
    assert difference(result, con, ORACLE[name]) is None
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        result.explain()
    for operator in AVOIDED:
        assert operator not in text.getvalue()
