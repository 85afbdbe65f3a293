"""The correctness gate: every registered query equals its DuckDB oracle on
the sf0.01 tables (column names sorted, doubles rounded, rows as a multiset)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from sluice.plans import load_all  # noqa: E402
from conftest import SF01  # noqa: E402
from oracle_check import _rows, connect  # noqa: E402

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF01)


def test_every_query_has_an_oracle():
    missing = sorted(set(load_all()) - set(SQL))
    assert missing == []


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF01)
    a, ac = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(SQL[name])
    b, bc = _rows([d[0] for d in res.description], res.fetchall())
    assert ac == bc
    assert len(a) == len(b)
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_end", "vc", "cnt", "rank"]
