"""Every registered volume query with SQL against DuckDB on the smallest tables; the others run and give stable columns."""

import math

import pytest

from lamella.plans.registry import QUERIES, SQL
from lamella.plans import catalogue  # noqa: F401


def rows(names, values):
    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, data, duck, name):
    got = QUERIES[name](spark, data)
    want = duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).columns
