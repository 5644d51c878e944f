"""Every catalogue query equals its SQL twin (DuckDB) on the smallest generated tables."""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as E
from blotter.plans import catalog
from tests.conftest import SMOKE_DIR

QUERIES = {n: q for n, q in E.queries().items() if n in catalog.QUERIES}
ORACLES = {n: q for n, q in E.oracle_sql().items() if n in catalog.QUERIES}


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, float):
        return (1, repr(v))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    return (1, str(v))


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMOKE_DIR)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _canon(df.columns, rows) == _canon(dcols, drows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == [
        "crime_month",
        "crime_category",
        "crime_count",
        "avg_months_to_outcome",
        "median_months_to_outcome",
        "min_months_to_outcome",
        "max_months_to_outcome",
    ]
    assert df.count() > 0
