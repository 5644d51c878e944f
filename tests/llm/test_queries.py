"""Registered queries against their SQL twins, exactly, on the smallest generated tables."""

from __future__ import annotations

import pytest

from blotter.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMOKE_DIR


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_twin(spark, duck, name):
    got = QUERIES[name](spark, SMOKE_DIR)
    columns = sorted(got.columns)
    found = duck.execute(ORACLE_SQL[name])
    order = [d[0] for d in found.description]
    assert sorted(order) == columns
    where = [order.index(c) for c in columns]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    want = sorted((tuple(r[k] for k in where) for r in found.fetchall()), key=key)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=key) == want


def test_native_queries_run_no_python(spark):
    for name in ("op1_mix_sources", "op6_chat_format", "op12_personal_data"):
        plan = QUERIES[name](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas")), name


def test_all_operators_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
