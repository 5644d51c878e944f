"""Property tests: month arithmetic and the weighted re-aggregation against direct computation."""

from __future__ import annotations

import datetime as dt
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from blotter.functions.months import month_spine, months_to_outcome
from blotter.operators import marts, serving

SETTINGS = settings(
    max_examples=20, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

dates = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31))
months = st.tuples(st.integers(1990, 2030), st.integers(1, 12)).map(lambda t: f"{t[0]:04d}-{t[1]:02d}")


@SETTINGS
@given(start=dates, asof=dates)
def test_month_spine_matches_month_start_range(spark, start, asof):
    bounds = spark.createDataFrame([(start, asof)], "start date, asof date")
    got = [r["ingest_year_month"] for r in month_spine(bounds).collect()]
    # months counted from year 0; a start within a month begins with the next one
    first = start.year * 12 + start.month - 1 + (start.day > 1)
    want = [f"{k // 12:04d}-{k % 12 + 1:02d}" for k in range(first, asof.year * 12 + asof.month - 1)]
    assert got == want


@SETTINGS
@given(pairs=st.lists(st.tuples(months, months), min_size=1, max_size=30))
def test_months_to_outcome_is_month_difference(spark, pairs):
    df = spark.createDataFrame(pairs, "crime_month string, outcome_month string")
    got = [r["m"] for r in df.select(months_to_outcome("outcome_month", "crime_month").alias("m")).collect()]
    want = [(int(o[:4]) - int(c[:4])) * 12 + int(o[5:]) - int(c[5:]) for c, o in pairs]
    assert got == want


rows = st.lists(
    st.tuples(st.sampled_from(["2025-01", "2025-02", "2025-03"]), st.sampled_from(["a", "b"]), st.integers(0, 30)),
    min_size=1,
    max_size=60,
)


def _add_months(month: str, k: int) -> str:
    y, m = int(month[:4]), int(month[5:]) - 1 + k
    return f"{y + m // 12:04d}-{m % 12 + 1:02d}"


@SETTINGS
@given(data=rows)
def test_weighted_mean_equals_direct_mean(spark, data):
    ic = spark.createDataFrame(
        [(month, cat, _add_months(month, k)) for month, cat, k in data],
        "crime_month string, crime_category string, latest_outcome_date string",
    )
    summary = {r["crime_category"]: r for r in serving.outcome_summary(marts.outcome_timings(ic)).collect()}
    for cat in {c for _, c, _ in data}:
        ks = [k for _, c, k in data if c == cat]
        assert summary[cat]["total_crimes"] == len(ks)
        assert abs(summary[cat]["avg_months_to_outcome"] - float(Fraction(sum(ks), len(ks)))) < 1e-9
        assert (summary[cat]["min_months_to_outcome"], summary[cat]["max_months_to_outcome"]) == (min(ks), max(ks))
    trend = serving.outcome_trend(marts.outcome_timings(ic)).collect()
    assert sum(r["crime_count"] for r in trend) == len(data)
