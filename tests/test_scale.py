"""Skew and partitioning behaviour: a hot key holding over a third of the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from blotter.operators import marts, quality, serving
from tests.conftest import SMOKE_DIR


def _hot_stops(spark, n=3000):
    """Stops where one object of search and one month hold 40 % of the rows."""
    return spark.range(n).selectExpr(
        "CASE WHEN id % 5 < 2 THEN 'hot' ELSE concat('obj-', CAST(id % 7 AS STRING)) END AS object_of_search",
        "CASE id % 3 WHEN 0 THEN 'Arrest' WHEN 1 THEN '' ELSE NULL END AS outcome",
        "CAST(CASE WHEN id % 5 < 2 THEN '2025-01-15 10:00:00' ELSE '2025-02-15 10:00:00' END AS TIMESTAMP)"
        " AS stop_search_datetime",
    )


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_object_results_and_partial_aggregation(spark):
    stops = _hot_stops(spark)
    mix = marts.outcome_mix(stops)
    rows = mix.where("object_of_search = 'hot'").collect()
    assert sum(r["stop_search_count"] for r in rows) == 1200
    assert abs(sum(r["pct_within_object_of_search"] for r in rows) - 1.0) < 1e-12
    plan = _plan(mix)
    # the first shuffle carries partial counts, not rows
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
    top = serving.top_objects(mix, 3).collect()
    assert top[0]["object_of_search"] == "hot" and top[0]["total_searches"] == 1200


def test_hot_month_timings_use_a_histogram(spark):
    ic = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'x' ELSE 'y' END AS crime_category",
        "CASE WHEN id % 5 < 2 THEN '2025-01' ELSE '2025-02' END AS crime_month",
        "CASE WHEN id % 5 < 2 THEN '2025-03' ELSE '2025-04' END AS latest_outcome_date",
    )
    t = marts.outcome_timings(ic)
    got = {(r["crime_month"], r["crime_category"]): (r["crime_count"], r["median_months_to_outcome"]) for r in t.collect()}
    assert got[("2025-01", "x")] == (400, 2) and got[("2025-02", "y")] == (1200, 2)
    plan = _plan(t)
    # a histogram by partial hash aggregates, no sketch objects
    assert "partial_count" in plan and "percentile" not in plan and "ObjectHashAggregate" not in plan


def test_duplicate_check_combines_map_side(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS crime_id")
    dup = quality.duplicate_values(df, "crime_id").collect()
    assert [(r["value"], r["occurrences"]) for r in dup] == [(-1, 1000)]
    assert "partial_count" in _plan(quality.duplicate_values(df, "crime_id"))


def test_load_deals_and_sorts_rows_before_they_are_widened(spark):
    from collections import Counter

    from blotter.schemas import DATASETS, LOADED_AT
    from blotter.sources.fixtures import api_records
    from blotter.sources.raw import raw_select

    for name in DATASETS:
        batch, plain = (raw_select(api_records(spark, SMOKE_DIR, name, by_month=m), name) for m in (True, False))
        plan = batch._jdf.queryExecution().executedPlan().toString()
        widened, dealt = plan.split("Exchange", 1)
        assert "StructsToJson" in widened and "StructsToJson" not in dealt
        # one sort, by the table's columns: no sort, and so no spill, holds the JSON text
        assert "Exchange" not in dealt and plan.count("Sort [") == 1 and "StructsToJson" not in widened.split("Sort [")[1]
        rows = lambda df: Counter(tuple(r) for r in df.drop(LOADED_AT).collect())
        assert rows(batch) == rows(plain)


def test_library_has_no_driver_collects_or_python_udfs():
    """Operators stay on executors: no collect/toPandas, no Python UDFs, no localCheckpoint.
    The optional training-data operators have rules of their own."""
    import pathlib
    import re

    root = pathlib.Path(__file__).resolve().parents[1] / "blotter"
    banned = re.compile(r"\.collect\(|toPandas|pandas_udf|\budf\(|mapInPandas|applyInPandas|localCheckpoint")
    offenders = []
    for path in root.rglob("*.py"):
        if "llm" in path.parts:
            continue
        for n, line in enumerate(path.read_text().splitlines(), 1):
            if banned.search(line) or ".rdd" in line:
                offenders.append(f"{path.name}:{n}: {line.strip()}")
    assert offenders == []
