"""The whole build, its checks, the streaming month replace, and plan shapes."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from blotter.plans import catalog
from blotter.plans.build import build_all
from blotter.session import scratch_path
from blotter.sources.fixtures import api_records
from blotter.sources.landing import write_landing
from blotter.sources.raw import read_raw
from blotter.streaming import start_month_replace
from tests.conftest import SMOKE_DIR


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def built(spark):
    return build_all(spark, sf_dir=SMOKE_DIR)


def test_build_marts_equal_lazy_queries(spark, built):
    qs = E.queries()
    for model in ["mart_crime_map", "mart_outcome_timings", "mart_outcome_mix", "mart_reason_trends"]:
        written = spark.read.parquet(built["mart"][model])
        lazy = qs[model](spark, SMOKE_DIR)
        assert _rows(written.select(*lazy.columns)) == _rows(lazy), model


def test_build_report(duck, built):
    rep = {(r["model"], r["check_name"], r["column_name"]): r["failures"] for r in built["report"].collect()}
    no_location = duck.execute("SELECT count(*) FROM orders WHERE o_orderkey % 50 = 0").fetchone()[0]
    assert rep[("mart_crime_map", "not_null", "crime_latitude")] == no_location > 0
    assert rep[("mart_crime_map", "unique", "crime_id")] == 0
    assert rep[("int_crimes", "type", "crime_month")] == 0
    assert sum(v for (m, c, _), v in rep.items() if m == "mart_outcome_timings") == 0


def test_row_counts_conserved_between_layers(spark, built):
    for name, model in [("crime_data", "int_crimes"), ("outcome_data", "int_outcomes"), ("stop_and_search_data", "int_stop_search")]:
        raw_n = read_raw(spark, built["raw"][name], name).count()
        assert raw_n == spark.read.parquet(built["int"][model]).count() == api_records(spark, SMOKE_DIR, name).count()


def test_build_from_landing_equals_build_from_tables(spark, built):
    root = scratch_path(spark, "landing")
    for name in ["crime_data", "outcome_data", "stop_and_search_data"]:
        write_landing(api_records(spark, SMOKE_DIR, name), root, name)
    from_landing = build_all(spark, landing_root=root)
    for model, path in built["mart"].items():
        assert _rows(spark.read.parquet(path)) == _rows(spark.read.parquet(from_landing["mart"][model])), model
    rep = {(r["model"], r["check_name"]): r["failures"] for r in from_landing["report"].collect()}
    assert rep[("crime_data", "corrupt_record")] == 0 and rep[("stop_and_search_data", "not_null")] == 0


def test_outcome_landing_keeps_record_date(spark):
    root = scratch_path(spark, "landing")
    recs = api_records(spark, SMOKE_DIR, "outcome_data")
    write_landing(recs, root, "outcome_data")
    with pytest.raises(ValueError):
        write_landing(recs, root, "outcome_data", key="date")


def test_stream_replaces_months_incrementally(spark):
    root = scratch_path(spark, "landing")
    table = scratch_path(spark, "raw") + "/crime_data"
    ckpt = scratch_path(spark, "stream")
    recs = api_records(spark, SMOKE_DIR, "crime_data")
    write_landing(recs, root, "crime_data")
    start_month_replace(spark, root, "crime_data", table, ckpt).awaitTermination(300)
    first = read_raw(spark, table, "crime_data")
    assert first.count() == recs.count()
    # the landing month is re-written with changed rows: only that month changes
    month = "1996-03"
    changed = recs.where(F.col("ingest_year_month") == month).withColumn("context", F.lit("late outcome"))
    write_landing(changed, root, "crime_data")
    start_month_replace(spark, root, "crime_data", table, ckpt).awaitTermination(300)
    after = read_raw(spark, table, "crime_data")
    assert after.count() == recs.count()
    ctx = {r["ingest_year_month"]: r["c"] for r in after.groupBy("ingest_year_month").agg(F.max("context").alias("c")).collect()}
    assert ctx[month] == "late outcome" and all(v == "" for m, v in ctx.items() if m != month)


# --- plan shapes ----------------------------------------------------------------------------

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"]


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_has_no_cartesian_or_python(spark, name):
    plan = E.queries()[name](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    for pat in FORBIDDEN:
        assert pat not in plan, (name, pat)


def test_month_filter_reaches_parquet_scan(spark, built):
    from blotter.functions.months import month_filter
    from blotter.operators import serving

    timings = spark.read.parquet(built["mart"]["mart_outcome_timings"])
    plan = serving.outcome_summary(timings, "1996-03")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(crime_month,1996-03\)", plan)
    cm = month_filter(spark.read.parquet(built["mart"]["mart_crime_map"]), "crime_month", "1996-03")
    plan = serving.map_summary(serving.map_points(cm))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(crime_month,1996-03)" in plan
    # column pruning: the summary reads 5 of the map's 7 columns
    read = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert "latest_outcome_category" not in read


def test_top_k_and_semi_join_shapes(spark):
    q = E.queries()
    plan = q["top_objects"](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    plan = q["outcome_mix_top_objects"](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_raw_month_filter_prunes_partitions(spark, built):
    raw = read_raw(spark, built["raw"]["crime_data"], "crime_data").where(F.col("ingest_year_month") == "1996-03")
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*ingest_year_month", plan)


def test_views_sources_and_mart_scans(spark, built):
    from blotter.plans.views import publish, read_mart, source

    path = built["mart"]["mart_outcome_timings"]
    publish(spark, {"mart_outcome_timings": spark.read.parquet(path)})
    n = spark.sql("SELECT count(*) AS n FROM mart_outcome_timings").collect()[0]["n"]
    assert n == source(spark, "mart_outcome_timings").count() > 0
    one = read_mart(spark, path, "mart_outcome_timings", "1996-03")
    assert {r["crime_month"] for r in one.collect()} == {"1996-03"}
    assert "EqualTo(crime_month,1996-03)" in one._jdf.queryExecution().executedPlan().toString()
    mix = read_mart(spark, built["mart"]["mart_outcome_mix"], "mart_outcome_mix", "1996-03")
    assert mix.count() == spark.read.parquet(built["mart"]["mart_outcome_mix"]).count()


def test_report_has_schema_contract(built):
    rows = [r for r in built["report"].collect() if r["check_name"] == "schema"]
    assert len([r for r in rows if r["model"] == "int_crimes"]) == 13
    assert all(r["failures"] == 0 for r in rows)


def test_monthly_runs_accumulate_months(spark):
    root = scratch_path(spark, "landing")
    out = scratch_path(spark, "build")
    recs = api_records(spark, SMOKE_DIR, "crime_data")
    write_landing(recs, root, "crime_data")
    first = build_all(spark, landing_root=root, out_root=out, months=["1996-03"])
    second = build_all(spark, landing_root=root, out_root=out, months=["1996-04", "1900-01"])
    raw = read_raw(spark, second["raw"]["crime_data"], "crime_data")
    got = {r["ingest_year_month"]: r["n"] for r in raw.groupBy("ingest_year_month").count().withColumnRenamed("count", "n").collect()}
    want = {r["ingest_year_month"]: r["n"] for r in recs.where("ingest_year_month IN ('1996-03', '1996-04')").groupBy("ingest_year_month").count().withColumnRenamed("count", "n").collect()}
    assert got == want
    months = {r["crime_month"] for r in spark.read.parquet(second["mart"]["mart_outcome_timings"]).collect()}
    assert months == {"1996-03", "1996-04"}
    assert first["raw"] == second["raw"]
    # the flattened layer keeps the first run's month and adds the second's
    rep = {(r["model"], r["check_name"]): r["failures"] for r in second["report"].collect()}
    assert rep[("crime_data", "missing_batch")] == 0
    assert rep[("outcome_data", "missing_batch")] == rep[("stop_and_search_data", "missing_batch")] == 2
    flat = spark.read.parquet(second["int"]["int_crimes"])
    assert {r["ingest_year_month"] for r in flat.select("ingest_year_month").distinct().collect()} == {"1996-03", "1996-04"}
    assert flat.count() == raw.count()


def test_published_build_answers_sql(spark, built):
    from blotter.plans.views import publish_build

    names = publish_build(spark, built)
    assert {"crime_data", "int_crimes", "mart_outcome_timings"} <= set(names)
    by_sql = spark.sql(
        "SELECT crime_category, sum(crime_count) AS n FROM mart_outcome_timings GROUP BY crime_category"
    ).collect()
    direct = E.queries()["outcome_summary"](spark, SMOKE_DIR).collect()
    assert {r["crime_category"]: r["n"] for r in by_sql} == {r["crime_category"]: r["total_crimes"] for r in direct}


def test_monthly_run_from_tables(spark):
    out = scratch_path(spark, "build")
    res = build_all(spark, sf_dir=SMOKE_DIR, out_root=out, months=["1996-03"])
    months = {r["ingest_year_month"] for r in read_raw(spark, res["raw"]["crime_data"], "crime_data").collect()}
    assert months == {"1996-03"}


def test_command_line_build(spark):
    from blotter.__main__ import main

    out = scratch_path(spark, "build")
    args = ["build", "--tables", SMOKE_DIR, "--out-root", out, "--months", "1996-03"]
    assert main(args) == 0
    # missing coordinates are reported as not-null failures, so a strict run fails
    assert main(args + ["--strict"]) == 1


SERVING_MONTH = ["month_filter", "map_summary_month", "outcome_summary_month", "reason_trend_month"]
SERVING = SERVING_MONTH + [
    "outcome_summary", "outcome_trend", "map_points", "map_summary", "map_extent", "kpis", "kpis_month",
    "month_options", "top_objects", "outcome_mix_top_objects", "outcome_heatmap", "reason_trend_sorted", "geo_grid",
    "bbox_filter",
]


@pytest.mark.parametrize("name", SERVING)
def test_serving_reads_marts_and_prunes_months(spark, name):
    df = E.queries()[name](spark, SMOKE_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "get_json" not in plan
    assert df.inputFiles() and all("/mart/" in f for f in df.inputFiles())
    if name in SERVING_MONTH:
        assert re.search(r"PartitionFilters: \[[^\]]*month_key", plan)


def test_changed_folder_table_is_loaded_again(spark, tmp_path):
    orders = spark.read.parquet(f"{SMOKE_DIR}/orders.parquet")
    orders.limit(20).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    query = E.queries()["stg_crimes"]
    assert query(spark, str(tmp_path)).count() == 20
    orders.limit(7).coalesce(1).write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    assert query(spark, str(tmp_path)).count() == 27


def test_stream_keeps_earlier_files_of_a_month(spark, tmp_path):
    folder = tmp_path / "crime_data" / "date=2025-01"
    folder.mkdir(parents=True)
    table, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    for k in (1, 2):
        (folder / f"{k}.json").write_text('{"id": %d, "month": "2025-01", "category": "a"}\n' % k)
        start_month_replace(spark, str(tmp_path), "crime_data", table, ckpt).awaitTermination(300)
    assert sorted(r["id"] for r in read_raw(spark, table, "crime_data").collect()) == [1, 2]


def test_build_reports_bad_values_and_quarantines_broken_lines(spark, tmp_path):
    crimes, stops = tmp_path / "crime_data" / "date=2025-01", tmp_path / "stop_and_search_data" / "date=2025-01"
    crimes.mkdir(parents=True)
    stops.mkdir(parents=True)
    status = '"outcome_status": {"category": "x", "date": "2025-02"}'
    (crimes / "a.json").write_text(
        '{"id": 1, "month": "2025-01", "category": "a", %s}\n' % status
        + '{"id": 2, "month": "not-a-month", "category": "a", %s}\n' % status
        + '{"id": 3, "month": \n'
    )
    (stops / "a.json").write_text('{"datetime": "not a time", "object_of_search": "x"}\n')
    built = build_all(spark, landing_root=str(tmp_path), out_root=str(tmp_path / "out"))
    report = {(r["model"], r["check_name"], r["column_name"]): r["failures"] for r in built["report"].collect()}
    assert report[("int_crimes", "type", "crime_month")] == 1
    assert report[("stop_and_search_data", "type", "datetime")] == 1
    assert {n: v for (m, c, n), v in report.items() if m == "crime_data" and c == "corrupt_record"}.popitem()[1] == 1
    assert {r["crime_id"] for r in spark.read.parquet(built["mart"]["mart_crime_map"]).collect()} == {1, 2}
    assert spark.read.parquet(str(tmp_path / "out" / "quarantine" / "crime_data")).count() == 1
    from blotter.plans.views import publish_build

    assert "outcome_data" in publish_build(spark, built)  # a dataset without any batch


def test_one_month_run_leaves_other_map_files(spark, tmp_path):
    out = tmp_path / "out"
    build_all(spark, sf_dir=SMOKE_DIR, out_root=str(out), months=["1996-03", "1996-04"])
    kept = {p.name: p.stat().st_mtime_ns for p in out.glob("mart/mart_crime_map/*=1996-03/part-*")}
    build_all(spark, sf_dir=SMOKE_DIR, out_root=str(out), months=["1996-04"])
    assert kept and kept == {p.name: p.stat().st_mtime_ns for p in out.glob("mart/mart_crime_map/*=1996-03/part-*")}


def test_documented_types_are_those_of_the_stored_files(spark, tmp_path):
    from blotter.operators.quality import schema_checks
    from blotter.plans.build import _as_stored
    from blotter.schemas import OUTCOME_MIX_TYPES

    planned = spark.createDataFrame([], "object_of_search string, outcome string, stop_search_count bigint")
    path = str(tmp_path / "mix")
    spark.sql("SELECT 'a' AS object_of_search, 1 AS outcome, 2L AS stop_search_count").write.parquet(path)
    report = schema_checks(_as_stored(spark, path, planned), "mart_outcome_mix", OUTCOME_MIX_TYPES)
    wrong = {r["column_name"]: r["failures"] for r in report.collect()}
    # the number is no text, the share is missing
    assert wrong == {"object_of_search": 0, "outcome": 1, "stop_search_count": 0, "pct_within_object_of_search": 1}
    assert _as_stored(spark, str(tmp_path / "none"), planned).columns == planned.columns


def test_build_report_holds_every_documented_model(spark):
    from blotter.plans import catalog
    from blotter.schemas import MODEL_TYPES

    report = catalog.run(spark, "build_report", SMOKE_DIR).where("check_name = 'schema'")
    assert {(r["model"], r["column_name"]) for r in report.collect()} == {
        (m, c) for m, types in MODEL_TYPES.items() for c in types
    }
