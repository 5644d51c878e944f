"""Month replacement by switched folders, footer counts, stored ids, mart states, stream quarantine."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from blotter.operators import quality
from blotter.plans import catalog
from blotter.plans.build import build_all
from blotter.session import scratch_path
from blotter.sources.fixtures import api_records
from blotter.sources.landing import write_landing
from blotter.sources.raw import raw_select, read_raw
from blotter.sources.versions import drop_old_versions, register_table, replace_months_safely, switch_months, write_version
from blotter.streaming import start_month_replace
from tests.conftest import SMOKE_DIR


def _batch(spark, rows):
    records = spark.createDataFrame(rows, "id long, month string, context string").withColumn("ingest_year_month", F.col("month"))
    return raw_select(records, "crime_data")


def _held(spark, table):
    return sorted((r["id"], r["context"]) for r in spark.table(table).select("id", "context").collect())


def test_a_job_killed_before_the_switch_leaves_the_old_month(spark):
    root = scratch_path(spark, "raw")
    table = f"blotter_raw.t{root.rsplit('-', 1)[1]}"
    register_table(spark, "crime_data", table, f"{root}/crime_data")
    assert replace_months_safely(_batch(spark, [(1, "2025-01", "old"), (2, "2025-02", "old")]), table, root) == ["2025-01", "2025-02"]
    # the write of a new month is done, and the job ends there
    pending = write_version(_batch(spark, [(1, "2025-01", "new"), (3, "2025-01", "new")]), root)
    assert set(pending) == {"2025-01"} and _held(spark, table) == [(1, "old"), (2, "old")]
    # the next run replaces the month; switching twice changes nothing more
    batch = _batch(spark, [(1, "2025-01", "again")])
    folders = write_version(batch, root)
    switch_months(spark, table, folders)
    switch_months(spark, table, folders)
    assert _held(spark, table) == [(1, "again"), (2, "old")]
    assert replace_months_safely(batch.limit(0), table, root) == []
    assert _held(spark, table) == [(1, "again"), (2, "old")]
    # what nothing points to goes: the first January and the one that was never switched to
    assert drop_old_versions(spark, table, root) == 2
    assert drop_old_versions(spark, table, root) == 0
    spark.catalog.refreshTable(table)
    assert _held(spark, table) == [(1, "again"), (2, "old")]


def test_a_write_that_fails_changes_nothing(spark):
    root = scratch_path(spark, "raw")
    table = f"blotter_raw.t{root.rsplit('-', 1)[1]}"
    register_table(spark, "crime_data", table, f"{root}/crime_data")
    replace_months_safely(_batch(spark, [(1, "2025-01", "old")]), table, root)
    broken = _batch(spark, [(1, "2025-01", "new")]).withColumn("context", F.expr("raise_error('lost')"))
    with pytest.raises(Exception, match="lost"):
        replace_months_safely(broken, table, root)
    assert _held(spark, table) == [(1, "old")]


def test_replace_queries_do_not_copy_the_table(spark):
    before = set(catalog.raw(spark, SMOKE_DIR, "crime_data").inputFiles())
    replaced = E.queries()["month_replace"](spark, SMOKE_DIR)
    files = set(replaced.inputFiles())
    assert len(files & before) > 50 and 1 <= len(files - before) <= 8
    assert all("ingest_year_month=1998-01" in f for f in files - before)
    assert set(catalog.raw(spark, SMOKE_DIR, "crime_data").inputFiles()) == before


def test_batch_counts_come_from_footers(spark):
    plan = E.queries()["loaded_batches"](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*), COUNT(loaded_at)]") == 3
    plan = E.queries()["batch_coverage"](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [") >= 3 and "PushedAggregation: []" not in plan.split("orders.parquet")[0]


def test_repeated_ids_are_found_without_moving_rows(spark):
    df = E.queries()["dq_unique"](spark, SMOKE_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "hashpartitioning(crime_id" not in plan and "from_json" not in plan


def test_month_selection_is_pruned_by_the_catalog(spark):
    df = catalog.raw(spark, SMOKE_DIR, "crime_data").where("ingest_year_month = '1996-03'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_year_month" in plan and 1 <= len(df.inputFiles()) <= 8


def _marts(spark, built):
    out = {}
    for name, path in built["mart"].items():
        df = spark.read.parquet(path)
        out[name] = sorted(map(str, (tuple(r) for r in df.select(sorted(c for c in df.columns if c != "ingest_year_month")).collect())))
    return out


def test_one_month_run_counts_one_month_and_equals_a_full_build(spark, tmp_path):
    months = ["1996-03", "1996-04", "1996-05"]
    landing, out = str(tmp_path / "landing"), tmp_path / "out"
    stops = ["2024-02", "2024-03"]
    for name, chosen in (("crime_data", months), ("stop_and_search_data", stops), ("outcome_data", months)):
        records = api_records(spark, SMOKE_DIR, name)
        write_landing(records.where(F.col("ingest_year_month").isin(chosen)), landing, name)
    build_all(spark, landing_root=landing, out_root=str(out))
    kept = {str(p.relative_to(out)): p.stat().st_mtime_ns for p in out.glob("state/*/*/part-*") if "1996-04" not in str(p) and "2024-02" not in str(p)}
    # all crimes of a month lose their outcome, and half of a month's stops go
    changed = api_records(spark, SMOKE_DIR, "crime_data").where("ingest_year_month = '1996-04'")
    write_landing(changed.withColumn("outcome_status", F.expr("CASE WHEN false THEN outcome_status END")), landing, "crime_data")
    fewer = api_records(spark, SMOKE_DIR, "stop_and_search_data").where("ingest_year_month = '2024-02' AND gender = 'Male'")
    write_landing(fewer, landing, "stop_and_search_data")
    one = build_all(spark, landing_root=landing, out_root=str(out), months=["1996-04", "2024-02"])
    full = build_all(spark, landing_root=landing, out_root=str(tmp_path / "full"))
    assert _marts(spark, one) == _marts(spark, full)
    assert "1996-04" not in {r["crime_month"] for r in spark.read.parquet(one["mart"]["mart_outcome_timings"]).collect()}
    assert len(kept) >= 3 and all((out / p).stat().st_mtime_ns == t for p, t in kept.items())


def test_conformance_counts_what_the_typed_parse_lost(spark):
    rows = [
        (1, '{"latitude": "53.1", "street": {"id": 5, "name": "a"}}', None),
        (2, '{"latitude": "53.1", "street": {"id": "five", "name": "a"}}', '{"category": null}'),
        (3, '{"street": {"id": 1.5}}', '{"category": "x", "date": 7}'),
        (4, '{"latitude": ', "not json"),
        (5, "", "  "),
        (6, "null", '{"category": {"code": 1}}'),
        (7, '{"street": {"id": null}}', None),
    ]
    raw = raw_select(spark.createDataFrame([(i, a, b, "2025-01") for i, a, b in rows], "id long, location string, outcome_status string, ingest_year_month string"), "crime_data")
    found = {(r["check_name"], r["column_name"]): r["failures"] for r in quality.conformance_checks(raw, "int_crimes").collect()}
    assert {k: v for k, v in found.items() if v} == {("conforms", "crime_street_id"): 2, ("json", "location"): 1, ("json", "outcome_status"): 1}
    from blotter.schemas import INT_CRIMES_TYPES

    assert {c for k, c in found if k == "conforms"} == set(INT_CRIMES_TYPES)


def test_report_has_a_row_per_documented_column(spark):
    from blotter.schemas import MODEL_FIELDS, MODEL_TYPES

    report = E.queries()["dq_report"](spark, SMOKE_DIR).where("check_name = 'conforms'").collect()
    assert {(r["model"], r["column_name"]) for r in report} == {(m, c) for m in MODEL_FIELDS for c in MODEL_TYPES[m]}


def test_stream_quarantines_broken_lines(spark, tmp_path):
    folder = tmp_path / "crime_data" / "date=2025-01"
    folder.mkdir(parents=True)
    (folder / "1.json").write_text('{"id": 1, "month": "2025-01", "category": "a"}\n{"id": 2, "month": \n')
    table, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    start_month_replace(spark, str(tmp_path), "crime_data", table, ckpt).awaitTermination(300)
    assert [r["id"] for r in read_raw(spark, table, "crime_data").collect()] == [1]
    broken = spark.read.parquet(f"{table}_quarantine").collect()
    assert [(r["ingest_year_month"], r["_corrupt_record"]) for r in broken] == [("2025-01", '{"id": 2, "month": ')]


def test_stream_finds_outcomes_under_either_folder_name(spark, tmp_path):
    table, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    for key, month in (("date", "2025-01"), ("ingest_year_month", "2025-02")):
        folder = tmp_path / "outcome_data" / f"{key}={month}"
        folder.mkdir(parents=True)
        (folder / "1.json").write_text('{"category": {"code": "c"}, "date": "%s-09", "person_id": null}\n' % month)
        start_month_replace(spark, str(tmp_path), "outcome_data", table, ckpt).awaitTermination(300)
    got = {(r["ingest_year_month"], r["date"]) for r in read_raw(spark, table, "outcome_data").collect()}
    assert got == {("2025-01", "2025-01-09"), ("2025-02", "2025-02-09")}


def test_build_reads_arrays_over_several_lines(spark, tmp_path):
    folder = tmp_path / "crime_data" / "date=2025-01"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('[\n {"id": 1,\n  "month": "2025-01"},\n {"id": 2, "month": "2025-01"}\n]\n')
    built = build_all(spark, landing_root=str(tmp_path), out_root=str(tmp_path / "out"), multiline=True)
    assert {r["crime_id"] for r in spark.read.parquet(built["mart"]["mart_crime_map"]).collect()} == {1, 2}


def test_views_answer_in_a_second_session(spark):
    from blotter.plans.published import publish_views, view
    from blotter.session import configure

    tables = {ds: catalog.raw_table(spark, SMOKE_DIR, ds) for ds in ("crime_data", "outcome_data", "stop_and_search_data")}
    names = publish_views(spark, tables, "blotter_test_views")
    later = configure(spark.newSession())
    assert len(names) == 10
    for name in names:
        want = E.queries()[name](spark, SMOKE_DIR)
        got = view(later, "blotter_test_views", name)
        assert got.dtypes == want.dtypes, name
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


def test_a_box_is_pushed_and_prunes_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    from blotter.plans.views import PLACE_LAT, PLACE_LON, placed_map, read_mart

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = E.queries()["bbox_filter"](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(place_lat," in plan and "LessThanOrEqual(place_lon," in plan and "rlike" not in plan.lower()
    rows = spark.range(40_000).selectExpr(
        "id AS crime_id", "'2025-01' AS crime_month", "'a' AS crime_category",
        "CAST(53 + pmod(hash(id), 1000) / 1000D AS STRING) AS crime_latitude", "CAST(-2 + pmod(hash(id, 1), 1000) / 1000D AS STRING) AS crime_longitude",
        "repeat('x', 20) AS crime_street_name", "CAST(null AS STRING) AS latest_outcome_category", "'2025-01' AS month_key",
    )
    path = str(tmp_path / "map")
    placed_map(rows.coalesce(1)).write.option("parquet.block.size", "65536").option("parquet.block.row.count.limit", "1000").partitionBy("month_key").parquet(path)
    box = (53.5, -1.5, 0.05, 0.05)
    inside = total = 0
    for file in tmp_path.glob("map/*/part-*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = {meta.schema.column(k).name: k for k in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            y, x = (meta.row_group(g).column(at[c]).statistics for c in (PLACE_LAT, PLACE_LON))
            total += 1
            inside += y.min <= 53.55 and y.max >= 53.45 and x.min <= -1.45 and x.max >= -1.55
    assert total >= 20 and inside <= total / 4
    got = read_mart(spark, path, "mart_crime_map", box=box)
    want = rows.where("CAST(crime_latitude AS DOUBLE) BETWEEN 53.45 AND 53.55 AND CAST(crime_longitude AS DOUBLE) BETWEEN -1.55 AND -1.45")
    assert got.count() == want.count() > 100
