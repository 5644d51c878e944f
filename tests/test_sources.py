"""Landing scan and write, raw load and month replace, on hand-made JSON batches."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from blotter.operators import quality
from blotter.schemas import MONTH_COL
from blotter.sources.landing import read_landing, write_landing
from blotter.sources.raw import raw_select, read_raw, replace_months


def _write(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text)


def _crime(i, month="2025-01", **kw):
    rec = {
        "category": "burglary",
        "context": "",
        "id": i,
        "location": {"latitude": "53.1", "street": {"id": 7, "name": "On or near A"}, "longitude": "-1.4"},
        "location_subtype": "",
        "location_type": "Force",
        "month": month,
        "outcome_status": {"category": "Under investigation", "date": month},
        "persistent_id": f"p{i}",
    }
    rec.update(kw)
    return rec


def test_single_line_array_expands_to_rows(spark, tmp_path):
    _write(tmp_path / "crime_data" / "date=2025-01", "a.json", json.dumps([_crime(1), _crime(2)]))
    df = read_landing(spark, str(tmp_path), "crime_data")
    rows = raw_select(df, "crime_data").collect()
    assert sorted(r["id"] for r in rows) == [1, 2]
    assert {r[MONTH_COL] for r in rows} == {"2025-01"}
    assert json.loads(rows[0]["location"])["street"]["name"] == "On or near A"


def test_multiline_array_needs_multiline_option(spark, tmp_path):
    _write(tmp_path / "crime_data" / "date=2025-02", "a.json", json.dumps([_crime(1, "2025-02"), _crime(2, "2025-02")], indent=2))
    df = read_landing(spark, str(tmp_path), "crime_data", multiline=True)
    assert sorted(r["id"] for r in df.select("id").collect()) == [1, 2]


def test_all_null_location_and_missing_column_batch_loads(spark, tmp_path):
    recs = [_crime(1, location=None), _crime(2, location=None)]
    for r in recs:
        del r["context"]  # column absent from every record
    _write(tmp_path / "crime_data" / "date=2025-03", "a.json", json.dumps(recs))
    rows = raw_select(read_landing(spark, str(tmp_path), "crime_data"), "crime_data").collect()
    assert len(rows) == 2
    assert all(r["location"] is None and r["context"] is None for r in rows)


def test_stop_batch_without_operation_and_mixed_outcome(spark, tmp_path):
    recs = [
        {"datetime": "2025-01-03T10:00:00+00:00", "outcome": False, "object_of_search": "x"},
        {"datetime": "2025-01-04T10:00:00+00:00", "outcome": "Arrest", "object_of_search": "x", "involved_person": True},
    ]
    _write(tmp_path / "stop_and_search_data" / "date=2025-01", "a.json", json.dumps(recs))
    rows = raw_select(read_landing(spark, str(tmp_path), "stop_and_search_data"), "stop_and_search_data").collect()
    assert sorted(r["outcome"] for r in rows) == ["Arrest", "false"]
    assert all(r["operation"] is None for r in rows)


def test_corrupt_lines_kept_and_counted(spark, tmp_path):
    text = json.dumps(_crime(1)) + "\n" + '{"id": 2, "category": broken\n' + json.dumps(_crime(3)) + "\n"
    _write(tmp_path / "crime_data" / "date=2025-01", "a.json", text)
    df = read_landing(spark, str(tmp_path), "crime_data")
    rep = {(r["check_name"], r["column_name"]): r["failures"] for r in quality.landing_checks(df, "crime_data", ["id"]).collect()}
    assert rep[("corrupt_record", "_corrupt_record")] == 1
    assert rep[("not_null", "id")] == 1


def test_landing_write_read_roundtrip_by_month(spark, tmp_path):
    recs = spark.createDataFrame([(1, "2025-01"), (2, "2025-02"), (3, "2025-02")], "id bigint, ingest_year_month string")
    recs = recs.withColumn("month", F.col(MONTH_COL)).withColumn("category", F.lit("c"))
    write_landing(recs, str(tmp_path), "crime_data")
    assert (tmp_path / "crime_data" / "date=2025-02").is_dir()
    one = read_landing(spark, str(tmp_path), "crime_data", months=["2025-02"])
    assert sorted(r["id"] for r in one.select("id").collect()) == [2, 3]
    # re-writing one month replaces only that month
    again = spark.createDataFrame([(9, "2025-02", "2025-02", "c")], "id bigint, ingest_year_month string, month string, category string")
    write_landing(again, str(tmp_path), "crime_data")
    all_rows = raw_select(read_landing(spark, str(tmp_path), "crime_data"), "crime_data")
    assert sorted((r["id"], r[MONTH_COL]) for r in all_rows.collect()) == [(1, "2025-01"), (9, "2025-02")]


def _raw_batch(spark, ids, month, context=""):
    df = spark.createDataFrame([(i, month, context) for i in ids], "id bigint, month string, context string")
    return raw_select(df, "crime_data", month=month)


def test_month_replace_is_idempotent_and_local(spark, tmp_path):
    path = str(tmp_path / "raw")
    replace_months(_raw_batch(spark, [1, 2], "2025-01").unionByName(_raw_batch(spark, [3], "2025-02")), path)
    batch = _raw_batch(spark, [4, 5, 6], "2025-01", "new")
    replace_months(batch, path)
    once = sorted((r["id"], r[MONTH_COL], r["context"]) for r in read_raw(spark, path, "crime_data").collect())
    replace_months(batch, path)
    twice = sorted((r["id"], r[MONTH_COL], r["context"]) for r in read_raw(spark, path, "crime_data").collect())
    assert once == twice == [(3, "2025-02", ""), (4, "2025-01", "new"), (5, "2025-01", "new"), (6, "2025-01", "new")]


def test_empty_or_missing_batch_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "raw")
    replace_months(_raw_batch(spark, [1, 2], "2025-01"), path)
    landing = tmp_path / "landing"
    _write(landing / "crime_data" / "date=2025-01", "a.json", "[]")
    empty = read_landing(spark, str(landing), "crime_data", months=["2025-01"])
    assert empty.count() == 0
    replace_months(raw_select(empty, "crime_data"), path)
    missing = read_landing(spark, str(landing), "crime_data", months=["2030-01"])
    replace_months(raw_select(missing, "crime_data"), path)
    assert sorted(r["id"] for r in read_raw(spark, path, "crime_data").collect()) == [1, 2]


def test_raw_table_column_order(spark, tmp_path):
    path = str(tmp_path / "raw")
    replace_months(_raw_batch(spark, [1], "2025-01"), path)
    from blotter.schemas import CRIMES

    assert read_raw(spark, path, "crime_data").columns == [c for c, _ in CRIMES.columns]


def test_create_raw_table_and_load_into_it(spark, tmp_path):
    from blotter.sources.raw import create_raw_table, raw_table_ddl, sync_catalog

    path = str(tmp_path / "crime_data")
    ddl = raw_table_ddl("crime_data", "landing_raw.crime_data", path)
    assert "PARTITIONED BY (ingest_year_month)" in ddl and "`id` BIGINT" in ddl
    create_raw_table(spark, "crime_data", path, "landing_raw.crime_data")
    create_raw_table(spark, "crime_data", path, "landing_raw.crime_data")  # idempotent
    assert spark.table("landing_raw.crime_data").count() == 0
    replace_months(_raw_batch(spark, [1, 2], "2025-01"), path)
    sync_catalog(spark, "landing_raw.crime_data")
    got = spark.table("landing_raw.crime_data").where("ingest_year_month = '2025-01'")
    assert sorted(r["id"] for r in got.collect()) == [1, 2]


def test_raw_select_rejects_malformed_month(spark):
    import pytest

    df = spark.createDataFrame([(1,)], "id bigint")
    with pytest.raises(ValueError):
        raw_select(df, "crime_data", month="2025-1'; drop")


def test_landing_load_plan_has_no_shuffle(spark, tmp_path):
    """A landing scan is month-pure, so the raw load hands the writer a plan without an
    exchange; input that is not clustered by month is rebalanced instead."""
    recs = spark.createDataFrame([(1, "2025-01"), (2, "2025-02")], "id bigint, ingest_year_month string")
    write_landing(recs.withColumn("month", F.col(MONTH_COL)), str(tmp_path), "crime_data")
    batch = raw_select(read_landing(spark, str(tmp_path), "crime_data"), "crime_data")
    plan = batch.sortWithinPartitions(MONTH_COL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    rebalanced = batch.hint("rebalance", MONTH_COL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in rebalanced


def test_date_folders_do_not_replace_the_record_date(spark, tmp_path):
    recs = [{"date": "2024-12", "person_id": "a"}, {"date": "2025-01", "person_id": "b"}]
    _write(tmp_path / "outcome_data" / "date=2025-01", "x.json", json.dumps(recs))
    df = read_landing(spark, str(tmp_path), "outcome_data", key="date")
    got = sorted((r["person_id"], r["date"], r[MONTH_COL]) for r in df.collect())
    assert got == [("a", "2024-12", "2025-01"), ("b", "2025-01", "2025-01")]


def test_date_folders_are_found_for_every_dataset(spark, tmp_path):
    folder = tmp_path / "outcome_data" / "date=2025-01"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps({"date": "2025-01", "person_id": "p"}) + "\n")
    rows = read_landing(spark, str(tmp_path), "outcome_data").collect()
    assert [(r["date"], r["ingest_year_month"]) for r in rows] == [("2025-01", "2025-01")]


def test_unknown_month_folders_are_an_error(spark, tmp_path):
    folder = tmp_path / "outcome_data" / "month=2025-01"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("{}\n")
    with pytest.raises(ValueError, match="no month folders"):
        read_landing(spark, str(tmp_path), "outcome_data")
