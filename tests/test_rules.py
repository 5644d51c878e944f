
from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F

from blotter.operators import flatten, marts, quality, serving, staging
from blotter.schemas import CRIMES, STOPS
from blotter.sources.raw import raw_select


def _loc(lat="53.38", lon="-1.47", sid=1, name="On or near X"):
    return json.dumps({"latitude": lat, "street": {"id": sid, "name": name}, "longitude": lon})


def crimes_raw(spark, rows):
    """Raw crime rows (nested values as text) from dicts; missing keys are null."""
    cols = [c for c, _ in CRIMES.columns if c != "loaded_at"]
    data = [tuple(r.get(c) for c in cols) for r in rows]
    schema = ", ".join(f"{c} {'bigint' if c == 'id' else 'string'}" for c in cols)
    return spark.createDataFrame(data, schema)


def crime(i, month="2025-01", outcome_month=None, category="burglary", lat="53.38", lon="-1.47", location=True):
    return {
        "category": category,
        "id": i,
        "month": month,
        "location": _loc(lat, lon) if location else None,
        "outcome_status": json.dumps({"category": "done", "date": outcome_month}) if outcome_month else None,
        "ingest_year_month": month,
    }


def int_crimes_of(spark, rows, strict=True):
    return flatten.int_crimes(staging.stg_crimes(crimes_raw(spark, rows), strict=strict))


def test_months_to_outcome_same_month_kept_and_negative_dropped(spark):
    rows = [crime(1, "2025-01", "2025-01"), crime(2, "2025-01", "2024-12")]
    t = marts.outcome_timings(int_crimes_of(spark, rows)).collect()
    assert len(t) == 1
    assert t[0]["crime_count"] == 1 and t[0]["min_months_to_outcome"] == 0


def test_no_outcome_absent_from_timings_present_in_map(spark):
    ic = int_crimes_of(spark, [crime(1, "2025-01", None), crime(2, "2025-01", "2025-03")])
    assert marts.crime_map(ic).count() == 2
    t = marts.outcome_timings(ic).collect()
    assert [r["crime_count"] for r in t] == [1]
    assert t[0]["avg_months_to_outcome"] == 2.0


def test_even_count_median_is_lower_element(spark):
    outs = ["2025-02", "2025-03", "2025-06", "2025-07"]  # 1, 2, 5, 6 months
    ic = int_crimes_of(spark, [crime(i, "2025-01", m) for i, m in enumerate(outs)])
    r = marts.outcome_timings(ic).collect()[0]
    assert r["median_months_to_outcome"] == 2
    assert r["avg_months_to_outcome"] == 3.5
    assert (r["min_months_to_outcome"], r["max_months_to_outcome"]) == (1, 6)


def test_bad_month_strict_raises_tolerant_nulls(spark):
    rows = [crime(1, "2025-13", "2025-01")]
    with pytest.raises(PySparkException):
        marts.outcome_timings(int_crimes_of(spark, rows)).collect()
    tolerant = marts.outcome_timings(int_crimes_of(spark, rows), strict=False)
    assert tolerant.count() == 0


def test_month_parse_rejects_day_precision(spark):
    from blotter.functions.months import month_start_fmt

    df = spark.createDataFrame([("2025-01-05",), ("2025-01",)], "m string")
    got = df.select(month_start_fmt("m", strict=False).alias("d")).collect()
    assert got[0]["d"] is None and str(got[1]["d"]) == "2025-01-01"


def test_malformed_json_gives_nulls_row_kept(spark):
    rows = [crime(1), dict(crime(2), location="{bad")]
    out = {r["crime_id"]: r for r in int_crimes_of(spark, rows).collect()}
    assert len(out) == 2
    assert out[2]["crime_latitude"] is None and out[2]["crime_street_id"] is None
    assert out[1]["crime_latitude"] == "53.38"


def test_wrongly_typed_field_nulls_only_that_field(spark):
    loc = json.dumps({"latitude": "53.1", "longitude": "-1.2", "street": {"id": "abc", "name": "n"}})
    r = int_crimes_of(spark, [dict(crime(1), location=loc)]).collect()[0]
    assert r["crime_street_id"] is None and r["crime_street_name"] == "n" and r["crime_latitude"] == "53.1"


def stops_raw(spark, rows):
    cols = [c for c, _ in STOPS.columns if c != "loaded_at"]
    types = dict(STOPS.columns)
    data = [tuple(r.get(c) for c in cols) for r in rows]
    schema = ", ".join(f"{c} {types[c].simpleString()}" for c in cols)
    return spark.createDataFrame(data, schema)


def test_outcome_labels_null_empty_false(spark):
    rows = [
        {"object_of_search": "drugs", "outcome": None, "datetime": "2025-01-02T10:00:00+00:00"},
        {"object_of_search": "drugs", "outcome": "", "datetime": "2025-01-02T10:00:00+00:00"},
        {"object_of_search": "drugs", "outcome": "false", "datetime": "2025-01-02T10:00:00+00:00"},
        {"object_of_search": None, "outcome": "Arrest", "datetime": "2025-01-02T10:00:00+00:00"},
    ]
    ist = flatten.int_stop_search(staging.stg_stop_search(stops_raw(spark, rows)))
    got = {(r["object_of_search"], r["outcome"]) for r in marts.outcome_mix(ist).collect()}
    assert got == {("drugs", "Unknown"), ("drugs", ""), ("drugs", "false"), ("Unknown", "Arrest")}


def test_stop_month_in_utc(spark):
    rows = [{"object_of_search": "x", "datetime": "2025-01-31T23:30:00+00:00"}]
    ist = flatten.int_stop_search(staging.stg_stop_search(stops_raw(spark, rows)))
    assert marts.reason_trends(ist).collect()[0]["stop_search_month"] == "2025-01"


def test_bad_stop_timestamp_strict_raises(spark):
    rows = [{"object_of_search": "x", "datetime": "not a time"}]
    with pytest.raises(PySparkException):
        staging.stg_stop_search(stops_raw(spark, rows)).collect()
    tolerant = staging.stg_stop_search(stops_raw(spark, rows), strict=False).collect()
    assert tolerant[0]["stop_search_datetime"] is None


def test_non_numeric_latitude_dropped_from_points_kept_in_map(spark):
    ic = int_crimes_of(spark, [crime(1), crime(2, lat="abc")])
    cm = marts.crime_map(ic)
    assert cm.count() == 2
    pts = serving.map_points(cm).collect()
    assert [r["crime_id"] for r in pts] == [1]
    assert pts[0]["tooltip"] == "burglary - On or near X"


def test_duplicate_crime_id_is_one_failing_value(spark):
    ic = int_crimes_of(spark, [crime(1), crime(1), crime(2), crime(None)])
    dup = quality.duplicate_values(marts.crime_map(ic), "crime_id").collect()
    assert [(r["value"], r["occurrences"]) for r in dup] == [(1, 2)]
    rep = {(r["check_name"], r["column_name"]): r["failures"] for r in quality.unique_check(ic, "m", "crime_id").collect()}
    assert rep == {("unique", "crime_id"): 1}


def test_top_k_tie_goes_to_smaller_key(spark):
    mix = spark.createDataFrame(
        [(f"o{i:02d}", "Arrest", 10, 1.0) for i in range(12)],
        "object_of_search string, outcome string, stop_search_count bigint, pct_within_object_of_search double",
    )
    top = [r["object_of_search"] for r in serving.top_objects(mix, 10).collect()]
    assert top == [f"o{i:02d}" for i in range(10)]


def test_null_category_absent_from_summaries(spark):
    ic = int_crimes_of(spark, [crime(1, outcome_month="2025-02"), crime(2, category=None, outcome_month="2025-03")])
    t = marts.outcome_timings(ic)
    assert t.count() == 2  # the mart keeps the null key
    summary = serving.outcome_summary(t).collect()
    assert [r["crime_category"] for r in summary] == ["burglary"]
    pts = serving.map_points(marts.crime_map(ic))
    assert [r["crime_category"] for r in serving.map_summary(pts).collect()] == ["burglary"]


def test_weighted_mean_over_months_equals_direct_mean(spark):
    rows = [crime(i, "2025-01", "2025-02") for i in range(3)] + [crime(10 + i, "2025-02", "2025-06") for i in range(5)]
    ic = int_crimes_of(spark, rows)
    s = serving.outcome_summary(marts.outcome_timings(ic)).collect()[0]
    assert s["total_crimes"] == 8
    assert s["avg_months_to_outcome"] == pytest.approx((3 * 1 + 5 * 4) / 8)
    assert s["median_months_to_outcome"] == pytest.approx((1 + 4) / 2)  # mean of monthly medians


def test_kpis_zero_stops_when_month_has_none(spark):
    ic = int_crimes_of(spark, [crime(1, "2025-01"), crime(2, "2025-02")])
    pts = serving.map_points(marts.crime_map(ic))
    trends = spark.createDataFrame(
        [("2025-01", "x", 3, 1.0)], "stop_search_month string, object_of_search string, stop_search_count bigint, pct_of_month_total double"
    )
    k = serving.kpis(pts, trends, "2025-02").collect()[0]
    assert (k["total_crimes"], k["total_stop_searches"], k["months_available"]) == (1, 0, 2)


def test_heatmap_fills_missing_cells_with_zero(spark):
    mix = spark.createDataFrame(
        [("a", "Arrest", 1, 0.5), ("a", "", 1, 0.5), ("b", "false", 2, 1.0)],
        "object_of_search string, outcome string, stop_search_count bigint, pct_within_object_of_search double",
    )
    h = {r["object_of_search"]: r.asDict() for r in serving.outcome_heatmap(mix, ["Arrest", "", "false"]).collect()}
    assert h["a"] == {"object_of_search": "a", "outcome_arrest": 0.5, "outcome_empty": 0.5, "outcome_false": 0.0}
    assert h["b"]["outcome_false"] == 1.0 and h["b"]["outcome_arrest"] == 0.0


def test_heatmap_without_values_finds_outcomes(spark):
    mix = spark.createDataFrame(
        [("a", "Arrest", 1, 0.5), ("a", "", 1, 0.5), ("b", "false", 2, 1.0)],
        "object_of_search string, outcome string, stop_search_count bigint, pct_within_object_of_search double",
    )
    h = serving.outcome_heatmap(mix)
    assert h.columns == ["object_of_search", "outcome_empty", "outcome_arrest", "outcome_false"]
    assert {r["object_of_search"]: r["outcome_false"] for r in h.collect()} == {"a": 0.0, "b": 1.0}


def test_raw_select_applies_transforms_to_nested_input(spark):
    df = spark.createDataFrame(
        [Row(category="c", id=1, month="2025-01", location=Row(latitude="1", longitude="2", street=Row(id=3, name="s")))]
    )
    r = raw_select(df, "crime_data", month="2025-01").collect()[0]
    assert json.loads(r["location"]) == {"latitude": "1", "longitude": "2", "street": {"id": 3, "name": "s"}}
    assert r["ingest_year_month"] == "2025-01" and r["outcome_status"] is None and r["loaded_at"] is not None


def test_share_sums_to_one_per_partition(spark):
    from tests.conftest import SMOKE_DIR
    import __spark_entry__ as E

    for name, part, pct in [
        ("mart_outcome_mix", "object_of_search", "pct_within_object_of_search"),
        ("mart_reason_trends", "stop_search_month", "pct_of_month_total"),
    ]:
        df = E.queries()[name](spark, SMOKE_DIR)
        sums = df.groupBy(part).agg(F.sum(pct).alias("s")).collect()
        assert sums and all(abs(r["s"] - 1.0) < 1e-9 for r in sums)


def test_month_text_is_first_of_month(spark):
    from blotter.functions.months import month_start

    d = spark.createDataFrame([("2025-03",)], "m string").select(month_start("m").alias("d")).collect()[0]["d"]
    assert str(d) == "2025-03-01"


def test_quoted_number_and_field_case(spark):
    loc = json.dumps({"Latitude": "53.1", "longitude": "-1.2", "street": {"id": "12", "name": "n"}})
    r = int_crimes_of(spark, [dict(crime(1), location=loc)]).collect()[0]
    assert r["crime_street_id"] is None  # "12" is text, not a BIGINT
    assert r["crime_latitude"] is None  # field names are case-sensitive
    assert r["crime_longitude"] == "-1.2"


def test_null_month_stays_null(spark):
    ic = int_crimes_of(spark, [dict(crime(1), month=None), crime(2)])
    pts = {r["crime_id"]: r["crime_month"] for r in serving.map_points(marts.crime_map(ic)).collect()}
    assert pts == {1: None, 2: "2025-01"}
    assert [r["crime_month"] for r in serving.month_options(serving.map_points(marts.crime_map(ic))).collect()] == ["2025-01"]


def test_stop_time_conformance_counts_bad_text(spark):
    rows = [
        {"object_of_search": "x", "datetime": "2025-01-02T10:00:00+00:00"},
        {"object_of_search": "x", "datetime": "not a time"},
        {"object_of_search": "x", "datetime": None},
    ]
    rep = quality.type_checks(stops_raw(spark, rows), "stop_and_search_data", {"datetime": "timestamp"}).collect()
    assert [(r["column_name"], r["failures"]) for r in rep] == [("datetime", 1)]


def test_heatmap_cells_hold_every_outcome(spark):
    mix = spark.createDataFrame(
        [("a", "Arrest", 1, 0.5), ("a", "", 1, 0.5), ("b", "Caution", 2, 1.0)],
        "object_of_search string, outcome string, stop_search_count bigint, pct_within_object_of_search double",
    )
    cells = {(r[0], r[1]): r[2] for r in serving.outcome_heatmap_cells(mix).collect()}
    assert len(cells) == 6 and cells[("b", "Caution")] == 1.0 and cells[("a", "Caution")] == 0.0


def test_coordinates_must_be_finite_numbers(spark):
    from blotter.operators import geo

    texts = ["53.1", "NaN", "Infinity", "-inf", "53.2d", "53.2f", "1e999", " 53.3 ", "5e1", "", None]
    cm = marts.crime_map(int_crimes_of(spark, [crime(k, lat=t) for k, t in enumerate(texts)]))
    points = serving.map_points(cm)
    assert {r["crime_id"]: r["lat"] for r in points.collect()} == {0: 53.1, 7: 53.3, 8: 50.0}
    extent = serving.map_extent(points).collect()[0]
    assert extent["max_lat"] == 53.3 and extent["center_lat"] == pytest.approx((53.1 + 53.3 + 50.0) / 3)
    assert {r["cell_lat"] for r in geo.geo_grid(points).collect()} == {5310, 5330, 5000} or geo.geo_grid(points).count() == 3
    odd = spark.createDataFrame([(float("nan"), 1.0), (float("inf"), 1.0), (2.0, 1.0)], "lat double, lon double")
    assert geo.geo_grid(odd).count() == 1
