"""Query catalogue: one function per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query starts from the generated tables in ``sf_dir``: the API-shaped adapters feed the
monthly load, which stores a raw table (nested values as JSON text) per dataset; staging,
flatten and mart queries run as views over it, over all its rows. Serving queries scan the
marts, stored by month. A stored table belongs to one state of its source's files and is made
when a query first needs it. Queries that exercise writes (landing round trip, month replace) write
to a fresh folder under the session's shared scratch root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.months import month_spine
from blotter.operators import coverage, flatten, geo, marts, quality, serving, staging
from blotter.plans.published import publish_views, view
from blotter.plans.views import publish, read_mart, source, write_mart
from blotter.schemas import DATASETS, LOADED_AT, MONTH_COL
from blotter.session import configure, scratch_path, scratch_root
from blotter.sources.fixtures import api_records, read_table, selected_areas
from blotter.sources.landing import read_landing, write_landing
from blotter.sources.raw import batch_counts, raw_select
from blotter.sources.versions import register_table, replace_months_safely

# Query parameters (not data subsets): the dashboard's month selection used by the
# month-filter queries, and the month reloaded by the month-replace queries.
SELECTED_MONTH = "1998-01"
# the stop-and-search test records span 2024, the crimes 1995-2001
SELECTED_STOP_MONTH = "2024-06"
RELOAD_MONTH = "1998-01"
CLUSTER_ZOOMS = (8, 10, 12, 14, 16)


# --- layer helpers --------------------------------------------------------------------


# the generated table each dataset is adapted from
_TABLE_OF = {"crime_data": "orders", "outcome_data": "lineitem", "stop_and_search_data": "events"}


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _store(spark: SparkSession, sf_dir: str, dataset: str) -> str:
    """Folder of the stored tables of one dataset, named by the files of its source table (path,
    length and time of each), so a source that changed in any file has a folder of its own."""
    p, fs = _path(spark, f"{sf_dir.rstrip('/')}/{_TABLE_OF[dataset]}.parquet")
    files = fs.listFiles(p, True)
    seen = []
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath().toString()} {f.getLen()} {f.getModificationTime()}")
    name = hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:24]
    return f"{scratch_root(spark)}/blotter/store-{dataset}-{name}"


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has been committed."""
    p, fs = _path(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def _table_name(kind: str, path: str) -> str:
    return f"blotter_raw.{kind}_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def raw_table(spark: SparkSession, sf_dir: str, dataset: str) -> str:
    """The monthly load of one dataset as a table of the catalog, loaded once per state of its source.

    The catalog holds the months and their folders, so reading it by name lists no folders again,
    and a month selection is pruned before any file is looked up."""
    root = _store(spark, sf_dir, dataset)
    path = f"{root}/raw/{dataset}"
    name = _table_name(dataset, path)
    if not spark.catalog.tableExists(name):
        if not _complete(spark, path):
            from blotter.plans.build import load_raw

            load_raw(spark, {dataset: api_records(spark, sf_dir, dataset, by_month=True)}, f"{root}/raw", ordered=True)
        register_table(spark, dataset, name, path)
    return name


def raw(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """The rows of ``raw_table``, in declared column order."""
    return source(spark, raw_table(spark, sf_dir, dataset)).select([c for c, _ in DATASETS[dataset].columns])


def raw_path(spark: SparkSession, sf_dir: str, dataset: str) -> str:
    """Folder of ``raw_table``."""
    raw_table(spark, sf_dir, dataset)
    return f"{_store(spark, sf_dir, dataset)}/raw/{dataset}"


def stg(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    r = raw(spark, sf_dir, dataset)
    if dataset == "crime_data":
        return staging.stg_crimes(r)
    if dataset == "outcome_data":
        return staging.stg_outcomes(r)
    return staging.stg_stop_search(r)


def int_crimes(spark, sf_dir):
    return flatten.int_crimes(stg(spark, sf_dir, "crime_data"))


def int_outcomes(spark, sf_dir):
    return flatten.int_outcomes(stg(spark, sf_dir, "outcome_data"))


def int_stops(spark, sf_dir):
    return flatten.int_stop_search(stg(spark, sf_dir, "stop_and_search_data"))


def crime_map(spark, sf_dir):
    return marts.crime_map(int_crimes(spark, sf_dir))


def timings(spark, sf_dir):
    return marts.outcome_timings(int_crimes(spark, sf_dir))


def mix(spark, sf_dir):
    return marts.outcome_mix(int_stops(spark, sf_dir))


def trends(spark, sf_dir):
    return marts.reason_trends(int_stops(spark, sf_dir))


_MARTS = {
    "mart_crime_map": ("crime_data", crime_map),
    "mart_outcome_timings": ("crime_data", timings),
    "mart_outcome_mix": ("stop_and_search_data", mix),
    "mart_reason_trends": ("stop_and_search_data", trends),
}


def mart(spark: SparkSession, sf_dir: str, model: str, month: str | None = None, box=None) -> DataFrame:
    """A stored mart, as the serving operators read it: written once per state of its source,
    in folders by month, and scanned with the dashboard's columns, month and box."""
    dataset, make = _MARTS[model]
    path = f"{_store(spark, sf_dir, dataset)}/mart/{model}"
    if not _complete(spark, path):
        write_mart(make(spark, sf_dir), path, model)
    return read_mart(spark, path, model, month, box)


_IDS = {
    "mart_crime_map": ("crime_data", lambda s, d: int_crimes(s, d)),
    "int_outcomes": ("outcome_data", lambda s, d: int_outcomes(s, d)),
}
# buckets of the stored ids: at scale, files of a few hundred MB each
ID_BUCKETS = 16


def crime_ids(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    """The crime ids of a model, stored in buckets by id, so that a search for repeated ids moves no
    rows: what was stored in earlier months is never dealt out again."""
    dataset, rows = _IDS[model]
    path = f"{_store(spark, sf_dir, dataset)}/ids/{model}"
    name = _table_name(f"ids_{model}", path)
    if not spark.catalog.tableExists(name):
        spark.sql("CREATE SCHEMA IF NOT EXISTS blotter_raw")
        if _complete(spark, path):
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} (crime_id BIGINT) USING parquet "
                f"CLUSTERED BY (crime_id) INTO {ID_BUCKETS} BUCKETS LOCATION '{path}'"
            )
        else:
            # one file per bucket
            ids = rows(spark, sf_dir).select("crime_id").repartition(ID_BUCKETS, "crime_id")
            ids.write.bucketBy(ID_BUCKETS, "crime_id").option("path", path).saveAsTable(name)
    return source(spark, name)


def served_map(spark, sf_dir, month=None):
    return mart(spark, sf_dir, "mart_crime_map", month)


def served_timings(spark, sf_dir, month=None):
    return mart(spark, sf_dir, "mart_outcome_timings", month)


def served_mix(spark, sf_dir):
    return mart(spark, sf_dir, "mart_outcome_mix")


def served_trends(spark, sf_dir, month=None):
    return mart(spark, sf_dir, "mart_reason_trends", month)


def points(spark, sf_dir, month=None):
    return serving.map_points(served_map(spark, sf_dir, month), month)


def _no_load_time(df: DataFrame) -> DataFrame:
    return df.drop(LOADED_AT)


def _crime_bounds(spark, sf_dir) -> DataFrame:
    """Spine bounds from the data: first crime date to the latest order date."""
    return read_table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("asof")
    )


# --- queries --------------------------------------------------------------------------


def q_stg_crimes(spark, sf_dir):
    return stg(spark, sf_dir, "crime_data")


def q_stg_outcomes(spark, sf_dir):
    return stg(spark, sf_dir, "outcome_data")


def q_stg_stop_search(spark, sf_dir):
    return stg(spark, sf_dir, "stop_and_search_data")


def q_map_summary(spark, sf_dir):
    return serving.map_summary(points(spark, sf_dir))


def q_kpis(spark, sf_dir):
    return serving.kpis(points(spark, sf_dir), served_trends(spark, sf_dir))


def q_kpis_month(spark, sf_dir):
    return serving.kpis(points(spark, sf_dir), served_trends(spark, sf_dir), SELECTED_MONTH)


def q_outcome_heatmap(spark, sf_dir):
    return serving.outcome_heatmap_cells(served_mix(spark, sf_dir))


def q_month_filter(spark, sf_dir):
    return served_timings(spark, sf_dir, SELECTED_MONTH)


def q_map_summary_month(spark, sf_dir):
    return serving.map_summary(points(spark, sf_dir, SELECTED_MONTH))


def q_outcome_summary_month(spark, sf_dir):
    return serving.outcome_summary(served_timings(spark, sf_dir, SELECTED_MONTH), SELECTED_MONTH)


def q_reason_trend_month(spark, sf_dir):
    return serving.reason_trend_sorted(served_trends(spark, sf_dir, SELECTED_STOP_MONTH), SELECTED_STOP_MONTH)


def q_geo_grid(spark, sf_dir):
    return geo.geo_grid(points(spark, sf_dir))


def q_bbox_filter(spark, sf_dir):
    return mart(spark, sf_dir, "mart_crime_map", box=(geo.AREA_LAT, geo.AREA_LNG, geo.AREA_LAT_RANGE, geo.AREA_LNG_RANGE))


def q_month_spine(spark, sf_dir):
    return month_spine(_crime_bounds(spark, sf_dir))


def q_batch_coverage(spark, sf_dir):
    loaded = q_loaded_batches(spark, sf_dir).select("dataset", MONTH_COL)
    return coverage.missing_batches(q_month_spine(loaded.sparkSession, sf_dir), loaded)


def q_json_roundtrip_scan(spark, sf_dir):
    """API records -> landing JSON (one folder per month) -> scan -> load -> flatten."""
    root = scratch_path(spark, "landing")
    write_landing(api_records(spark, sf_dir, "crime_data"), root, "crime_data")
    landed = read_landing(spark, root, "crime_data")
    return flatten.int_crimes(staging.stg_crimes(raw_select(landed, "crime_data")))


def q_raw_load(spark, sf_dir):
    """Landing JSON of stops -> raw table rows (batch month from the folder, nested text)."""
    root = scratch_path(spark, "landing")
    write_landing(api_records(spark, sf_dir, "stop_and_search_data"), root, "stop_and_search_data")
    return _no_load_time(raw_select(read_landing(spark, root, "stop_and_search_data"), "stop_and_search_data"))


def _own_crime_table(spark, sf_dir) -> tuple[str, str]:
    """A table of its own over the loaded months, for the replace queries to change: it points to the
    loaded folders, which are only read, and its replaced months to folders below a new root."""
    root = scratch_path(spark, "raw")
    name = f"blotter_raw.own_{root.rsplit('-', 1)[1]}"
    register_table(spark, "crime_data", name, raw_path(spark, sf_dir, "crime_data"))
    return name, root


def q_month_replace(spark, sf_dir):
    """Load all months, then reload one month (twice) with changed rows."""
    name, root = _own_crime_table(spark, sf_dir)
    records = api_records(spark, sf_dir, "crime_data")
    batch = raw_select(
        records.where(F.col(MONTH_COL) == RELOAD_MONTH).withColumn("context", F.lit("reloaded")), "crime_data"
    )
    replace_months_safely(batch, name, root)
    replace_months_safely(batch, name, root)
    return _no_load_time(source(spark, name))


def q_month_replace_empty_batch(spark, sf_dir):
    """Load all months, then an empty landing batch and a missing one for a loaded month."""
    name, own = _own_crime_table(spark, sf_dir)
    root = scratch_path(spark, "landing")
    spark.range(1).select(F.lit("[]").alias("value")).write.text(f"{root}/crime_data/date={RELOAD_MONTH}")
    empty = read_landing(spark, root, "crime_data", months=[RELOAD_MONTH])
    missing = read_landing(spark, root, "crime_data", months=["1900-01"])
    replace_months_safely(raw_select(empty, "crime_data"), name, own)
    replace_months_safely(raw_select(missing, "crime_data"), name, own)
    return _no_load_time(source(spark, name))


def q_named_source(spark, sf_dir):
    """The loaded raw crimes as a table of the catalog (``CREATE SCHEMA`` and ``CREATE TABLE IF
    NOT EXISTS`` over the loaded folder, months registered), read by name."""
    return _no_load_time(source(spark, raw_table(spark, sf_dir, "crime_data")))


def q_loaded_batches(spark, sf_dir):
    """Rows, and rows with a load time, of every loaded batch, from file footers alone."""
    return batch_counts(spark, {ds: raw_path(spark, sf_dir, ds) for ds in _TABLE_OF})


def _with_faults(spark, sf_dir) -> dict[str, DataFrame]:
    """The raw rows with faults planted by rules on their ids: street and crime ids that are no
    numbers, text cut off in the middle, stop times that are no times."""
    crimes, outcomes, stops = (raw(spark, sf_dir, ds) for ds in _TABLE_OF)
    wordy = lambda c: f"regexp_replace({c}, '\"id\":[0-9]+', '\"id\":\"none\"')"
    crime, street = "CAST(get_json_object(crime, '$.id') AS BIGINT)", "CAST(get_json_object(location, '$.street.id') AS BIGINT)"
    planted = {
        "crime_data": (crimes, "location", f"CASE WHEN id % 11 = 0 THEN {wordy('location')} WHEN id % 13 = 0 THEN left(location, 20) ELSE location END"),
        "outcome_data": (outcomes, "crime", f"CASE WHEN {crime} % 7 = 0 THEN {wordy('crime')} ELSE crime END"),
        "stop_and_search_data": (stops, "datetime", f"CASE WHEN {street} % 11 = 0 THEN 'at noon' ELSE datetime END"),
    }
    return {ds: df.withColumn(c, F.expr(e)) for ds, (df, c, e) in planted.items()}


def q_dq_conformance(spark, sf_dir):
    """The conformance of every documented column of the three datasets, with planted faults."""
    models = {"crime_data": "int_crimes", "outcome_data": "int_outcomes", "stop_and_search_data": "int_stop_search"}
    return quality.union_reports(
        [quality.conformance_checks(df, models[ds]) for ds, df in _with_faults(spark, sf_dir).items()]
    )


def q_areas_join(spark, sf_dir):
    """Crimes of the map with every one of many overlapping areas that holds them."""
    areas = selected_areas(read_table(spark, sf_dir, "nation"))
    joined = geo.areas_join(served_map(spark, sf_dir), areas, "crime_latitude", "crime_longitude")
    return joined.select("area", "crime_id", "crime_month", "crime_latitude", "crime_longitude")


def q_area_summary(spark, sf_dir):
    """Crimes per area and category, for many overlapping areas."""
    areas = selected_areas(read_table(spark, sf_dir, "nation"))
    joined = geo.areas_join(served_map(spark, sf_dir), areas, "crime_latitude", "crime_longitude")
    return joined.groupBy("area", "crime_category").agg(F.count(F.lit(1)).alias("crimes"))


def q_geo_clusters(spark, sf_dir):
    """Points per cell at several zooms."""
    return geo.geo_clusters(points(spark, sf_dir), CLUSTER_ZOOMS)


def q_load_audit(spark, sf_dir):
    """Per dataset and batch month: loaded rows, and rows without a load time or with one ahead
    of now."""
    bad = F.col(LOADED_AT).isNull() | (F.col(LOADED_AT) > F.current_timestamp())
    parts = [
        raw(spark, sf_dir, name)
        .groupBy(F.lit(name).alias("dataset"), MONTH_COL)
        .agg(F.count(F.lit(1)).alias("loaded_rows"), F.count_if(bad).alias("bad_load_times"))
        for name in _TABLE_OF
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_published_views(spark, sf_dir):
    """SQL over models published under their names: crimes of each month, and how many of them
    have a time to outcome."""
    publish(spark, {m: mart(spark, sf_dir, m) for m in ("mart_crime_map", "mart_outcome_timings")})
    return spark.sql(
        """
        SELECT m.crime_month, m.crimes, coalesce(t.timed, 0L) AS timed_crimes
        FROM (SELECT crime_month, count(*) AS crimes FROM mart_crime_map GROUP BY crime_month) m
        LEFT JOIN (SELECT crime_month, sum(crime_count) AS timed FROM mart_outcome_timings GROUP BY crime_month) t
          ON m.crime_month = t.crime_month
        """
    )


def q_lasting_views(spark, sf_dir):
    """Every model published as a view of the catalog, counted from a second session."""
    tables = {ds: raw_table(spark, sf_dir, ds) for ds in _TABLE_OF}
    schema = "blotter_views_" + hashlib.sha256(",".join(tables.values()).encode()).hexdigest()[:12]
    names = publish_views(spark, tables, schema)
    later = configure(spark.newSession())
    parts = [view(later, schema, m).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(m).alias("model"), "n_rows") for m in names]
    return quality.union_reports(parts)


def q_dq_not_null(spark, sf_dir):
    return quality.union_reports(
        [
            quality.not_null_checks(
                served_map(spark, sf_dir), "mart_crime_map", ["crime_id", "crime_latitude", "crime_longitude"]
            ),
            quality.not_null_checks(served_timings(spark, sf_dir), "mart_outcome_timings", ["crime_month", "crime_category"]),
        ]
    )


def q_dq_unique(spark, sf_dir):
    """Duplicated crime ids of the crime map (the model's unique test) and of the outcomes."""
    def dup(model):
        d = quality.duplicate_values(crime_ids(spark, sf_dir, model), "crime_id")
        return d.select(F.lit(model).alias("model"), F.col("value").alias("crime_id"), "occurrences")

    return dup("mart_crime_map").unionByName(dup("int_outcomes"))


def q_dq_report(spark, sf_dir):
    from blotter.plans.build import quality_report

    raws = {ds: raw(spark, sf_dir, ds) for ds in _TABLE_OF}
    return quality_report(int_crimes(spark, sf_dir), served_timings(spark, sf_dir), raws["stop_and_search_data"], raws=raws)


def q_build_report(spark, sf_dir):
    """The whole monthly build over the input tables, in dependency order; its report."""
    from blotter.plans.build import build_all

    return build_all(spark, sf_dir=sf_dir)["report"]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_crimes": q_stg_crimes,
    "stg_outcomes": q_stg_outcomes,
    "stg_stop_search": q_stg_stop_search,
    "int_crimes": int_crimes,
    "int_outcomes": int_outcomes,
    "int_stop_search": int_stops,
    "mart_crime_map": crime_map,
    "mart_outcome_timings": timings,
    "mart_outcome_mix": mix,
    "mart_reason_trends": trends,
    "outcome_summary": lambda s, d: serving.outcome_summary(served_timings(s, d)),
    "outcome_trend": lambda s, d: serving.outcome_trend(served_timings(s, d)),
    "map_points": points,
    "map_summary": q_map_summary,
    "map_extent": lambda s, d: serving.map_extent(points(s, d)),
    "kpis": q_kpis,
    "kpis_month": q_kpis_month,
    "month_options": lambda s, d: serving.month_options(points(s, d)),
    "top_objects": lambda s, d: serving.top_objects(served_mix(s, d)),
    "outcome_mix_top_objects": lambda s, d: serving.outcome_mix_top_objects(served_mix(s, d)),
    "outcome_heatmap": q_outcome_heatmap,
    "reason_trend_sorted": lambda s, d: serving.reason_trend_sorted(served_trends(s, d)),
    "month_filter": q_month_filter,
    "map_summary_month": q_map_summary_month,
    "outcome_summary_month": q_outcome_summary_month,
    "reason_trend_month": q_reason_trend_month,
    "geo_grid": q_geo_grid,
    "bbox_filter": q_bbox_filter,
    "month_spine": q_month_spine,
    "batch_coverage": q_batch_coverage,
    "json_roundtrip_scan": q_json_roundtrip_scan,
    "raw_load": q_raw_load,
    "month_replace": q_month_replace,
    "month_replace_empty_batch": q_month_replace_empty_batch,
    "named_source": q_named_source,
    "loaded_batches": q_loaded_batches,
    "areas_join": q_areas_join,
    "area_summary": q_area_summary,
    "geo_clusters": q_geo_clusters,
    "dq_conformance": q_dq_conformance,
    "lasting_views": q_lasting_views,
    "load_audit": q_load_audit,
    "published_views": q_published_views,
    "mart_scan_month": lambda s, d: served_map(s, d, SELECTED_MONTH),
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_report": q_dq_report,
    "build_report": q_build_report,
}


def run(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    configure(spark)
    return QUERIES[name](spark, sf_dir)
