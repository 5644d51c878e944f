"""Named tables: source lookup, view publication, and the serving scans of the marts.

Models are plain ``DataFrame -> DataFrame`` functions; when SQL access is wanted they are
published as temp views under their model names, and sources are looked up by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.months import month_filter
from blotter.functions.values import try_double
from blotter.operators.geo import place_key

# folder key of the stored marts
MART_PARTITION = "month_key"
# numeric coordinates of the stored map
PLACE_LAT, PLACE_LON = "place_lat", "place_lon"

# The columns the dashboard reads from each mart, and the month column it
# filters on (None: that mart is not filtered by month).
SERVING_COLUMNS: dict[str, tuple[list[str], str | None]] = {
    "mart_crime_map": (
        [
            "crime_id",
            "crime_month",
            "crime_category",
            "crime_latitude",
            "crime_longitude",
            "crime_street_name",
            "latest_outcome_category",
        ],
        "crime_month",
    ),
    "mart_outcome_timings": (
        [
            "crime_month",
            "crime_category",
            "crime_count",
            "avg_months_to_outcome",
            "median_months_to_outcome",
            "min_months_to_outcome",
            "max_months_to_outcome",
        ],
        "crime_month",
    ),
    "mart_reason_trends": (
        ["stop_search_month", "object_of_search", "stop_search_count", "pct_of_month_total"],
        "stop_search_month",
    ),
    "mart_outcome_mix": (
        ["object_of_search", "outcome", "stop_search_count", "pct_within_object_of_search"],
        None,
    ),
}


def publish(spark: SparkSession, frames: dict[str, DataFrame]) -> list[str]:
    """Register each model as a temp view under its name; returns the names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def publish_build(spark: SparkSession, build: dict) -> list[str]:
    """Publish every table of a ``build_all`` result as a temp view: raw tables under their
    dataset names, the flattened layer and the marts under their model names."""
    frames = {}
    for group in ("raw", "int", "mart"):
        for name, path in build[group].items():
            # with its schema: a table whose months all came in empty has no files to infer it from
            frames[name] = spark.read.schema(build["schemas"][name]).parquet(path)
    return publish(spark, frames)


def source(spark: SparkSession, name: str) -> DataFrame:
    """A named source or published model."""
    return spark.table(name)


def read_mart(
    spark: SparkSession,
    path: str,
    model: str,
    month: str | None = None,
    box: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Scan a written mart with the dashboard's explicit column list and month selection;
    both reach the parquet scan (column pruning, pushed filter). So does a ``box`` (centre
    latitude and longitude, and their ranges) on the stored map, whose files are in the order of
    their place, so that most of their row groups lie outside a small one."""
    columns, month_col = SERVING_COLUMNS[model]
    df = spark.read.parquet(path)
    if box is not None:
        lat, lng, lat_range, lng_range = box
        df = df.where(
            F.col(PLACE_LAT).between(lat - lat_range, lat + lat_range) & F.col(PLACE_LON).between(lng - lng_range, lng + lng_range)
        )
    if month_col is None:
        return df.select(*columns)
    if MART_PARTITION in df.columns:
        df = month_filter(df, MART_PARTITION, month)
    return month_filter(df.select(*columns), month_col, month)


def placed_map(crimes: DataFrame) -> DataFrame:
    """The crime map with its coordinates as numbers too, each task's rows by month, then by place
    (a Morton key of the point), so that row groups hold small areas."""
    lat, lon = try_double("crime_latitude"), try_double("crime_longitude")
    return (
        crimes.withColumn(PLACE_LAT, lat)
        .withColumn(PLACE_LON, lon)
        .sortWithinPartitions(MART_PARTITION, place_key(F.col(PLACE_LAT), F.col(PLACE_LON)))
    )


def write_mart(df: DataFrame, path: str, model: str) -> None:
    """Store a mart for serving: in folders by its month, which a month selection prunes (the
    month stays a column of the files, where null and empty text keep their difference)."""
    month_col = SERVING_COLUMNS[model][1]
    if month_col is None:
        df.write.mode("overwrite").parquet(path)
    else:
        out = df.withColumn(MART_PARTITION, F.col(month_col)).hint("rebalance", MART_PARTITION)
        if model == "mart_crime_map":
            out = placed_map(out)
        out.write.mode("overwrite").partitionBy(MART_PARTITION).parquet(path)
