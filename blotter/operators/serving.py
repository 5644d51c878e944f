"""Serving operators: what the dashboard computes from the marts, kept on Spark.

Every operator takes the month selection as a parameter, so the filter sits in the plan and
reaches the mart scan, and returns a DataFrame; only final, small results ever need to be
collected. Grouping keys that are null are left out of summaries (a dashboard summary has no
row for a missing category), and sorts put nulls last in both directions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions.months import month_filter
from blotter.functions.values import exact_mean, exact_sum, try_double

TOP_K = 10


def map_points(crime_map: DataFrame, month: str | None = None) -> DataFrame:
    """Mappable crimes: both coordinates present and numeric, renamed ``lat``/``lon``, with a
    tooltip ``"<category> - <street>"`` (null parts are skipped)."""
    # a coordinate that is null, or text that is not a number, gives a null double: one
    # test per coordinate covers both the presence filter and the failed-cast drop
    typed = month_filter(crime_map, "crime_month", month).select(
        "crime_id",
        F.col("crime_month").cast("string").alias("crime_month"),
        "crime_category",
        try_double("crime_latitude").alias("lat"),
        try_double("crime_longitude").alias("lon"),
        "crime_street_name",
        "latest_outcome_category",
        F.concat_ws(" - ", "crime_category", "crime_street_name").alias("tooltip"),
    )
    return typed.where("lat IS NOT NULL AND lon IS NOT NULL")


def map_summary(points: DataFrame) -> DataFrame:
    """Mapped crimes per (month, category), newest month first, then largest count."""
    return (
        points.where(F.col("crime_month").isNotNull() & F.col("crime_category").isNotNull())
        .groupBy("crime_month", "crime_category")
        .agg(F.count("crime_id").alias("sum_crimes"))
        .orderBy(F.col("crime_month").desc_nulls_last(), F.col("sum_crimes").desc_nulls_last())
    )


def _weighted(timings: DataFrame, keys: list[str]) -> DataFrame:
    """Re-aggregate monthly timing rows: mean weighted by count, via an exact sum."""
    weighted = F.col("avg_months_to_outcome") * F.col("crime_count")
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return timings.where(cond).groupBy(*keys).agg(
        exact_sum(weighted).alias("weighted_months"),
        F.sum("crime_count").alias("total_crimes"),
        F.avg("median_months_to_outcome").alias("median_months_to_outcome"),
        F.min("min_months_to_outcome").alias("min_months_to_outcome"),
        F.max("max_months_to_outcome").alias("max_months_to_outcome"),
    ).withColumn(
        "avg_months_to_outcome",
        F.col("weighted_months").cast("double") / F.col("total_crimes").cast("double"),
    )


def outcome_summary(timings: DataFrame, month: str | None = None) -> DataFrame:
    """Per category: total crimes, count-weighted mean, mean of the monthly medians, min and
    max of months to outcome; slowest category first."""
    s = _weighted(month_filter(timings, "crime_month", month), ["crime_category"])
    return s.orderBy(F.col("avg_months_to_outcome").desc_nulls_last(), F.col("crime_category")).select(
        "crime_category",
        "total_crimes",
        "avg_months_to_outcome",
        "median_months_to_outcome",
        "min_months_to_outcome",
        "max_months_to_outcome",
    )


def outcome_trend(timings: DataFrame, month: str | None = None) -> DataFrame:
    """Count-weighted mean months to outcome per (month, category), in month order."""
    s = _weighted(month_filter(timings, "crime_month", month), ["crime_month", "crime_category"])
    return s.orderBy(F.col("crime_month").asc_nulls_last(), F.col("crime_category")).select(
        "crime_month",
        "crime_category",
        F.col("total_crimes").alias("crime_count"),
        "avg_months_to_outcome",
    )


def kpis(points: DataFrame, trends: DataFrame, month: str | None = None) -> DataFrame:
    """One row: mapped crimes and stop-and-searches of the selected month (all months when
    None; 0 when there are none) and the number of distinct months over all mapped crimes.

    Both inputs are tagged and unioned so that the three figures come out of one aggregate,
    with no join between single-row results.
    """
    crimes = points.select(
        F.lit("crime").alias("kind"), F.col("crime_month").alias("m"), F.lit(None).cast("bigint").alias("n")
    )
    stops = trends.select(
        F.lit("stop").alias("kind"), F.col("stop_search_month").alias("m"), F.col("stop_search_count").alias("n")
    )
    u = crimes.unionByName(stops)
    in_month = F.lit(True) if month in (None, "All") else (F.col("m") == F.lit(month))
    is_crime = F.col("kind") == "crime"
    is_stop = F.col("kind") == "stop"
    return u.agg(
        F.count_if(is_crime & in_month).alias("total_crimes"),
        F.coalesce(F.sum(F.when(is_stop & in_month, F.col("n"))), F.lit(0).cast("bigint")).alias(
            "total_stop_searches"
        ),
        F.count_distinct(F.when(is_crime, F.col("m"))).alias("months_available"),
    )


def month_options(points: DataFrame) -> DataFrame:
    """Distinct non-null months of the mapped crimes, ascending."""
    return points.select("crime_month").where(F.col("crime_month").isNotNull()).distinct().orderBy("crime_month")


def map_extent(points: DataFrame) -> DataFrame:
    """Bounding box and centre of the mapped points (one row)."""
    return points.agg(
        F.min("lat").alias("min_lat"),
        F.max("lat").alias("max_lat"),
        F.min("lon").alias("min_lon"),
        F.max("lon").alias("max_lon"),
        exact_mean(F.col("lat")).alias("center_lat"),
        exact_mean(F.col("lon")).alias("center_lon"),
    )


def top_objects(mix: DataFrame, k: int = TOP_K) -> DataFrame:
    """The ``k`` objects of search with most stops; ties go to the smaller name.

    ``orderBy(...).limit(k)`` plans as a per-task top-k plus a final merge of at most
    ``k`` rows per task (TakeOrderedAndProject), never a full sort.
    """
    return (
        mix.where(F.col("object_of_search").isNotNull())
        .groupBy("object_of_search")
        .agg(F.sum("stop_search_count").alias("total_searches"))
        .orderBy(F.col("total_searches").desc(), F.col("object_of_search").asc())
        .limit(k)
    )


def outcome_mix_top_objects(mix: DataFrame, k: int = TOP_K) -> DataFrame:
    """Outcome-mix rows of the top-``k`` objects, object ascending, count descending.

    The key list has at most ``k`` rows, so broadcasting it is bounded by ``k`` regardless of
    data size; the mix rows are never shuffled for the filter.
    """
    keys = top_objects(mix, k).select("object_of_search")
    return mix.join(F.broadcast(keys), "object_of_search", "left_semi").orderBy(
        F.col("object_of_search").asc_nulls_last(), F.col("stop_search_count").desc_nulls_last()
    )


def outcome_heatmap_cells(mix: DataFrame, k: int = TOP_K) -> DataFrame:
    """The heatmap in long form: every top-``k`` object with every outcome that occurs among
    them, and its share, 0 where absent. The outcomes come from the data, so none is missed.

    The window spans the ``k`` grouped rows, not the mix; each holds one entry per outcome.
    """
    cells = F.map_from_entries(F.collect_list(F.struct("outcome", "pct_within_object_of_search")))
    per_object = outcome_mix_top_objects(mix, k).groupBy("object_of_search").agg(cells.alias("cells"))
    everything = F.flatten(F.collect_list(F.map_keys("cells")).over(Window.partitionBy(F.lit(1))))
    return (
        per_object.withColumn("outcomes", F.array_distinct(everything))
        .select("object_of_search", "cells", F.explode("outcomes").alias("outcome"))
        .select(
            "object_of_search",
            "outcome",
            F.coalesce(F.try_element_at("cells", F.col("outcome")), F.lit(0.0)).alias("pct_within_object_of_search"),
        )
    )


def pivot_column(prefix: str, value: str) -> str:
    """Column name for a pivoted value: ``Community resolution`` -> ``outcome_community_resolution``,
    ``''`` -> ``outcome_empty``."""
    slug = re.sub(r"[^0-9a-z]+", "_", value.lower()).strip("_")
    return f"{prefix}_{slug or 'empty'}"


def outcome_heatmap(mix: DataFrame, outcomes: list[str] | None = None, k: int = TOP_K) -> DataFrame:
    """Share of each outcome (columns) per top-``k`` object (rows), 0 where absent.

    With ``outcomes`` given, the pivot needs no extra job to find its columns; with None,
    Spark first collects the distinct outcomes of the top-``k`` rows (at most
    ``spark.sql.pivotMaxValues``) and the columns come out in sorted order. Mix rows are
    unique per (object, outcome), so the pivot aggregate sees one value per cell.
    """
    rows = outcome_mix_top_objects(mix, k)
    grouped = rows.groupBy("object_of_search")
    pivoted = grouped.pivot("outcome", outcomes) if outcomes is not None else grouped.pivot("outcome")
    wide = pivoted.agg(F.sum("pct_within_object_of_search"))
    # pivot columns follow the order of the values; rename by position (a value may be '')
    values = outcomes if outcomes is not None else wide.columns[1:]
    names = [pivot_column("outcome", v) for v in values]
    wide = wide.toDF("object_of_search", *names)
    return wide.select("object_of_search", *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in names])


def reason_trend_sorted(trends: DataFrame, month: str | None = None) -> DataFrame:
    """Reason-trend rows of the selected month, newest month and largest count first."""
    return month_filter(trends, "stop_search_month", month).orderBy(
        F.col("stop_search_month").desc_nulls_last(), F.col("stop_search_count").desc_nulls_last()
    )
