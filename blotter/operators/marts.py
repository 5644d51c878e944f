"""Marts: the analysis tables served to the dashboard.

Plans, as Catalyst builds them:

* ``crime_map``: a projection, no shuffle.
* ``outcome_timings``: a histogram first, one row per (month, category, months to outcome),
  by a partial hash aggregate, so a month or category holding a third of all rows sends one
  row per task and span. Count, mean, exact median and range then come from the few histogram
  rows.
* ``outcome_mix`` / ``reason_trends``: the same aggregate, then a share-of-total window. The
  window's input is the aggregated rows (one per key pair), so its second exchange is tiny
  whatever the skew of the raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions.months import month_of, months_to_outcome
from blotter.functions.values import label_null, share


def crime_map(int_crimes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per crime with its coordinates (still text; null locations kept). ``keep``
    carries extra columns through (the build keeps the batch month to store the map by it)."""
    return int_crimes.select(
        "crime_id",
        "crime_month",
        "crime_category",
        "crime_latitude",
        "crime_longitude",
        "crime_street_name",
        "latest_outcome_category",
        *keep,
    )


def timing_spans(int_crimes: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """The state that timings are made of: crimes per (crime month, category, whole months from crime
    to latest outcome), ``n``. States of parts of the crimes add up: with ``keep`` (the batch month)
    they are stored per batch, and a batch's state is replaced with it. Crimes without a span are
    counted too, so a batch with crimes always has a state that replaces its last one."""
    span = months_to_outcome("latest_outcome_date", "crime_month", strict).alias("months_to_outcome")
    keys = [*keep, "crime_month", "crime_category"]
    return int_crimes.select(*keys, span).groupBy(*keys, "months_to_outcome").agg(F.count(F.lit(1)).alias("n"))


def timings_of(spans: DataFrame) -> DataFrame:
    """Per (crime month, category): count, mean, exact median (lower middle), min and max of whole
    months to outcome, from ``timing_spans`` of any parts that together hold the crimes once. Crimes
    without an outcome or month are left out, and so are negative spans."""
    keys = ["crime_month", "crime_category"]
    span, n = F.col("months_to_outcome"), F.col("n")
    timed = spans.where("months_to_outcome >= 0 AND crime_month IS NOT NULL")
    histogram = timed.groupBy(*keys, "months_to_outcome").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys)
    up_to = F.sum(n).over(group.orderBy("months_to_outcome"))
    return (
        histogram.withColumn("in_upper_half", 2 * up_to >= F.sum(n).over(group))
        .groupBy(*keys)
        .agg(
            F.sum(n).alias("crime_count"),
            (F.sum(span * n).cast("double") / F.sum(n).cast("double")).alias("avg_months_to_outcome"),
            F.min(F.when(F.col("in_upper_half"), span)).alias("median_months_to_outcome"),
            F.min(span).alias("min_months_to_outcome"),
            F.max(span).alias("max_months_to_outcome"),
        )
    )


def outcome_timings(int_crimes: DataFrame, strict: bool = True) -> DataFrame:
    """``timings_of`` all crimes."""
    return timings_of(timing_spans(int_crimes, strict))


def share_of_total(df: DataFrame, count_col: str, partition_cols: list[str], out_col: str) -> DataFrame:
    """``count / sum(count) over (partition by ...)`` in double precision.

    Meant for aggregated rows: the window sorts and buffers one partition key's rows, which
    after aggregation are the distinct values of the other grouping keys, not raw rows.
    """
    total = F.sum(count_col).over(Window.partitionBy(*partition_cols))
    return df.withColumn(out_col, share(F.col(count_col), total))


def stop_counts(int_stops: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The state that mix and trends are made of: stops per (stop month, object of search, outcome),
    ``n``, nulls labelled ``Unknown``. States of parts add up, as those of ``timing_spans`` do."""
    return int_stops.groupBy(
        *keep,
        month_of("stop_search_datetime").alias("stop_search_month"),
        label_null("object_of_search").alias("object_of_search"),
        label_null("outcome").alias("outcome"),
    ).agg(F.count(F.lit(1)).alias("n"))


def outcome_mix_of(counts: DataFrame) -> DataFrame:
    """Count per (object of search, outcome) with the share of each outcome within its object, from
    ``stop_counts``."""
    grouped = counts.groupBy("object_of_search", "outcome").agg(F.sum("n").alias("stop_search_count"))
    return share_of_total(grouped, "stop_search_count", ["object_of_search"], "pct_within_object_of_search")


def reason_trends_of(counts: DataFrame) -> DataFrame:
    """Count per (stop month, object of search) with the share of the month's stops, from
    ``stop_counts``."""
    grouped = counts.groupBy("stop_search_month", "object_of_search").agg(F.sum("n").alias("stop_search_count"))
    return share_of_total(grouped, "stop_search_count", ["stop_search_month"], "pct_of_month_total")


def outcome_mix(int_stops: DataFrame) -> DataFrame:
    """Count per (object of search, outcome), nulls labelled ``Unknown``, with the share of
    each outcome within its object."""
    grouped = int_stops.groupBy(
        label_null("object_of_search").alias("object_of_search"),
        label_null("outcome").alias("outcome"),
    ).agg(F.count(F.lit(1)).alias("stop_search_count"))
    return share_of_total(grouped, "stop_search_count", ["object_of_search"], "pct_within_object_of_search")


def reason_trends(int_stops: DataFrame) -> DataFrame:
    """Count per (stop month, object of search) with the share of the month's stops."""
    grouped = int_stops.groupBy(
        month_of("stop_search_datetime").alias("stop_search_month"),
        label_null("object_of_search").alias("object_of_search"),
    ).agg(F.count(F.lit(1)).alias("stop_search_count"))
    return share_of_total(grouped, "stop_search_count", ["stop_search_month"], "pct_of_month_total")
