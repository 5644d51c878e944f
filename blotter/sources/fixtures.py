"""Adapters from the generated test tables to API-shaped incident records.

The incident API sends crimes, outcomes and stop-and-search records as JSON objects with
nested ``location`` / ``outcome_status`` / ``crime`` / ``outcome_object`` values. These
adapters build records of exactly that shape (nested values as structs) from the
``orders``, ``lineitem`` and ``events`` tables, so every later layer does its real work:
the load turns the nested values into JSON text, staging casts, flatten parses.

Each adapter is a projection of one table, so it runs as one narrow stage over all rows. Rows that
already carry their batch month keep it, so that a load can deal and order the narrow table rows by
month before they are widened (``by_month``).
The constants are arbitrary but deterministic: about 2 % of crimes get no location, open
orders get no outcome, and some outcomes fall before their crime month, so every filter of
the marts has rows to drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schemas import MONTH_COL
from blotter.sources.raw import month_clustered


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Projections are SQL expressions: one parse in the JVM per column instead of one driver
# round trip per expression node; Catalyst plans them exactly like Column expressions.


# Per dataset: its table, the batch month of a row, and what rows are ordered by within a month (the
# table's expression of the dataset's ``cluster_by``).
_OBJECT = "CASE WHEN event_type <> 'error' THEN concat(event_type, '-', CAST(user_id % 4 AS STRING)) END"
_STOP_TIME = "date_format(ts + make_dt_interval(CAST(event_id % 12 * 30 AS INT)), \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\")"
_TABLES = {
    "crime_data": ("orders", "date_format(o_orderdate, 'yyyy-MM')", ("o_orderpriority",)),
    "outcome_data": ("lineitem", "date_format(l_shipdate, 'yyyy-MM')", ()),
    "stop_and_search_data": ("events", f"substring({_STOP_TIME}, 1, 7)", (_OBJECT,)),
}


def _month(rows: DataFrame, dataset: str) -> str:
    return MONTH_COL if MONTH_COL in rows.columns else f"{_TABLES[dataset][1]} AS {MONTH_COL}"


def _location(street_id: str, lat_off: str, lon_off: str, street_name: str) -> str:
    return f"""named_struct(
        'latitude', concat('53.', CAST(3500 + {lat_off} AS STRING)),
        'street', named_struct('id', {street_id}, 'name', {street_name}),
        'longitude', concat('-1.', CAST(4200 + {lon_off} AS STRING)))"""


def api_crimes(orders: DataFrame) -> DataFrame:
    """orders -> ``crime_data`` records, one per order; batch month = crime month."""
    location = _location("o_custkey", "o_custkey % 600", "o_custkey % 1000", "concat('On or near ', CAST(o_custkey % 97 AS STRING))")
    outcome_month = "date_format(add_months(to_date(o_orderdate), CAST(o_orderkey % 7 AS INT) - 1), 'yyyy-MM')"
    return orders.selectExpr(
        "o_orderpriority AS category",
        "'' AS context",
        "o_orderkey AS id",
        f"CASE WHEN o_orderkey % 50 <> 0 THEN {location} END AS location",
        "'' AS location_subtype",
        "CASE WHEN o_orderkey % 20 = 0 THEN 'BTP' ELSE 'Force' END AS location_type",
        "date_format(o_orderdate, 'yyyy-MM') AS month",
        f"CASE WHEN o_orderstatus <> 'O' THEN named_struct('category', o_orderstatus, 'date', {outcome_month}) END AS outcome_status",
        "CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE concat('p', CAST(o_orderkey AS STRING)) END AS persistent_id",
        _month(orders, "crime_data"),
    )


def api_outcomes(lineitem: DataFrame) -> DataFrame:
    """lineitem -> ``outcome_data`` records; the crime sits nested inside each outcome."""
    location = _location("l_suppkey", "l_suppkey", "l_suppkey", "concat('On or near ', CAST(l_suppkey AS STRING))")
    crime = f"""named_struct(
        'id', l_orderkey,
        'persistent_id', concat('p', CAST(l_orderkey AS STRING)),
        'category', l_returnflag,
        'location_type', 'Force',
        'location_subtype', '',
        'context', '',
        'month', date_format(add_months(to_date(l_shipdate), -2), 'yyyy-MM'),
        'location', CASE WHEN l_orderkey % 50 <> 0 THEN {location} END)"""
    return lineitem.selectExpr(
        "named_struct('code', concat('c-', l_linestatus), 'name', concat('Outcome ', l_linestatus)) AS category",
        f"{crime} AS crime",
        "date_format(l_shipdate, 'yyyy-MM') AS date",
        "CASE WHEN l_linenumber = 1 THEN concat('person-', CAST(l_partkey AS STRING)) END AS person_id",
        _month(lineitem, "outcome_data"),
    )


def api_stops(events: DataFrame) -> DataFrame:
    """events -> ``stop_and_search_data`` records.

    The events cover one month and five types, so rows are spread over twelve 30-day steps
    and types are split by user, which gives 17 objects of search (16 named and null).
    """
    k5 = "CAST(get_json_object(props, '$.k') AS INT) % 5"
    location = _location("user_id", "user_id % 600", "user_id % 1000", "concat('On or near ', CAST(user_id AS STRING))")
    return events.selectExpr(
        "CASE user_id % 3 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' END AS age_range",
        "'White' AS officer_defined_ethnicity",
        "event_id % 2 = 0 AS involved_person",
        "CAST(NULL AS STRING) AS self_defined_ethnicity",
        "CASE WHEN user_id % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender",
        "'Act 1' AS legislation",
        "CASE WHEN event_id % 3 <> 0 THEN event_id % 3 = 1 END AS outcome_linked_to_object_of_search",
        f"{_STOP_TIME} AS datetime",
        "CASE WHEN event_id % 4 <> 0 THEN named_struct('id', concat('bu-', CAST(event_id % 4 AS STRING)), 'name', 'Recorded') END"
        " AS outcome_object",
        f"CASE WHEN event_id % 9 <> 0 THEN {location} END AS location",
        f"{_OBJECT} AS object_of_search",
        "CAST(NULL AS BOOLEAN) AS operation",
        f"CASE {k5} WHEN 0 THEN 'false' WHEN 1 THEN '' WHEN 3 THEN 'Arrest' WHEN 4 THEN 'Community resolution' END AS outcome",
        "'Person search' AS type",
        "CAST(NULL AS STRING) AS operation_name",
        "event_id % 7 = 0 AS removal_of_more_than_outer_clothing",
        _month(events, "stop_and_search_data"),
    )


def selected_areas(nation: DataFrame) -> DataFrame:
    """nation -> an area table: one rectangle per nation inside the test points' extent, of several
    sizes, many of which overlap."""
    return nation.selectExpr(
        "n_name AS area",
        "53.35D + 0.0024D * n_nationkey AS lat",
        "-1.42D - 0.004D * (n_nationkey * 7 % 25) AS lng",
        "0.002D * (1 + n_nationkey % 4) AS lat_range",
        "0.004D * (1 + n_nationkey % 3) AS lng_range",
    )


_ADAPTERS = {"crime_data": api_crimes, "outcome_data": api_outcomes, "stop_and_search_data": api_stops}


def api_records(spark: SparkSession, sf_dir: str, dataset: str, by_month: bool = False) -> DataFrame:
    """API-shaped records of one dataset, with their batch month in ``ingest_year_month``.

    ``by_month``: dealt by month and in the order of a load (``month_clustered``). The rows of the
    table move, a fraction of what their records, or the records' JSON text, hold."""
    table, month, order = _TABLES[dataset]
    rows = read_table(spark, sf_dir, table)
    if by_month:
        rows = month_clustered(rows.withColumn(MONTH_COL, F.expr(month)), [F.expr(o) for o in order])
    return _ADAPTERS[dataset](rows)
