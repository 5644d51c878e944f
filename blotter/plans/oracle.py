"""Independent SQL twins of the catalogue queries, written for DuckDB.

They read the generated tables directly and build the flattened rows without any JSON
parsing, so a query and its twin share no code path. Column names match the Spark queries.
Averages of doubles are summed as ``decimal(38,9)`` on both sides, so results do not depend
on summation order.
"""

from __future__ import annotations

# parameters of the month queries, and the documented columns of the flattened crimes
SELECTED_MONTH = "1998-01"
SELECTED_STOP_MONTH = "2024-06"
RELOAD_MONTH = "1998-01"
INT_CRIMES_COLUMNS = (
    "crime_id persistent_id crime_category crime_month location_type location_subtype context crime_latitude "
    "crime_longitude crime_street_id crime_street_name latest_outcome_category latest_outcome_date"
).split()


def _dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _with(body: str, **ctes: str) -> str:
    parts = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"


# --- JSON text of the raw tables ---------------------------------------------------------

_CRIME_LOCATION_JSON = """CASE WHEN o_orderkey % 50 <> 0 THEN json_object(
      'latitude', '53.' || (3500 + o_custkey % 600),
      'street', json_object('id', o_custkey, 'name', 'On or near ' || (o_custkey % 97)),
      'longitude', '-1.' || (4200 + o_custkey % 1000))::VARCHAR END"""

_CRIME_OUTCOME_JSON = """CASE WHEN o_orderstatus <> 'O' THEN json_object(
      'category', o_orderstatus,
      'date', strftime(o_orderdate + to_months(CAST(o_orderkey % 7 AS INT) - 1), '%Y-%m'))::VARCHAR END"""

RAW_CRIMES = f"""SELECT o_orderpriority AS category, '' AS context, o_orderkey AS id,
    {_CRIME_LOCATION_JSON} AS location,
    '' AS location_subtype,
    CASE WHEN o_orderkey % 20 = 0 THEN 'BTP' ELSE 'Force' END AS location_type,
    strftime(o_orderdate, '%Y-%m') AS month,
    {_CRIME_OUTCOME_JSON} AS outcome_status,
    CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'p' || o_orderkey END AS persistent_id,
    strftime(o_orderdate, '%Y-%m') AS ingest_year_month
  FROM orders"""

_STOP_LOCATION_JSON = """CASE WHEN event_id % 9 <> 0 THEN json_object(
      'latitude', '53.' || (3500 + user_id % 600),
      'street', json_object('id', user_id, 'name', 'On or near ' || user_id),
      'longitude', '-1.' || (4200 + user_id % 1000))::VARCHAR END"""

_STOP_OBJECT_JSON = """CASE WHEN event_id % 4 <> 0 THEN json_object(
      'id', 'bu-' || (event_id % 4), 'name', 'Recorded')::VARCHAR END"""

_STOP_OUTCOME = """CASE CAST(props->>'$.k' AS INT) % 5 WHEN 0 THEN 'false' WHEN 1 THEN ''
      WHEN 3 THEN 'Arrest' WHEN 4 THEN 'Community resolution' END"""

_STOP_DATETIME = "strftime(ts + to_days(CAST(event_id % 12 * 30 AS INT)), '%Y-%m-%dT%H:%M:%S+00:00')"

RAW_STOPS = f"""SELECT CASE user_id % 3 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' END AS age_range,
    'White' AS officer_defined_ethnicity, event_id % 2 = 0 AS involved_person,
    CAST(NULL AS VARCHAR) AS self_defined_ethnicity,
    CASE WHEN user_id % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender, 'Act 1' AS legislation,
    CASE WHEN event_id % 3 <> 0 THEN event_id % 3 = 1 END AS outcome_linked_to_object_of_search,
    {_STOP_DATETIME} AS datetime,
    {_STOP_OBJECT_JSON} AS outcome_object,
    {_STOP_LOCATION_JSON} AS location,
    CASE WHEN event_type <> 'error' THEN event_type || '-' || (user_id % 4) END AS object_of_search,
    CAST(NULL AS BOOLEAN) AS operation,
    {_STOP_OUTCOME} AS outcome,
    'Person search' AS type, CAST(NULL AS VARCHAR) AS operation_name,
    event_id % 7 = 0 AS removal_of_more_than_outer_clothing,
    substr({_STOP_DATETIME}, 1, 7) AS ingest_year_month
  FROM events"""

STG_CRIMES = f"""SELECT o_orderpriority AS crime_category,
    CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'p' || o_orderkey END AS persistent_id,
    '' AS location_subtype, o_orderkey AS crime_id,
    {_CRIME_LOCATION_JSON} AS location,
    '' AS context, strftime(o_orderdate, '%Y-%m') AS crime_month,
    CASE WHEN o_orderkey % 20 = 0 THEN 'BTP' ELSE 'Force' END AS location_type,
    {_CRIME_OUTCOME_JSON} AS outcome_status
  FROM orders"""

_OUTCOME_LOCATION = """json_object('latitude', '53.' || (3500 + l_suppkey),
        'street', json_object('id', l_suppkey, 'name', 'On or near ' || l_suppkey),
        'longitude', '-1.' || (4200 + l_suppkey))"""

STG_OUTCOMES = f"""SELECT json_object('code', 'c-' || l_linestatus, 'name', 'Outcome ' || l_linestatus)::VARCHAR AS category,
    strftime(l_shipdate, '%Y-%m') AS outcome_date,
    CASE WHEN l_linenumber = 1 THEN 'person-' || l_partkey END AS person_id,
    CASE WHEN l_orderkey % 50 <> 0 THEN
      json_object('id', l_orderkey, 'persistent_id', 'p' || l_orderkey, 'category', l_returnflag,
        'location_type', 'Force', 'location_subtype', '', 'context', '',
        'month', strftime(l_shipdate - to_months(2), '%Y-%m'), 'location', {_OUTCOME_LOCATION})
    ELSE
      json_object('id', l_orderkey, 'persistent_id', 'p' || l_orderkey, 'category', l_returnflag,
        'location_type', 'Force', 'location_subtype', '', 'context', '',
        'month', strftime(l_shipdate - to_months(2), '%Y-%m'))
    END::VARCHAR AS crime
  FROM lineitem"""

STG_STOPS = f"""SELECT CASE user_id % 3 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' END AS age_range,
    'White' AS officer_defined_ethnicity, event_id % 2 = 0 AS involved_person,
    CAST(NULL AS VARCHAR) AS self_defined_ethnicity,
    CASE WHEN user_id % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender, 'Act 1' AS legislation,
    CASE WHEN event_id % 3 <> 0 THEN event_id % 3 = 1 END AS outcome_linked_to_object_of_search,
    date_trunc('second', ts + to_days(CAST(event_id % 12 * 30 AS INT))) AS stop_search_datetime,
    {_STOP_OBJECT_JSON} AS outcome_object,
    {_STOP_LOCATION_JSON} AS location,
    CASE WHEN event_type <> 'error' THEN event_type || '-' || (user_id % 4) END AS object_of_search,
    CAST(NULL AS BOOLEAN) AS operation,
    {_STOP_OUTCOME} AS outcome,
    'Person search' AS stop_search_type, CAST(NULL AS VARCHAR) AS operation_name,
    event_id % 7 = 0 AS removal_of_more_than_outer_clothing
  FROM events"""

# --- flattened layer, built directly ------------------------------------------------------

INT_CRIMES = """SELECT o_orderkey AS crime_id,
    CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'p' || o_orderkey END AS persistent_id,
    o_orderpriority AS crime_category, strftime(o_orderdate, '%Y-%m') AS crime_month,
    CASE WHEN o_orderkey % 20 = 0 THEN 'BTP' ELSE 'Force' END AS location_type,
    '' AS location_subtype, '' AS context,
    CASE WHEN o_orderkey % 50 <> 0 THEN '53.' || (3500 + o_custkey % 600) END AS crime_latitude,
    CASE WHEN o_orderkey % 50 <> 0 THEN '-1.' || (4200 + o_custkey % 1000) END AS crime_longitude,
    CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS crime_street_id,
    CASE WHEN o_orderkey % 50 <> 0 THEN 'On or near ' || (o_custkey % 97) END AS crime_street_name,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS latest_outcome_category,
    CASE WHEN o_orderstatus <> 'O'
      THEN strftime(o_orderdate + to_months(CAST(o_orderkey % 7 AS INT) - 1), '%Y-%m') END AS latest_outcome_date
  FROM orders"""

INT_OUTCOMES = """SELECT 'c-' || l_linestatus AS outcome_category_code, 'Outcome ' || l_linestatus AS outcome_category_name,
    strftime(l_shipdate, '%Y-%m') AS outcome_date,
    CASE WHEN l_linenumber = 1 THEN 'person-' || l_partkey END AS person_id,
    l_orderkey AS crime_id, 'p' || l_orderkey AS crime_persistent_id, l_returnflag AS crime_category,
    'Force' AS crime_location_type, '' AS crime_location_subtype, '' AS crime_context,
    strftime(l_shipdate - to_months(2), '%Y-%m') AS crime_month,
    CASE WHEN l_orderkey % 50 <> 0 THEN '53.' || (3500 + l_suppkey) END AS crime_latitude,
    CASE WHEN l_orderkey % 50 <> 0 THEN '-1.' || (4200 + l_suppkey) END AS crime_longitude,
    CASE WHEN l_orderkey % 50 <> 0 THEN l_suppkey END AS crime_street_id,
    CASE WHEN l_orderkey % 50 <> 0 THEN 'On or near ' || l_suppkey END AS crime_street_name
  FROM lineitem"""

INT_STOPS = f"""SELECT CASE user_id % 3 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' END AS age_range,
    'White' AS officer_defined_ethnicity, event_id % 2 = 0 AS involved_person,
    CAST(NULL AS VARCHAR) AS self_defined_ethnicity,
    CASE WHEN user_id % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender, 'Act 1' AS legislation,
    CASE WHEN event_id % 3 <> 0 THEN event_id % 3 = 1 END AS outcome_linked_to_object_of_search,
    date_trunc('second', ts + to_days(CAST(event_id % 12 * 30 AS INT))) AS stop_search_datetime,
    CASE WHEN event_type <> 'error' THEN event_type || '-' || (user_id % 4) END AS object_of_search,
    CAST(NULL AS BOOLEAN) AS operation,
    {_STOP_OUTCOME} AS outcome,
    'Person search' AS stop_search_type, CAST(NULL AS VARCHAR) AS operation_name,
    event_id % 7 = 0 AS removal_of_more_than_outer_clothing,
    CASE WHEN event_id % 9 <> 0 THEN '53.' || (3500 + user_id % 600) END AS stop_search_latitude,
    CASE WHEN event_id % 9 <> 0 THEN '-1.' || (4200 + user_id % 1000) END AS stop_search_longitude,
    CASE WHEN event_id % 9 <> 0 THEN user_id END AS stop_search_street_id,
    CASE WHEN event_id % 9 <> 0 THEN 'On or near ' || user_id END AS stop_search_street_name,
    CASE WHEN event_id % 4 <> 0 THEN 'bu-' || (event_id % 4) END AS outcome_object_id,
    CASE WHEN event_id % 4 <> 0 THEN 'Recorded' END AS outcome_object_name
  FROM events"""

# --- marts -------------------------------------------------------------------------------

CRIME_MAP = """SELECT crime_id, crime_month, crime_category, crime_latitude, crime_longitude,
    crime_street_name, latest_outcome_category FROM int_crimes"""

TIMINGS = """SELECT crime_month, crime_category, count(*) AS crime_count,
    avg(months_to_outcome) AS avg_months_to_outcome,
    quantile_disc(months_to_outcome, 0.5) AS median_months_to_outcome,
    min(months_to_outcome) AS min_months_to_outcome,
    max(months_to_outcome) AS max_months_to_outcome
  FROM (
    SELECT crime_month, crime_category,
      date_diff('month', strptime(crime_month, '%Y-%m'), strptime(latest_outcome_date, '%Y-%m')) AS months_to_outcome
    FROM int_crimes
    WHERE latest_outcome_date IS NOT NULL AND crime_month IS NOT NULL
  ) base
  WHERE months_to_outcome >= 0
  GROUP BY crime_month, crime_category"""

MIX = """SELECT object_of_search, outcome, stop_search_count,
    CAST(stop_search_count AS DOUBLE) / CAST(sum(stop_search_count) OVER (PARTITION BY object_of_search) AS DOUBLE)
      AS pct_within_object_of_search
  FROM (
    SELECT coalesce(object_of_search, 'Unknown') AS object_of_search, coalesce(outcome, 'Unknown') AS outcome,
      count(*) AS stop_search_count
    FROM int_stops GROUP BY 1, 2
  ) g"""

TRENDS = """SELECT stop_search_month, object_of_search, stop_search_count,
    CAST(stop_search_count AS DOUBLE) / CAST(sum(stop_search_count) OVER (PARTITION BY stop_search_month) AS DOUBLE)
      AS pct_of_month_total
  FROM (
    SELECT strftime(stop_search_datetime, '%Y-%m') AS stop_search_month,
      coalesce(object_of_search, 'Unknown') AS object_of_search, count(*) AS stop_search_count
    FROM int_stops GROUP BY 1, 2
  ) g"""

POINTS = """SELECT crime_id, crime_month, crime_category,
    try_cast(crime_latitude AS DOUBLE) AS lat, try_cast(crime_longitude AS DOUBLE) AS lon,
    crime_street_name, latest_outcome_category,
    concat_ws(' - ', crime_category, crime_street_name) AS tooltip
  FROM crime_map
  WHERE crime_latitude IS NOT NULL AND crime_longitude IS NOT NULL
    AND regexp_full_match(trim(crime_latitude), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
    AND regexp_full_match(trim(crime_longitude), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
    AND isfinite(try_cast(crime_latitude AS DOUBLE)) AND isfinite(try_cast(crime_longitude AS DOUBLE))"""

TOP = """SELECT object_of_search, CAST(sum(stop_search_count) AS BIGINT) AS total_searches
  FROM mix GROUP BY object_of_search ORDER BY total_searches DESC, object_of_search LIMIT 10"""

_CTES = {
    "raw_stops": RAW_STOPS,
    "int_crimes": INT_CRIMES,
    "int_stops": INT_STOPS,
    "crime_map": CRIME_MAP,
    "timings": TIMINGS,
    "mix": MIX,
    "trends": TRENDS,
    "points": POINTS,
    "top": TOP,
}

_DEPENDS = {
    "raw_stops": [],
    "int_crimes": [],
    "int_stops": [],
    "crime_map": ["int_crimes"],
    "timings": ["int_crimes"],
    "mix": ["int_stops"],
    "trends": ["int_stops"],
    "points": ["crime_map"],
    "top": ["mix"],
}


def _q(body: str, *needs: str) -> str:
    """``body`` with the CTEs it needs (and theirs), in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPENDS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in needs:
        visit(n)
    return _with(body, **{n: _CTES[n] for n in order})


def _weighted(keys: str, where: str = "") -> str:
    return f"""SELECT {keys},
    CAST(sum(crime_count) AS BIGINT) AS total_crimes,
    CAST(sum(CAST(avg_months_to_outcome * crime_count AS DECIMAL(38,9))) AS DOUBLE)
      / CAST(sum(crime_count) AS DOUBLE) AS avg_months_to_outcome,
    avg(median_months_to_outcome) AS median_months_to_outcome,
    min(min_months_to_outcome) AS min_months_to_outcome,
    max(max_months_to_outcome) AS max_months_to_outcome
  FROM timings {where} GROUP BY {keys}"""


def _exact_mean(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(38,9))) AS DOUBLE) / CAST(count({c}) AS DOUBLE)"


# centre 53.3811, -1.4701 with 0.03 and 0.05 degrees around it, in doubles
_LAT_MIN, _LAT_MAX = 53.3811 - 0.03, 53.3811 + 0.03
_LNG_MIN, _LNG_MAX = -1.4701 - 0.05, -1.4701 + 0.05

_SPINE = """SELECT strftime(unnest(generate_series(first_month, last_month, INTERVAL 1 MONTH)), '%Y-%m') AS ingest_year_month
  FROM (
    SELECT CASE WHEN day(s) = 1 THEN date_trunc('month', s) ELSE date_trunc('month', s) + INTERVAL 1 MONTH END AS first_month,
      date_trunc('month', a) - INTERVAL 1 MONTH AS last_month
    FROM (SELECT min(o_orderdate) AS s, max(o_orderdate) AS a FROM orders) b
  ) f"""

_LOADED = f"""SELECT DISTINCT 'crime_data' AS dataset, strftime(o_orderdate, '%Y-%m') AS ingest_year_month FROM orders
  UNION SELECT DISTINCT 'outcome_data', strftime(l_shipdate, '%Y-%m') FROM lineitem
  UNION SELECT DISTINCT 'stop_and_search_data', substr({_STOP_DATETIME}, 1, 7) FROM events"""

_RAW_CRIME_COLS = (
    "category, context, id, location, location_subtype, location_type, month, outcome_status, "
    "persistent_id, ingest_year_month"
)

ORACLE_SQL: dict[str, str] = {
    "stg_crimes": STG_CRIMES,
    "stg_outcomes": STG_OUTCOMES,
    "stg_stop_search": STG_STOPS,
    "int_crimes": INT_CRIMES,
    "int_outcomes": INT_OUTCOMES,
    "int_stop_search": INT_STOPS,
    "mart_crime_map": _q("SELECT * FROM crime_map", "crime_map"),
    "mart_outcome_timings": _q("SELECT * FROM timings", "timings"),
    "mart_outcome_mix": _q("SELECT * FROM mix", "mix"),
    "mart_reason_trends": _q("SELECT * FROM trends", "trends"),
    "outcome_summary": _q(_weighted("crime_category", "WHERE crime_category IS NOT NULL"), "timings"),
    "outcome_trend": _q(
        """SELECT crime_month, crime_category, total_crimes AS crime_count, avg_months_to_outcome FROM ("""
        + _weighted("crime_month, crime_category", "WHERE crime_month IS NOT NULL AND crime_category IS NOT NULL")
        + ") w",
        "timings",
    ),
    "map_points": _q("SELECT * FROM points", "points"),
    "map_summary": _q(
        """SELECT crime_month, crime_category, count(crime_id) AS sum_crimes FROM points
        WHERE crime_month IS NOT NULL AND crime_category IS NOT NULL GROUP BY 1, 2""",
        "points",
    ),
    "map_extent": _q(
        f"""SELECT min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon,
        {_exact_mean('lat')} AS center_lat, {_exact_mean('lon')} AS center_lon FROM points""",
        "points",
    ),
    "kpis": _q(
        """SELECT (SELECT count(*) FROM points) AS total_crimes,
        (SELECT CAST(coalesce(sum(stop_search_count), 0) AS BIGINT) FROM trends) AS total_stop_searches,
        (SELECT count(DISTINCT crime_month) FROM points) AS months_available""",
        "points",
        "trends",
    ),
    "kpis_month": _q(
        f"""SELECT (SELECT count(*) FROM points WHERE crime_month = '{SELECTED_MONTH}') AS total_crimes,
        (SELECT CAST(coalesce(sum(stop_search_count), 0) AS BIGINT) FROM trends
          WHERE stop_search_month = '{SELECTED_MONTH}') AS total_stop_searches,
        (SELECT count(DISTINCT crime_month) FROM points) AS months_available""",
        "points",
        "trends",
    ),
    "month_options": _q("SELECT DISTINCT crime_month FROM points WHERE crime_month IS NOT NULL", "points"),
    "top_objects": _q("SELECT * FROM top", "top"),
    "outcome_mix_top_objects": _q(
        "SELECT * FROM mix WHERE object_of_search IN (SELECT object_of_search FROM top)", "top"
    ),
    "outcome_heatmap": _q(
        """SELECT t.object_of_search, o.outcome,
    coalesce(m.pct_within_object_of_search, 0.0) AS pct_within_object_of_search
  FROM top t
  CROSS JOIN (SELECT DISTINCT outcome FROM mix WHERE object_of_search IN (SELECT object_of_search FROM top)) o
  LEFT JOIN mix m ON m.object_of_search = t.object_of_search AND m.outcome = o.outcome""",
        "top",
    ),
    "reason_trend_sorted": _q("SELECT * FROM trends", "trends"),
    "month_filter": _q(f"SELECT * FROM timings WHERE crime_month = '{SELECTED_MONTH}'", "timings"),
    "map_summary_month": _q(
        f"""SELECT crime_month, crime_category, count(crime_id) AS sum_crimes FROM points
        WHERE crime_month = '{SELECTED_MONTH}' AND crime_category IS NOT NULL GROUP BY 1, 2""",
        "points",
    ),
    "outcome_summary_month": _q(
        _weighted("crime_category", f"WHERE crime_category IS NOT NULL AND crime_month = '{SELECTED_MONTH}'"),
        "timings",
    ),
    "reason_trend_month": _q(f"SELECT * FROM trends WHERE stop_search_month = '{SELECTED_STOP_MONTH}'", "trends"),
    "geo_grid": _q(
        f"""SELECT CAST(floor(lat / {_dbl(0.01)}) AS BIGINT) AS cell_lat, CAST(floor(lon / {_dbl(0.01)}) AS BIGINT) AS cell_lon,
        count(*) AS points, {_exact_mean('lat')} AS center_lat, {_exact_mean('lon')} AS center_lon
      FROM points GROUP BY 1, 2""",
        "points",
    ),
    "bbox_filter": _q(
        f"""SELECT * FROM crime_map
      WHERE try_cast(crime_latitude AS DOUBLE) BETWEEN {_dbl(_LAT_MIN)} AND {_dbl(_LAT_MAX)}
        AND try_cast(crime_longitude AS DOUBLE) BETWEEN {_dbl(_LNG_MIN)} AND {_dbl(_LNG_MAX)}""",
        "crime_map",
    ),
    "month_spine": _SPINE,
    "batch_coverage": _with(
        """SELECT d.dataset, s.ingest_year_month
  FROM spine s CROSS JOIN (VALUES ('crime_data'), ('outcome_data'), ('stop_and_search_data')) d(dataset)
  WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.dataset = d.dataset AND l.ingest_year_month = s.ingest_year_month)""",
        spine=_SPINE,
        loaded=_LOADED,
    ),
    "json_roundtrip_scan": INT_CRIMES,
    "raw_load": RAW_STOPS,
    "month_replace": f"""SELECT category, CASE WHEN ingest_year_month = '{RELOAD_MONTH}' THEN 'reloaded' ELSE context END AS context,
    id, location, location_subtype, location_type, month, outcome_status, persistent_id, ingest_year_month
  FROM ({RAW_CRIMES}) r""",
    "month_replace_empty_batch": f"SELECT {_RAW_CRIME_COLS} FROM ({RAW_CRIMES}) r",
    "named_source": f"SELECT {_RAW_CRIME_COLS} FROM ({RAW_CRIMES}) r",
    "load_audit": f"""SELECT 'crime_data' AS dataset, strftime(o_orderdate, '%Y-%m') AS ingest_year_month,
    count(*) AS loaded_rows, CAST(0 AS BIGINT) AS bad_load_times FROM orders GROUP BY 1, 2
  UNION ALL SELECT 'outcome_data', strftime(l_shipdate, '%Y-%m'), count(*), 0 FROM lineitem GROUP BY 1, 2
  UNION ALL SELECT 'stop_and_search_data', substr({_STOP_DATETIME}, 1, 7), count(*), 0 FROM events GROUP BY 1, 2""",
    "published_views": """SELECT strftime(o_orderdate, '%Y-%m') AS crime_month, count(*) AS crimes,
    count_if(o_orderstatus <> 'O' AND o_orderkey % 7 >= 1) AS timed_crimes FROM orders GROUP BY 1""",
    "mart_scan_month": _q(f"SELECT * FROM crime_map WHERE crime_month = '{SELECTED_MONTH}'", "crime_map"),
    "dq_not_null": _q(
        """SELECT 'mart_crime_map' AS model, 'not_null' AS check_name, 'crime_id' AS column_name,
          count_if(crime_id IS NULL) AS failures FROM crime_map
      UNION ALL SELECT 'mart_crime_map', 'not_null', 'crime_latitude', count_if(crime_latitude IS NULL) FROM crime_map
      UNION ALL SELECT 'mart_crime_map', 'not_null', 'crime_longitude', count_if(crime_longitude IS NULL) FROM crime_map
      UNION ALL SELECT 'mart_outcome_timings', 'not_null', 'crime_month', count_if(crime_month IS NULL) FROM timings
      UNION ALL SELECT 'mart_outcome_timings', 'not_null', 'crime_category', count_if(crime_category IS NULL) FROM timings""",
        "crime_map",
        "timings",
    ),
    "dq_unique": _with(
        """SELECT 'mart_crime_map' AS model, crime_id, count(*) AS occurrences FROM cm
        WHERE crime_id IS NOT NULL GROUP BY crime_id HAVING count(*) > 1
      UNION ALL SELECT 'int_outcomes', crime_id, count(*) FROM io
        WHERE crime_id IS NOT NULL GROUP BY crime_id HAVING count(*) > 1""",
        cm=f"SELECT crime_id FROM ({INT_CRIMES}) x",
        io=f"SELECT crime_id FROM ({INT_OUTCOMES}) y",
    ),
    "dq_report": _q(
        """SELECT 'int_crimes' AS model, 'type' AS check_name, 'crime_month' AS column_name,
          count_if(crime_month IS NOT NULL AND try_strptime(crime_month, '%Y-%m') IS NULL) AS failures FROM int_crimes
      UNION ALL SELECT 'int_crimes', 'type', 'latest_outcome_date',
          count_if(latest_outcome_date IS NOT NULL AND try_strptime(latest_outcome_date, '%Y-%m') IS NULL) FROM int_crimes
      UNION ALL SELECT 'int_crimes', 'type', 'crime_latitude',
          count_if(crime_latitude IS NOT NULL AND try_cast(crime_latitude AS DOUBLE) IS NULL) FROM int_crimes
      UNION ALL SELECT 'int_crimes', 'type', 'crime_longitude',
          count_if(crime_longitude IS NOT NULL AND try_cast(crime_longitude AS DOUBLE) IS NULL) FROM int_crimes
      UNION ALL SELECT 'mart_crime_map', 'not_null', 'crime_id', count_if(crime_id IS NULL) FROM crime_map
      UNION ALL SELECT 'mart_crime_map', 'not_null', 'crime_latitude', count_if(crime_latitude IS NULL) FROM crime_map
      UNION ALL SELECT 'mart_crime_map', 'not_null', 'crime_longitude', count_if(crime_longitude IS NULL) FROM crime_map
      UNION ALL SELECT 'mart_crime_map', 'unique', 'crime_id', count(*) FROM (
          SELECT crime_id FROM crime_map WHERE crime_id IS NOT NULL GROUP BY crime_id HAVING count(*) > 1) d
      UNION ALL SELECT 'mart_outcome_timings', 'not_null', 'crime_month', count_if(crime_month IS NULL) FROM timings
      UNION ALL SELECT 'mart_outcome_timings', 'not_null', 'crime_category', count_if(crime_category IS NULL) FROM timings
      UNION ALL SELECT 'stop_and_search_data', 'type', 'datetime',
          count_if(datetime IS NOT NULL AND try_cast(datetime AS TIMESTAMPTZ) IS NULL) FROM raw_stops
      UNION ALL SELECT 'int_crimes', 'schema', column_name, 0 FROM (VALUES """
        + ", ".join(f"('{c}')" for c in INT_CRIMES_COLUMNS)
        + """) v(column_name)""",
        "int_crimes",
        "crime_map",
        "timings",
        "raw_stops",
    ),
}

_COVERAGE = _with(
    """SELECT d.dataset AS model, 'missing_batch' AS check_name, 'ingest_year_month' AS column_name,
    (SELECT count(*) FROM spine s
      WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.dataset = d.dataset AND l.ingest_year_month = s.m)) AS failures
  FROM (VALUES ('crime_data'), ('outcome_data'), ('stop_and_search_data')) d(dataset)""",
    loaded=_LOADED,
    spine="""SELECT strftime(unnest(generate_series(strptime(f, '%Y-%m'), strptime(l, '%Y-%m'), INTERVAL 1 MONTH)), '%Y-%m') AS m
  FROM (SELECT min(ingest_year_month) AS f, max(ingest_year_month) AS l FROM loaded) b""",
)

# columns with a documented type, as stored by the build
_TYPED = {
    "int_outcomes": """outcome_category_code outcome_category_name outcome_date person_id crime_id crime_persistent_id
        crime_category crime_location_type crime_location_subtype crime_context crime_month crime_latitude
        crime_longitude crime_street_id crime_street_name""",
    "int_stop_search": """age_range officer_defined_ethnicity involved_person self_defined_ethnicity gender
        legislation outcome_linked_to_object_of_search stop_search_datetime object_of_search operation outcome
        stop_search_type operation_name removal_of_more_than_outer_clothing stop_search_latitude
        stop_search_longitude stop_search_street_id stop_search_street_name outcome_object_id outcome_object_name""",
    "mart_outcome_mix": "object_of_search outcome stop_search_count pct_within_object_of_search",
    "mart_reason_trends": "stop_search_month object_of_search stop_search_count pct_of_month_total",
}
_CONTRACT = "SELECT model, 'schema' AS check_name, column_name, 0 AS failures FROM (VALUES " + ", ".join(
    f"('{model}', '{c}')" for model, columns in _TYPED.items() for c in columns.split()
) + ") v(model, column_name)"

# --- many areas, zooms, footers, conformance ------------------------------------------------

_AREAS = f"""SELECT n_name AS area,
    {_dbl(53.35)} + {_dbl(0.0024)} * n_nationkey AS lat, {_dbl(-1.42)} - {_dbl(0.004)} * (n_nationkey * 7 % 25) AS lng,
    {_dbl(0.002)} * (1 + n_nationkey % 4) AS lat_range, {_dbl(0.004)} * (1 + n_nationkey % 3) AS lng_range
  FROM nation"""
_INSIDE = """FROM crime_map m JOIN areas a
    ON try_cast(m.crime_latitude AS DOUBLE) BETWEEN a.lat - a.lat_range AND a.lat + a.lat_range
   AND try_cast(m.crime_longitude AS DOUBLE) BETWEEN a.lng - a.lng_range AND a.lng + a.lng_range"""


def _with_areas(body: str) -> str:
    return f"""WITH areas AS ({_AREAS}), crime_map AS (SELECT crime_id, crime_month, crime_category, crime_latitude,
    crime_longitude FROM ({INT_CRIMES}) x) {body} {_INSIDE}"""


ORACLE_SQL["areas_join"] = _with_areas("SELECT a.area, m.crime_id, m.crime_month, m.crime_latitude, m.crime_longitude")
ORACLE_SQL["area_summary"] = _with_areas("SELECT a.area, m.crime_category, count(*) AS crimes") + " GROUP BY 1, 2"


def _zoomed(zoom: int) -> str:
    """Cells of one zoom, their numbers put together bit by bit from row and column."""
    row, column = f"floor((lat + 90.0) / 180.0 * {1 << zoom})", f"floor((lon + 180.0) / 360.0 * {1 << zoom})"
    bits = " + ".join(
        f"(((CAST({row} AS BIGINT) >> {b}) & 1) << {2 * b + 1}) + (((CAST({column} AS BIGINT) >> {b}) & 1) << {2 * b})"
        for b in range(zoom)
    )
    return f"""SELECT {zoom} AS zoom, {bits} AS cell, count(*) AS points, {_exact_mean('lat')} AS center_lat,
      {_exact_mean('lon')} AS center_lon FROM points GROUP BY 2"""


ORACLE_SQL["geo_clusters"] = _q(" UNION ALL ".join(f"SELECT * FROM ({_zoomed(z)}) z{z}" for z in (8, 10, 12, 14, 16)), "points")
ORACLE_SQL["loaded_batches"] = f"""SELECT 'crime_data' AS dataset, strftime(o_orderdate, '%Y-%m') AS ingest_year_month,
    count(*) AS loaded_rows, count(*) AS timed_rows FROM orders GROUP BY 1, 2
  UNION ALL SELECT 'outcome_data', strftime(l_shipdate, '%Y-%m'), count(*), count(*) FROM lineitem GROUP BY 1, 2
  UNION ALL SELECT 'stop_and_search_data', substr({_STOP_DATETIME}, 1, 7), count(*), count(*) FROM events GROUP BY 1, 2"""


def _conformance(crime_street: str, crime_text: str, outcome_id: str, outcome_street: str, stop_time: str) -> str:
    """A row per documented column and per text column; all fit but those given."""
    columns = {"int_crimes": INT_CRIMES_COLUMNS, "int_outcomes": _TYPED["int_outcomes"].split(), "int_stop_search": _TYPED["int_stop_search"].split()}
    texts = {"int_crimes": ["location", "outcome_status"], "int_outcomes": ["category", "crime"], "int_stop_search": ["location", "outcome_object"]}
    faults = {
        ("int_crimes", "conforms", "crime_street_id"): crime_street,
        ("int_crimes", "json", "location"): crime_text,
        ("int_outcomes", "conforms", "crime_id"): outcome_id,
        ("int_outcomes", "conforms", "crime_street_id"): outcome_street,
        ("int_stop_search", "conforms", "stop_search_datetime"): stop_time,
    }
    rows = [(m, "json", c) for m, cs in texts.items() for c in cs] + [(m, "conforms", c) for m, cs in columns.items() for c in cs]
    return " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{k}' AS check_name, '{c}' AS column_name, CAST({faults.get((m, k, c), '0')} AS BIGINT) AS failures"
        for m, k, c in rows
    )


ORACLE_SQL["dq_conformance"] = _conformance(
    "(SELECT count(*) FROM orders WHERE o_orderkey % 50 <> 0 AND o_orderkey % 11 = 0)",
    "(SELECT count(*) FROM orders WHERE o_orderkey % 50 <> 0 AND o_orderkey % 13 = 0 AND o_orderkey % 11 <> 0)",
    "(SELECT count(*) FROM lineitem WHERE l_orderkey % 7 = 0)",
    "(SELECT count(*) FROM lineitem WHERE l_orderkey % 7 = 0 AND l_orderkey % 50 <> 0)",
    "(SELECT count(*) FROM events WHERE event_id % 9 <> 0 AND user_id % 11 = 0)",
)
ORACLE_SQL["dq_report"] += " UNION ALL " + _conformance("0", "0", "0", "0", "0")

ORACLE_SQL["lasting_views"] = " UNION ALL ".join(
    f"SELECT '{m}' AS model, count(*) AS n_rows FROM ({ORACLE_SQL[m]}) v"
    for m in (
        "stg_crimes", "stg_outcomes", "stg_stop_search", "int_crimes", "int_outcomes", "int_stop_search",
        "mart_crime_map", "mart_outcome_timings", "mart_outcome_mix", "mart_reason_trends",
    )
)

ORACLE_SQL["build_report"] = f"""SELECT * FROM ({ORACLE_SQL['dq_report']}) r UNION ALL SELECT * FROM ({_COVERAGE}) c
  UNION ALL SELECT * FROM ({_CONTRACT}) t"""
