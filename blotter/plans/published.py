"""Views that outlive the session: every model as SQL text, created in a schema of the catalog.

A view holds text, not a plan, so any later session that has the catalog answers from it, over
whatever the raw tables hold then. With a metastore the catalog outlives the application as well.
The text reads each model from the view below it, as the models are composed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blotter.operators import flatten, staging
from blotter.operators.marts import crime_map

_STAGED = {"crime_data": "stg_crimes", "outcome_data": "stg_outcomes", "stop_and_search_data": "stg_stop_search"}
_FLAT = {"int_crimes": "stg_crimes", "int_outcomes": "stg_outcomes", "int_stop_search": "stg_stop_search"}

_TIMINGS = """
SELECT crime_month, crime_category, sum(n) AS crime_count,
       CAST(sum(span * n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS avg_months_to_outcome,
       min(span) FILTER (WHERE 2 * up_to >= total) AS median_months_to_outcome,
       min(span) AS min_months_to_outcome, max(span) AS max_months_to_outcome
FROM (
  SELECT *, sum(n) OVER (PARTITION BY crime_month, crime_category ORDER BY span) AS up_to,
         sum(n) OVER (PARTITION BY crime_month, crime_category) AS total
  FROM (
    SELECT crime_month, crime_category,
           floor(months_between(to_date(latest_outcome_date), to_date(crime_month, 'yyyy-MM'))) AS span, count(*) AS n
    FROM {schema}.int_crimes WHERE latest_outcome_date IS NOT NULL AND crime_month IS NOT NULL GROUP BY 1, 2, 3
  ) WHERE span >= 0
) GROUP BY crime_month, crime_category
"""
_MIX = """
SELECT object_of_search, outcome, stop_search_count,
       CAST(stop_search_count AS DOUBLE) / CAST(sum(stop_search_count) OVER (PARTITION BY object_of_search) AS DOUBLE)
         AS pct_within_object_of_search
FROM (SELECT coalesce(object_of_search, 'Unknown') AS object_of_search, coalesce(outcome, 'Unknown') AS outcome,
             count(*) AS stop_search_count FROM {schema}.int_stop_search GROUP BY 1, 2)
"""
_TRENDS = """
SELECT stop_search_month, object_of_search, stop_search_count,
       CAST(stop_search_count AS DOUBLE) / CAST(sum(stop_search_count) OVER (PARTITION BY stop_search_month) AS DOUBLE)
         AS pct_of_month_total
FROM (SELECT date_format(stop_search_datetime, 'yyyy-MM') AS stop_search_month,
             coalesce(object_of_search, 'Unknown') AS object_of_search, count(*) AS stop_search_count
      FROM {schema}.int_stop_search GROUP BY 1, 2)
"""


def models_sql(raw_tables: dict[str, str], schema: str, map_columns: list[str]) -> dict[str, str]:
    """Model -> SQL text, in dependency order, over raw tables named in the catalog."""
    out = {model: staging.model_sql(model, raw_tables[ds]) for ds, model in _STAGED.items()}
    out |= {model: flatten.model_sql(model, f"{schema}.{staged}") for model, staged in _FLAT.items()}
    chosen = ", ".join(f"`{c}`" for c in map_columns)
    out["mart_crime_map"] = f"SELECT {chosen} FROM {schema}.int_crimes"
    for model, text in (("mart_outcome_timings", _TIMINGS), ("mart_outcome_mix", _MIX), ("mart_reason_trends", _TRENDS)):
        out[model] = text.format(schema=schema)
    return out


def publish_views(spark: SparkSession, raw_tables: dict[str, str], schema: str) -> list[str]:
    """Create or replace a view for every model in ``schema``; returns their names. Like the strict
    models, a view raises on text that a cast does not take."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    flat = spark.createDataFrame([], ", ".join(f"`{out}` string" for _, out in flatten.MODELS["int_crimes"][1]))
    texts = models_sql(raw_tables, schema, crime_map(flat).columns)
    for model, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{model} AS {text}")
    return list(texts)


def view(spark: SparkSession, schema: str, model: str) -> DataFrame:
    """A published view by name, in whatever session."""
    return spark.table(f"{schema}.{model}")
