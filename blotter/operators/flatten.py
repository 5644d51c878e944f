"""Flatten: parse the nested JSON text of the staged rows into typed atomic columns.

``from_json`` is permissive: malformed text gives a struct of nulls (the row is kept),
null or empty text gives a null struct, a wrongly typed field gives null for that field only.
Each JSON column is parsed by one ``from_json`` per projection, and Catalyst prunes the
parse schema to the fields a query reads. A filter on parsed fields is pushed below the
parse with the expression inlined, so filtered views may parse a row more than once; the
build stores this layer as parquet, after which filters are plain pushed-down predicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from blotter.schemas import CRIME_REF, LOCATION, OUTCOME_CATEGORY, OUTCOME_OBJECT, OUTCOME_STATUS


def parse_json(df: DataFrame, specs: dict[str, tuple[str, T.StructType]]) -> DataFrame:
    """Add one parsed struct column per ``{new_name: (text_column, schema)}``."""
    return df.selectExpr("*", *[f"from_json(`{src}`, '{schema.simpleString()}') AS `{name}`" for name, (src, schema) in specs.items()])


def _flat(parsed: DataFrame, columns: list[tuple[str, str]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Select (expression, output name) pairs, then the ``keep`` columns unchanged."""
    return parsed.selectExpr(*[e if e == out else f"{e} AS `{out}`" for e, out in columns], *[f"`{k}`" for k in keep])


_LOCATION = [("latitude", "latitude"), ("longitude", "longitude"), ("street.id", "street_id"), ("street.name", "street_name")]
_PASS = [
    "age_range",
    "officer_defined_ethnicity",
    "involved_person",
    "self_defined_ethnicity",
    "gender",
    "legislation",
    "outcome_linked_to_object_of_search",
    "stop_search_datetime",
    "object_of_search",
    "operation",
    "outcome",
    "stop_search_type",
    "operation_name",
    "removal_of_more_than_outer_clothing",
]
_CRIME_PASS = ["crime_id", "persistent_id", "crime_category", "crime_month", "location_type", "location_subtype", "context"]
_CRIME_FIELDS = ["persistent_id", "category", "location_type", "location_subtype", "context", "month"]

# Per model the parsed columns (new name -> text column, shape) and its columns as
# (expression, name), in model order.
MODELS: dict[str, tuple[dict[str, tuple[str, T.StructType]], list[tuple[str, str]]]] = {
    "int_crimes": (
        {"loc": ("location", LOCATION), "oc": ("outcome_status", OUTCOME_STATUS)},
        [(c, c) for c in _CRIME_PASS]
        + [(f"loc.{f}", f"crime_{c}") for f, c in _LOCATION]
        + [("oc.category", "latest_outcome_category"), ("oc.date", "latest_outcome_date")],
    ),
    "int_outcomes": (
        {"cat": ("category", OUTCOME_CATEGORY), "cr": ("crime", CRIME_REF)},
        [("cat.code", "outcome_category_code"), ("cat.name", "outcome_category_name")]
        + [(c, c) for c in ("outcome_date", "person_id")]
        + [("cr.id", "crime_id")]
        + [(f"cr.{c}", f"crime_{c}") for c in _CRIME_FIELDS]
        + [(f"cr.location.{f}", f"crime_{c}") for f, c in _LOCATION],
    ),
    "int_stop_search": (
        {"loc": ("location", LOCATION), "oo": ("outcome_object", OUTCOME_OBJECT)},
        [(c, c) for c in _PASS]
        + [(f"loc.{f}", f"stop_search_{c}") for f, c in _LOCATION]
        + [("oo.id", "outcome_object_id"), ("oo.name", "outcome_object_name")],
    ),
}


def _flattened(stg: DataFrame, model: str, keep: tuple[str, ...]) -> DataFrame:
    specs, columns = MODELS[model]
    return _flat(parse_json(stg, specs), columns, keep)


def int_crimes(stg: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return _flattened(stg, "int_crimes", keep)


def int_outcomes(stg: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return _flattened(stg, "int_outcomes", keep)


def int_stop_search(stg: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return _flattened(stg, "int_stop_search", keep)


def model_sql(model: str, staged: str) -> str:
    """The model as SQL text over the table or view ``staged``."""
    specs, columns = MODELS[model]
    parsed = ", ".join(f"from_json(`{src}`, '{shape.simpleString()}') AS `{name}`" for name, (src, shape) in specs.items())
    chosen = ", ".join(f"{e} AS `{out}`" for e, out in columns)
    return f"SELECT {chosen} FROM (SELECT *, {parsed} FROM {staged})"
