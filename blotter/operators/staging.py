"""Staging: rename and cast the raw columns. Nested JSON text passes through untouched.

``strict=True`` uses ANSI casts, which raise on text that does not fit the type (a bad
timestamp stops the build, as the warehouse would); ``strict=False`` uses ``try_cast`` and
yields null instead, for exploratory runs over dirty batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


# (source column, target type or None to pass through, output name), in model order
_CRIMES = [
    ("category", "string", "crime_category"),
    ("persistent_id", "string", "persistent_id"),
    ("location_subtype", "string", "location_subtype"),
    ("id", "bigint", "crime_id"),
    ("location", None, "location"),
    ("context", "string", "context"),
    ("month", "string", "crime_month"),
    ("location_type", "string", "location_type"),
    ("outcome_status", None, "outcome_status"),
]
_OUTCOMES = [
    ("category", None, "category"),
    ("date", "string", "outcome_date"),
    ("person_id", "string", "person_id"),
    ("crime", None, "crime"),
]
_STOPS = [
    ("age_range", "string", "age_range"),
    ("officer_defined_ethnicity", "string", "officer_defined_ethnicity"),
    ("involved_person", "boolean", "involved_person"),
    ("self_defined_ethnicity", "string", "self_defined_ethnicity"),
    ("gender", "string", "gender"),
    ("legislation", "string", "legislation"),
    ("outcome_linked_to_object_of_search", "boolean", "outcome_linked_to_object_of_search"),
    ("datetime", "timestamp", "stop_search_datetime"),
    ("outcome_object", None, "outcome_object"),
    ("location", None, "location"),
    ("object_of_search", "string", "object_of_search"),
    ("operation", "boolean", "operation"),
    ("outcome", "string", "outcome"),
    ("type", "string", "stop_search_type"),
    ("operation_name", "string", "operation_name"),
    ("removal_of_more_than_outer_clothing", "boolean", "removal_of_more_than_outer_clothing"),
]


def _stage(raw: DataFrame, spec: list[tuple[str, str | None, str]], strict: bool, keep: tuple[str, ...]) -> DataFrame:
    cast = "CAST" if strict else "TRY_CAST"
    return raw.selectExpr(
        *[f"`{src}` AS `{out}`" if t is None else f"{cast}(`{src}` AS {t}) AS `{out}`" for src, t, out in spec],
        *[f"`{k}`" for k in keep],
    )


# ``keep`` carries extra raw columns through unchanged (the build keeps the batch month so
# the flattened layer can be stored by month); the model columns come first.


def stg_crimes(raw: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    return _stage(raw, _CRIMES, strict, keep)


def stg_outcomes(raw: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    return _stage(raw, _OUTCOMES, strict, keep)


def stg_stop_search(raw: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    return _stage(raw, _STOPS, strict, keep)


def model_sql(model: str, raw: str) -> str:
    """The staged model as SQL text over the table ``raw``, with strict casts."""
    spec = {"stg_crimes": _CRIMES, "stg_outcomes": _OUTCOMES, "stg_stop_search": _STOPS}[model]
    chosen = ", ".join(f"`{src}` AS `{out}`" if t is None else f"CAST(`{src}` AS {t}) AS `{out}`" for src, t, out in spec)
    return f"SELECT {chosen} FROM {raw}"
