"""Schemas of the three incident datasets and their registry.

Every schema is explicit. Letting the JSON reader infer types breaks on months where a
nested field is always null (it becomes a string) or a column is missing altogether, so the
landing reader, the raw tables and the JSON parsers all use the types below.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
B = T.BooleanType()

# --- nested shapes, as sent by the API and parsed from raw text ----------------------

STREET = T.StructType([T.StructField("id", L), T.StructField("name", S)])
LOCATION = T.StructType(
    [T.StructField("latitude", S), T.StructField("longitude", S), T.StructField("street", STREET)]
)
OUTCOME_STATUS = T.StructType([T.StructField("category", S), T.StructField("date", S)])
OUTCOME_CATEGORY = T.StructType([T.StructField("code", S), T.StructField("name", S)])
CRIME_REF = T.StructType(
    [
        T.StructField("id", L),
        T.StructField("persistent_id", S),
        T.StructField("category", S),
        T.StructField("location_type", S),
        T.StructField("location_subtype", S),
        T.StructField("context", S),
        T.StructField("month", S),
        T.StructField("location", LOCATION),
    ]
)
OUTCOME_OBJECT = T.StructType([T.StructField("id", S), T.StructField("name", S)])

# --- raw tables: flat, nested values kept as JSON text -------------------------------

MONTH_COL = "ingest_year_month"
LOADED_AT = "loaded_at"
CORRUPT_COL = "_corrupt_record"
LANDING_PARTITION = "date"


@dataclass(frozen=True)
class Dataset:
    """One API dataset: raw column types (in table order) and per-column load transforms.

    ``transforms`` holds SQL expressions over the landing record; columns without one are
    taken as they are. ``nested`` lists the columns that arrive as JSON objects.
    ``landing_key`` names the month folders of the landing zone (``<key>=<yyyy-MM>``); it
    must differ from every record field, since a folder value would shadow a field of the
    same name. ``cluster_by`` orders rows inside each month's files, so parquet row-group
    statistics can skip data on those columns.
    """

    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    transforms: dict[str, str] = field(default_factory=dict)
    nested: tuple[str, ...] = ()
    landing_key: str = LANDING_PARTITION
    cluster_by: tuple[str, ...] = ()

    @property
    def data_columns(self) -> list[str]:
        return [c for c, _ in self.columns if c not in (MONTH_COL, LOADED_AT)]

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t) for c, t in self.columns])

    def landing_schema(self) -> T.StructType:
        """Reader schema: nested objects declared as text, so the reader hands back JSON
        text; broken lines are kept in ``_corrupt_record``. The batch month is not a field:
        it comes from the folder name."""
        fields = [T.StructField(c, t) for c, t in self.columns if c not in (MONTH_COL, LOADED_AT)]
        fields.append(T.StructField(CORRUPT_COL, S))
        return T.StructType(fields)


# Dataset names, column order and types of the raw tables, and the load
# transforms, as the monthly load declares them.
CRIMES = Dataset(
    name="crime_data",
    columns=(
        ("category", S),
        ("context", S),
        ("id", L),
        ("location", S),
        ("location_subtype", S),
        ("location_type", S),
        ("month", S),
        ("outcome_status", S),
        ("persistent_id", S),
        (MONTH_COL, S),
        (LOADED_AT, T.TimestampType()),
    ),
    transforms={"location": "to_json(location)", "outcome_status": "to_json(outcome_status)"},
    nested=("location", "outcome_status"),
    cluster_by=("category",),
)

OUTCOMES = Dataset(
    name="outcome_data",
    columns=(
        ("category", S),
        ("crime", S),
        ("date", S),
        ("person_id", S),
        (MONTH_COL, S),
        (LOADED_AT, T.TimestampType()),
    ),
    transforms={"category": "to_json(category)", "crime": "to_json(crime)"},
    nested=("category", "crime"),
    # outcome records carry their own ``date`` field, so their month folders use another key
    landing_key=MONTH_COL,
)

STOPS = Dataset(
    name="stop_and_search_data",
    columns=(
        ("age_range", S),
        ("officer_defined_ethnicity", S),
        ("involved_person", B),
        ("self_defined_ethnicity", S),
        ("gender", S),
        ("legislation", S),
        ("outcome_linked_to_object_of_search", B),
        ("datetime", S),
        ("outcome_object", S),
        ("location", S),
        ("object_of_search", S),
        ("operation", B),
        ("outcome", S),
        ("type", S),
        ("operation_name", S),
        ("removal_of_more_than_outer_clothing", B),
        (MONTH_COL, S),
        (LOADED_AT, T.TimestampType()),
    ),
    transforms={
        "location": "to_json(location)",
        "outcome_object": "to_json(outcome_object)",
        "outcome": "CAST(outcome AS STRING)",
    },
    nested=("location", "outcome_object"),
    cluster_by=("object_of_search",),
)

DATASETS: dict[str, Dataset] = {d.name: d for d in (CRIMES, OUTCOMES, STOPS)}

# --- documented column types of the models (contract, D3) ----------------------------

# Column types that the models' documentation declares.
INT_CRIMES_TYPES: dict[str, str] = {
    "crime_id": "bigint",
    "persistent_id": "string",
    "crime_category": "string",
    "crime_month": "string",
    "location_type": "string",
    "location_subtype": "string",
    "context": "string",
    "crime_latitude": "string",
    "crime_longitude": "string",
    "crime_street_id": "bigint",
    "crime_street_name": "string",
    "latest_outcome_category": "string",
    "latest_outcome_date": "string",
}

INT_OUTCOMES_TYPES: dict[str, str] = {
    "outcome_category_code": "string",
    "outcome_category_name": "string",
    "outcome_date": "string",
    "person_id": "string",
    "crime_id": "bigint",
    "crime_persistent_id": "string",
    "crime_category": "string",
    "crime_location_type": "string",
    "crime_location_subtype": "string",
    "crime_context": "string",
    "crime_month": "string",
    "crime_latitude": "string",
    "crime_longitude": "string",
    "crime_street_id": "bigint",
    "crime_street_name": "string",
}

INT_STOP_SEARCH_TYPES: dict[str, str] = {
    "age_range": "string",
    "officer_defined_ethnicity": "string",
    "involved_person": "boolean",
    "self_defined_ethnicity": "string",
    "gender": "string",
    "legislation": "string",
    "outcome_linked_to_object_of_search": "boolean",
    "stop_search_datetime": "timestamp",
    "object_of_search": "string",
    "operation": "boolean",
    "outcome": "string",
    "stop_search_type": "string",
    "operation_name": "string",
    "removal_of_more_than_outer_clothing": "boolean",
    "stop_search_latitude": "string",
    "stop_search_longitude": "string",
    "stop_search_street_id": "bigint",
    "stop_search_street_name": "string",
    "outcome_object_id": "string",
    "outcome_object_name": "string",
}

OUTCOME_MIX_TYPES: dict[str, str] = {
    "object_of_search": "string",
    "outcome": "string",
    "stop_search_count": "bigint",
    "pct_within_object_of_search": "double",
}

REASON_TRENDS_TYPES: dict[str, str] = {
    "stop_search_month": "string",
    "object_of_search": "string",
    "stop_search_count": "bigint",
    "pct_of_month_total": "double",
}

#: The stored models with documented types. Staged models are never stored; their columns are
#: those of the flattened models but for the nested text.
MODEL_TYPES: dict[str, dict[str, str]] = {
    "int_crimes": INT_CRIMES_TYPES,
    "int_outcomes": INT_OUTCOMES_TYPES,
    "int_stop_search": INT_STOP_SEARCH_TYPES,
    "mart_outcome_mix": OUTCOME_MIX_TYPES,
    "mart_reason_trends": REASON_TRENDS_TYPES,
}

#: Where each documented column comes from: raw column and path of fields inside its JSON text
#: (empty: the column itself).
MODEL_FIELDS: dict[str, dict[str, tuple[str, str]]] = {
    "int_crimes": {
        "crime_id": ("id", ""),
        "persistent_id": ("persistent_id", ""),
        "crime_category": ("category", ""),
        "crime_month": ("month", ""),
        "location_type": ("location_type", ""),
        "location_subtype": ("location_subtype", ""),
        "context": ("context", ""),
        "crime_latitude": ("location", "latitude"),
        "crime_longitude": ("location", "longitude"),
        "crime_street_id": ("location", "street.id"),
        "crime_street_name": ("location", "street.name"),
        "latest_outcome_category": ("outcome_status", "category"),
        "latest_outcome_date": ("outcome_status", "date"),
    },
    "int_outcomes": {
        "outcome_category_code": ("category", "code"),
        "outcome_category_name": ("category", "name"),
        "outcome_date": ("date", ""),
        "person_id": ("person_id", ""),
        "crime_id": ("crime", "id"),
        "crime_persistent_id": ("crime", "persistent_id"),
        "crime_category": ("crime", "category"),
        "crime_location_type": ("crime", "location_type"),
        "crime_location_subtype": ("crime", "location_subtype"),
        "crime_context": ("crime", "context"),
        "crime_month": ("crime", "month"),
        "crime_latitude": ("crime", "location.latitude"),
        "crime_longitude": ("crime", "location.longitude"),
        "crime_street_id": ("crime", "location.street.id"),
        "crime_street_name": ("crime", "location.street.name"),
    },
    "int_stop_search": {
        **{c: (c, "") for c in INT_STOP_SEARCH_TYPES if c in dict(STOPS.columns)},
        "stop_search_datetime": ("datetime", ""),
        "stop_search_type": ("type", ""),
        "stop_search_latitude": ("location", "latitude"),
        "stop_search_longitude": ("location", "longitude"),
        "stop_search_street_id": ("location", "street.id"),
        "stop_search_street_name": ("location", "street.name"),
        "outcome_object_id": ("outcome_object", "id"),
        "outcome_object_name": ("outcome_object", "name"),
    },
}

#: Shape of the JSON text of each model's raw columns.
MODEL_SHAPES: dict[str, dict[str, T.StructType]] = {
    "int_crimes": {"location": LOCATION, "outcome_status": OUTCOME_STATUS},
    "int_outcomes": {"category": OUTCOME_CATEGORY, "crime": CRIME_REF},
    "int_stop_search": {"location": LOCATION, "outcome_object": OUTCOME_OBJECT},
}
