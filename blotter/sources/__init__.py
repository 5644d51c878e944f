from blotter.sources.fixtures import api_crimes, api_outcomes, api_records, api_stops, read_table
from blotter.sources.landing import read_landing, write_landing
from blotter.sources.raw import loaded_batches, raw_select, read_raw, replace_months

__all__ = [
    "api_crimes",
    "api_outcomes",
    "api_records",
    "api_stops",
    "loaded_batches",
    "raw_select",
    "read_landing",
    "read_raw",
    "read_table",
    "replace_months",
    "write_landing",
]
