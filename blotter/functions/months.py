"""Calendar-month expressions. Months travel as ``yyyy-MM`` text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH_FORMAT = "yyyy-MM"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c: str | Column, strict: bool = True) -> Column:
    """``yyyy-MM`` (or a longer ISO date) text -> first day of that month as a date.

    Strict mode raises on malformed text (ANSI cast); tolerant mode gives null.
    """
    col = _col(c)
    return F.to_date(col) if strict else F.try_to_date(col)


def month_start_fmt(c: str | Column, strict: bool = True) -> Column:
    """Exact ``yyyy-MM`` parse: ``2025-01-05`` is rejected (strict) or null (tolerant)."""
    col = _col(c)
    return F.to_date(col, MONTH_FORMAT) if strict else F.try_to_date(col, MONTH_FORMAT)


def months_to_outcome(outcome_month: str | Column, crime_month: str | Column, strict: bool = True) -> Column:
    """Whole months from crime month to outcome month: ``floor(months_between)`` as bigint."""
    return F.floor(
        F.months_between(month_start(outcome_month, strict), month_start_fmt(crime_month, strict))
    )


def month_of(ts: str | Column) -> Column:
    """Month text of a timestamp in the session time zone (the pipeline pins UTC)."""
    return F.date_format(_col(ts), MONTH_FORMAT)


def month_filter(df: DataFrame, column: str, month: str | None = None) -> DataFrame:
    """Keep one month, or everything when ``month`` is None or the ``All`` sentinel.

    A plain equality, so on a parquet mart it reaches the scan as a pushed filter (or a
    partition filter when the mart is partitioned by month).
    """
    if month is None or month == "All":
        return df
    return df.where(F.col(column) == F.lit(month))


def month_spine(bounds: DataFrame, start_col: str = "start", asof_col: str = "asof") -> DataFrame:
    """Complete months from ``start`` up to the month before ``asof``, inclusive, as
    ``ingest_year_month`` text, one row per month per input row.

    A start that is not the first of a month snaps forward to the next month start. The
    bounds are columns of a DataFrame (usually a one-row aggregate over the data), so the
    spine is derived on executors and never built on the driver.
    """
    start = F.to_date(F.col(start_col))
    first = F.when(F.dayofmonth(start) == 1, start).otherwise(F.add_months(F.trunc(start, "MM"), 1))
    last = F.add_months(F.trunc(F.to_date(F.col(asof_col)), "MM"), -1)
    seq = F.when(
        first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
    ).otherwise(F.array().cast("array<date>"))
    return bounds.select(F.explode(seq).alias("m")).select(
        F.date_format("m", MONTH_FORMAT).alias("ingest_year_month")
    )
