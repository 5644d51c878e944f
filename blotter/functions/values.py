"""Small value expressions used by the marts and serving operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# Sums of doubles depend on the order partitions are combined in. Weighted means and
# coordinate centres are accumulated as decimals instead, which is exact and gives the same
# answer for any partitioning; the scale keeps 9 digits of each addend.
EXACT_SUM_TYPE = "decimal(38,9)"


def label_null(c: str | Column, label: str = UNKNOWN) -> Column:
    """NULL -> ``label``; empty text and ``'false'`` stay as they are."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(label))


# text that counts as a number: decimal digits with an optional exponent, nothing after it
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def finite(col: Column) -> Column:
    """A double, or null when it is not a finite number."""
    value = col.cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def try_double(c: str | Column) -> Column:
    """Tolerant numeric cast of text: what is not a finite number becomes null. Spark's own
    cast would also take type suffixes (``53.2d``) and the words for NaN and infinity, which
    have no place among coordinates."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.rlike(NUMBER), finite(col.try_cast("double")))


def share(part: Column, total: Column) -> Column:
    """``part / total`` in double precision (never decimal)."""
    return part.cast("double") / total.cast("double")


def exact_sum(c: Column) -> Column:
    """Order-independent sum of a double column (values the decimal cannot hold are left out)."""
    return F.sum(c.try_cast(EXACT_SUM_TYPE))


def exact_mean(c: Column) -> Column:
    """Order-independent mean of a double column (nulls ignored, like ``avg``): the values that
    are summed are those that are counted."""
    return exact_sum(c).cast("double") / F.count(c.try_cast(EXACT_SUM_TYPE)).cast("double")
