"""Batch coverage: which expected (dataset, month) batches hold no rows.

The expected grid is the month spine fanned out to the dataset names with ``explode`` (a
fixed fan-out per month row, not a join), then an anti join drops the batches that were
loaded. Both sides are one row per (dataset, month), so the join moves only that many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.schemas import DATASETS, MONTH_COL


def batch_grid(spine: DataFrame, datasets: list[str] | None = None) -> DataFrame:
    """Every month of ``spine`` for every dataset name."""
    names = datasets or list(DATASETS)
    return spine.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("dataset"), F.col(MONTH_COL))


def missing_batches(spine: DataFrame, loaded: DataFrame, datasets: list[str] | None = None) -> DataFrame:
    """Expected batches (grid) that are not among the ``loaded`` (dataset, month) pairs."""
    grid = batch_grid(spine, datasets)
    return grid.join(loaded, ["dataset", MONTH_COL], "left_anti")
