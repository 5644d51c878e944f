"""Raw tables: flat rows, nested values as JSON text, one partition per batch month.

``raw_select`` is the schema-driven projection of the monthly load (literal month, load
time, per-column transform, pass-through). ``replace_months`` is the idempotent month
replace: a dynamic partition overwrite on ``ingest_year_month`` that rewrites only the months
present in the batch, so loading a month twice gives the same rows as loading it once and an
empty batch leaves the month as it was.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schemas import DATASETS, LOADED_AT, MONTH_COL, Dataset


def _dataset(dataset: str | Dataset) -> Dataset:
    return DATASETS[dataset] if isinstance(dataset, str) else dataset


def raw_select(records: DataFrame, dataset: str | Dataset, month: str | None = None) -> DataFrame:
    """Project API-shaped or landing rows onto the raw table's columns, in table order.

    * ``ingest_year_month``: the literal ``month`` if given, else the row's batch month
      (``ingest_year_month``, set by the adapters and the landing scan), so all months load
      in one job.
    * ``loaded_at``: ``current_timestamp()``.
    * transformed columns: the dataset's SQL expression, applied only when the input column
      is still nested (a landing read already hands nested values back as text).
    * other columns: cast to the declared type.
    """
    ds = _dataset(dataset)
    if month is not None and not re.fullmatch(r"\d{4}-\d{2}", month):
        raise ValueError(f"batch month must look like yyyy-MM, got {month!r}")
    types = {f.name: f.dataType for f in records.schema.fields}
    exprs = []
    for name, dtype in ds.columns:
        t = dtype.simpleString()
        if name == MONTH_COL:
            src = f"'{month}'" if month is not None else f"`{MONTH_COL}`"
            exprs.append(f"CAST({src} AS STRING) AS `{name}`")
        elif name == LOADED_AT:
            exprs.append(f"current_timestamp() AS `{name}`")
        elif name not in types:
            exprs.append(f"CAST(NULL AS {t}) AS `{name}`")
        elif name in ds.transforms and types[name].typeName() != "string":
            exprs.append(f"CAST({ds.transforms[name]} AS {t}) AS `{name}`")
        else:
            exprs.append(f"CAST(`{name}` AS {t}) AS `{name}`")
    return records.selectExpr(*exprs)


def raw_table_ddl(dataset: str | Dataset, table: str, path: str) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for a raw table, rendered from the registry's
    column -> type list: parquet at ``path``, partitioned by batch month."""
    ds = _dataset(dataset)
    cols = ",\n  ".join(f"`{c}` {t.simpleString().upper()}" for c, t in ds.columns)
    return (
        f"CREATE TABLE IF NOT EXISTS {table} (\n  {cols}\n)\n"
        f"USING parquet\nPARTITIONED BY ({MONTH_COL})\nLOCATION '{path}'"
    )


def create_raw_table(spark: SparkSession, dataset: str | Dataset, path: str, table: str | None = None) -> None:
    """Create the raw table at ``path`` if it does not exist; with ``table``
    (``schema.name``), also create the namespace and register the table in the catalog."""
    ds = _dataset(dataset)
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    if not hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath):
        spark.createDataFrame([], ds.raw_schema()).write.partitionBy(MONTH_COL).parquet(path)
    if table:
        if "." in table:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
        spark.sql(raw_table_ddl(ds, table, path))


def sync_catalog(spark: SparkSession, table: str) -> None:
    """After months were replaced through the table's path: register new month partitions
    in the catalog and drop cached file listings."""
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def month_clustered(batch: DataFrame, cluster_by: tuple[str, ...] | list[str | Column] = (), rebalance: bool = True) -> DataFrame:
    """``batch`` as it is written: by month, then by ``cluster_by`` within each task."""
    out = batch.hint("rebalance", MONTH_COL) if rebalance else batch
    return out.sortWithinPartitions(MONTH_COL, *cluster_by)


def replace_months(
    batch: DataFrame,
    table_path: str,
    cluster_by: tuple[str, ...] | list[str] = (),
    rebalance: bool = True,
    ordered: bool = False,
) -> None:
    """Replace the months present in ``batch`` in the table at ``table_path``.

    Months not in the batch are untouched; a batch with no rows writes nothing. A rebalance
    on the month clusters each month into few files; AQE splits a month that holds a large
    share of the rows over several tasks instead of sending it to one. Input that is already
    clustered by month (read from a table stored by month) can skip it: each task then
    writes the few months it holds, with no shuffle. Rows are sorted by month (which the
    partitioned writer needs anyway) and then by ``cluster_by``. An ``ordered`` batch was dealt and
    sorted so before, while its rows were narrow, and is written as it comes.
    """
    (
        (batch if ordered else month_clustered(batch, cluster_by, rebalance))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH_COL)
        .parquet(table_path)
    )


def read_raw(spark: SparkSession, table_path: str, dataset: str | Dataset) -> DataFrame:
    """Raw table in its declared column order (the partition column comes back last)."""
    ds = _dataset(dataset)
    df = spark.read.schema(ds.raw_schema()).parquet(table_path)
    return df.select([c for c, _ in ds.columns])


def batch_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """dataset, month, loaded_rows and timed_rows (with a load time) of every loaded batch, without
    reading rows: counts come from the footers of the Parquet files and months from their folders.

    The Parquet reader of the DataSource V2 API takes these aggregates into the scan. It is switched
    on in a session of its own, which the result belongs to, so other plans keep the reader they have."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    parts = []
    for name, path in paths.items():
        rows = own.read.schema(_dataset(name).raw_schema()).parquet(path)
        counts = rows.groupBy(MONTH_COL).agg(
            F.count(F.lit(1)).alias("loaded_rows"), F.count(LOADED_AT).alias("timed_rows")
        )
        parts.append(counts.select(F.lit(name).alias("dataset"), MONTH_COL, "loaded_rows", "timed_rows"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def loaded_batches(raws: dict[str, DataFrame]) -> DataFrame:
    """Distinct (dataset, month) pairs that hold rows, over all raw tables.

    Each table is reduced to its distinct months before the union (a partial aggregate per
    task, then one small shuffle), so the result has one row per loaded batch.
    """
    parts = [
        df.select(F.lit(name).alias("dataset"), F.col(MONTH_COL).alias(MONTH_COL)).distinct()
        for name, df in raws.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
