"""Landing zone: one folder per dataset and batch month, ``<root>/<dataset>/<key>=<yyyy-MM>/``.

The landing write stores API-shaped records as JSON Lines, partitioned by batch month with
dynamic overwrite, so a re-run of a month replaces that month's files and leaves the others.

The landing read takes a fixed schema (nested objects as text), keeps broken lines in
``_corrupt_record``, and reads every month of a dataset in one scan. It globs the month
folders instead of relying on partition discovery and takes the batch month from each
file's path: with discovery, a folder named ``date=`` would silently replace the ``date``
field of outcome records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schemas import CORRUPT_COL, DATASETS, LANDING_PARTITION, MONTH_COL, Dataset


def _ds(dataset: str | Dataset) -> Dataset:
    return DATASETS[dataset] if isinstance(dataset, str) else dataset


def dataset_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{dataset}"


def write_landing(
    records: DataFrame, root: str, dataset: str | Dataset, month_col: str = MONTH_COL, key: str | None = None
) -> None:
    """Write API-shaped records to ``<root>/<dataset>/<key>=<month>/``.

    Rows are rebalanced on the month before the write so each month lands in few files
    rather than one small file per task and month (AQE splits an oversized month over
    several tasks); only the months present in ``records`` are replaced (dynamic overwrite).
    """
    ds = _ds(dataset)
    key = key or ds.landing_key
    if key != month_col and key in records.columns:
        raise ValueError(f"landing key {key!r} is also a field of the {ds.name} records")
    out = records.withColumnRenamed(month_col, key)
    (
        out.hint("rebalance", key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "true")
        .partitionBy(key)
        .json(dataset_path(root, ds.name))
    )


# names a month folder may have, whatever the dataset
MONTH_KEYS = (LANDING_PARTITION, MONTH_COL)


def _month_paths(spark: SparkSession, path: str, keys: tuple[str, ...], months: list[str] | None) -> list[str]:
    """Month folders to read. A month with no folder is a missing batch and is left out; a
    dataset folder that holds something but no month folder is an error, not an empty input."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {
        key: any(s.isDirectory() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{key}=*")) or [])
        for key in keys
    }
    if not any(found.values()):
        inside = [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []
        if any(name[0] not in "._" for name in inside):
            raise ValueError(f"{path} has no month folders named {' or '.join(k + '=<yyyy-MM>' for k in keys)}")
        return []
    if months is None:
        return [f"{path}/{key}=*" for key in keys if found[key]]
    wanted = [f"{path}/{key}={m}" for key in keys if found[key] for m in months]
    return [p for p in wanted if fs.exists(jvm.org.apache.hadoop.fs.Path(p))]


def read_landing(
    spark: SparkSession,
    root: str,
    dataset: str | Dataset,
    months: list[str] | None = None,
    multiline: bool = False,
    key: str | None = None,
) -> DataFrame:
    """Scan landing JSON of one dataset with its fixed schema; adds ``ingest_year_month``.

    ``months=None`` reads every month folder in one scan; a list reads only those folders
    (missing ones are skipped: a missing batch keeps the rows already loaded). ``multiline``
    is needed only for arrays broken over several lines. Month folders are found by either
    name (``date=`` or ``ingest_year_month=``); ``key`` restricts them to one.
    """
    ds = _ds(dataset)
    keys = (key,) if key else MONTH_KEYS
    path = dataset_path(root, ds.name)
    paths = _month_paths(spark, path, keys, months)
    schema = ds.landing_schema()
    if not paths:
        return spark.createDataFrame([], schema).withColumn(MONTH_COL, F.lit(None).cast("string"))
    df = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .option("multiLine", str(multiline).lower())
        .json(paths)
    )
    month = F.regexp_extract(F.col("_metadata.file_path"), f"/(?:{'|'.join(keys)})=([^/]+)/[^/]*$", 1)
    return df.withColumn(MONTH_COL, month)
