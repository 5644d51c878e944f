"""Month replace that a crash cannot leave half done.

A replaced month is written to a folder of its own, and only when that write is committed does the
table's partition point to it (``ALTER TABLE ... PARTITION ... SET LOCATION``). Until then readers
see the old folder, and afterwards the new one; a job that dies in between leaves files that nothing
refers to. The old folders stay until ``drop_old_versions``, so readers that began before the switch
can finish.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from blotter.schemas import MONTH_COL, Dataset
from blotter.sources.raw import create_raw_table, month_clustered

VERSIONS = "_versions"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _month_folders(spark: SparkSession, root: str) -> dict[str, str]:
    """Month -> folder of a committed write: one entry per month, never per row."""
    p, fs = _fs(spark, root)
    found = {}
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{MONTH_COL}="):
            found[name.split("=", 1)[1]] = status.getPath().toString()
    return found


def register_table(spark: SparkSession, dataset: str | Dataset, table: str, path: str) -> None:
    """A catalog table over the months stored at ``path``, each month a partition with a location.
    The files at ``path`` are only read: later replacements go to folders of their own."""
    create_raw_table(spark, dataset, path, table)
    spark.catalog.recoverPartitions(table)


def write_version(
    batch: DataFrame, root: str, cluster_by: tuple[str, ...] | list[str] = (), rebalance: bool = True
) -> dict[str, str]:
    """Write a batch's months to a new folder below ``root``; month -> folder. An empty batch has
    no months. Nothing refers to the folder yet."""
    version = f"{root.rstrip('/')}/{VERSIONS}/{uuid.uuid4().hex}"
    month_clustered(batch, cluster_by, rebalance).write.partitionBy(MONTH_COL).parquet(version)
    return _month_folders(batch.sparkSession, version)


def switch_months(spark: SparkSession, table: str, folders: dict[str, str]) -> None:
    """Point the months of ``table`` to their new folders. One change of the catalog per month, so a
    month is never seen half replaced; repeating it after a crash changes nothing more."""
    for month, folder in sorted(folders.items()):
        spec = f"PARTITION ({MONTH_COL} = '{month}')"
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def replace_months_safely(
    batch: DataFrame, table: str, root: str, cluster_by: tuple[str, ...] | list[str] = (), rebalance: bool = True
) -> list[str]:
    """Replace the months present in ``batch`` in the catalog table; the others are not touched.
    Returns the replaced months."""
    folders = write_version(batch, root, cluster_by, rebalance)
    switch_months(batch.sparkSession, table, folders)
    return sorted(folders)


def drop_old_versions(spark: SparkSession, table: str, root: str) -> int:
    """Delete the versions below ``root`` that no partition of ``table`` points to; returns how many
    month folders went. Run it when no reader from before the last switch is left."""
    p, fs = _fs(spark, f"{root.rstrip('/')}/{VERSIONS}")
    if not fs.exists(p):
        return 0
    local = lambda folder: folder.replace("file:///", "file:/")
    used = {local(f.rsplit("/", 1)[0]) for f in spark.table(table).inputFiles()}
    gone = 0
    for version in fs.listStatus(p):
        months = _month_folders(spark, version.getPath().toString())
        kept = [f for f in months.values() if local(f) in used]
        for folder in months.values():
            if folder not in kept:
                fs.delete(_fs(spark, folder)[0], True)
                gone += 1
        if not kept:
            fs.delete(version.getPath(), True)
    return gone
