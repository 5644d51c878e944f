"""Session settings the library relies on, and a shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings whose defaults change results.

    * The month of a stop is taken from a timestamp, so the session time zone decides it.
      The pipeline pins UTC.
    * AQE stays on: it coalesces the small post-aggregation shuffles and splits skewed ones.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    value = spark.conf.get("spark.checkpoint.dir", None)
    return value or None


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session (one process) without one gets a fresh folder of its own (tests, bench);
    a cluster session must name a shared folder, since executors may be lost and a
    machine-local path would not be visible to the others.
    """
    found = _checkpoint_dir(spark)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running jobs")
    local = tempfile.mkdtemp(prefix="blotter-ckpt-", dir=os.environ.get("BLOTTER_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    found = _checkpoint_dir(spark)
    return (found or local).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the scratch root for one run of one job."""
    return f"{scratch_root(spark)}/blotter/{name}-{uuid.uuid4().hex[:12]}"
