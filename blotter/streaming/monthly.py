"""Month replace driven by newly landed files (Structured Streaming file source).

The monthly load re-reads every month on every run because the latest outcome of an old
crime can change. Here the landing zone is watched instead: each micro-batch holds the files
that arrived since the last one, and every month present in it is replaced in the raw table
(dynamic partition overwrite). The micro-batch only says which months were touched: those are
read again from the landing zone, in full, so a file added to a month does not replace the
others, however the files fall into micro-batches. Untouched months are not read again.

Exactly-once comes from the checkpoint plus an idempotent sink: replaying a micro-batch
replaces the same months with what the landing zone holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from blotter.schemas import CORRUPT_COL, DATASETS, MONTH_COL
from blotter.sources.landing import MONTH_KEYS, dataset_path, read_landing
from blotter.sources.raw import raw_select, replace_months


def landing_stream(spark: SparkSession, landing_root: str, dataset: str, key: str | None = None) -> DataFrame:
    """Streaming scan of a dataset's landing folders, by either folder name unless ``key`` names one,
    with the batch month from the path."""
    ds = DATASETS[dataset]
    keys = (key,) if key else MONTH_KEYS
    df = (
        spark.readStream.schema(ds.landing_schema())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .json(f"{dataset_path(landing_root, ds.name)}/{{{','.join(keys)}}}=*")
    )
    month = F.regexp_extract(F.col("_metadata.file_path"), f"/(?:{'|'.join(keys)})=([^/]+)/[^/]*$", 1)
    return df.withColumn(MONTH_COL, month)


def start_month_replace(
    spark: SparkSession,
    landing_root: str,
    dataset: str,
    table_path: str,
    checkpoint: str,
    available_now: bool = True,
    key: str | None = None,
    interval: str = "1 hour",
    quarantine: str | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it drains what has landed, then stops,
    otherwise it checks for new landing files every ``interval``. Broken lines of the touched months
    go to ``quarantine`` (``<table_path>_quarantine`` unless given), by month, replaced like the rows."""
    broken_path = quarantine or f"{table_path.rstrip('/')}_quarantine"

    cluster_by = DATASETS[dataset].cluster_by

    def replace(batch: DataFrame, _batch_id: int) -> None:
        # one name per touched month
        months = [r[MONTH_COL] for r in batch.select(MONTH_COL).distinct().toLocalIterator()]
        records = read_landing(batch.sparkSession, landing_root, dataset, months=months, key=key)
        # landing files are month-pure, so the months are written without a shuffle
        replace_months(records.where(F.col(CORRUPT_COL).isNotNull()), broken_path, rebalance=False)
        sound = records.where(F.col(CORRUPT_COL).isNull())
        replace_months(raw_select(sound, dataset), table_path, cluster_by, rebalance=False)

    writer = landing_stream(spark, landing_root, dataset, key).writeStream.foreachBatch(replace).option(
        "checkpointLocation", checkpoint
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
