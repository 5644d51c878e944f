"""The monthly build: raw -> staging -> flatten -> marts -> checks, in dependency order.

Materialisation points are chosen for reuse and for lineage:

* raw tables: parquet partitioned by batch month, replaced month by month (idempotent);
* flattened layer: parquet partitioned by batch month, so the JSON text is parsed once
  rather than once per mart read, a monthly run parses only its months again, and later
  filters on its columns reach the scan as pushed filters;
* marts: parquet, the tables the serving operators read.

Each written table cuts the lineage of the next step, so a lost executor recomputes at
most one step from files in the shared folder. Staging is never written: it is a cast layer
fused into the flatten stage.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.months import month_spine
from blotter.functions.values import try_double
from blotter.operators import coverage, flatten, marts, quality, staging
from blotter.schemas import CORRUPT_COL, DATASETS, MODEL_TYPES, MONTH_COL
from blotter.session import configure, scratch_path
from blotter.sources.fixtures import api_records
from blotter.sources.landing import read_landing
from blotter.sources.raw import loaded_batches, raw_select, read_raw, replace_months

# concurrent write jobs per layer (the reference builds its models with 4 threads)
BUILD_THREADS = 4

# the field a record cannot be without, per dataset (checked on the landing scan)
LANDING_KEYS = {"crime_data": ["id"], "outcome_data": ["crime"], "stop_and_search_data": ["datetime"]}

_STAGE = {
    "crime_data": (staging.stg_crimes, flatten.int_crimes, "int_crimes"),
    "outcome_data": (staging.stg_outcomes, flatten.int_outcomes, "int_outcomes"),
    "stop_and_search_data": (staging.stg_stop_search, flatten.int_stop_search, "int_stop_search"),
}


def quality_report(
    int_crimes: DataFrame,
    timings: DataFrame,
    raw_stops: DataFrame | None = None,
    typed: dict[str, DataFrame] | None = None,
    raws: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """The checks of the crime models as one report (model, check_name, column_name, failures).

    * ``int_crimes``: type conformance of the text columns the marts convert (months as
      ``yyyy-MM``, coordinates as numbers);
    * ``mart_crime_map``: the declared not-null tests and the unique test of ``crime_id``.
      The map is a projection of ``int_crimes`` (same rows, same values), so its row checks
      run in the same pass; uniqueness is a second scan, of the id column;
    * ``mart_outcome_timings``: the declared not-null tests, over the mart's rows;
    * ``typed`` (``int_crimes`` unless given): the documented column types of each model;
    * ``stop_and_search_data`` (when given): stop times whose text does not convert to the
      timestamp that staging casts it to;
    * ``raws`` (raw tables by dataset): every documented column of the flattened models, whether
      what the raw rows hold comes out as its type.
    """
    month = lambda c: F.col(c).isNotNull() & F.try_to_date(F.col(c), "yyyy-MM").isNull()
    number = lambda c: F.col(c).isNotNull() & try_double(c).isNull()
    crimes = quality.combined_checks(
        int_crimes,
        [
            ("int_crimes", "type", "crime_month", month("crime_month")),
            ("int_crimes", "type", "latest_outcome_date", month("latest_outcome_date")),
            ("int_crimes", "type", "crime_latitude", number("crime_latitude")),
            ("int_crimes", "type", "crime_longitude", number("crime_longitude")),
            ("mart_crime_map", "not_null", "crime_id", F.col("crime_id").isNull()),
            ("mart_crime_map", "not_null", "crime_latitude", F.col("crime_latitude").isNull()),
            ("mart_crime_map", "not_null", "crime_longitude", F.col("crime_longitude").isNull()),
        ],
    )
    unique = quality.unique_check(int_crimes, "mart_crime_map", "crime_id")
    marts_ = quality.not_null_checks(timings, "mart_outcome_timings", ["crime_month", "crime_category"])
    typed = {"int_crimes": int_crimes} if typed is None else typed
    contract = [quality.schema_checks(df, model, MODEL_TYPES[model]) for model, df in typed.items()]
    parts = [crimes, unique, marts_, *contract]
    if raw_stops is not None:
        parts.append(quality.type_checks(raw_stops, "stop_and_search_data", {"datetime": "timestamp"}))
    parts += [quality.conformance_checks(raw, _STAGE[name][2]) for name, raw in (raws or {}).items()]
    return quality.union_reports(parts)


def _as_stored(spark: SparkSession, path: str, planned: DataFrame) -> DataFrame:
    """A stored table with the types of its files, or the planned ones while it has no files
    (its months all came in empty)."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return planned


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _write_all(jobs: dict[str, Callable[[], None]], threads: int) -> None:
    """Run independent write jobs of one layer side by side (Spark schedules jobs submitted
    from several threads concurrently), like a model build with a fixed number of threads.
    The first failure is raised after all jobs have finished or failed."""
    if threads <= 1 or len(jobs) <= 1:
        for job in jobs.values():
            job()
        return
    with ThreadPoolExecutor(max_workers=min(threads, len(jobs))) as pool:
        futures = [pool.submit(job) for job in jobs.values()]
    for f in futures:
        f.result()


def coverage_report(raws: dict[str, DataFrame]) -> DataFrame:
    """Report rows (dataset, ``missing_batch``, ``ingest_year_month``, months): months between
    the first and the last loaded month, over all datasets, in which a dataset holds no rows.
    The month spine and the loaded batches are derived on executors from the raw tables'
    month partitions; the anti join moves one row per (dataset, month)."""
    loaded = loaded_batches(raws)
    bounds = loaded.agg(F.min(MONTH_COL).alias("first"), F.max(MONTH_COL).alias("last")).select(
        F.to_date("first").alias("start"), F.add_months(F.to_date("last"), 1).alias("asof")
    )
    missing = coverage.missing_batches(month_spine(bounds), loaded, list(raws))
    return quality.combined_checks(
        missing, [(n, "missing_batch", MONTH_COL, F.col("dataset") == n) for n in raws]
    )


def load_raw(
    spark: SparkSession,
    records: dict[str, DataFrame],
    raw_root: str,
    threads: int = BUILD_THREADS,
    month_clustered: bool = False,
    ordered: bool = False,
) -> dict[str, str]:
    """Replace every month present in each dataset's records; one job per dataset.

    ``month_clustered`` input (a landing scan: every file belongs to one month folder) is
    written without a shuffle, each task writing the few months it holds; other input is
    rebalanced on the month first so each month lands in few files. ``ordered`` records (of
    ``api_records(by_month=True)``) were dealt and sorted before they were widened: neither a
    shuffle nor a sort holds their JSON text."""
    paths = {name: f"{raw_root}/{name}" for name in records}

    def load(n: str) -> None:
        batch = raw_select(records[n], n)
        replace_months(batch, paths[n], DATASETS[n].cluster_by, rebalance=not month_clustered, ordered=ordered)

    _write_all({n: (lambda n=n: load(n)) for n in records}, threads)
    return paths


def build_all(
    spark: SparkSession,
    sf_dir: str | None = None,
    landing_root: str | None = None,
    out_root: str | None = None,
    threads: int = BUILD_THREADS,
    months: list[str] | None = None,
    multiline: bool = False,
) -> dict[str, object]:
    """Run the whole build. Input is either a landing zone (``landing_root``) or the
    generated tables (``sf_dir``, through the API-shaped adapters). Layers run in dependency
    order; the tables of one layer are written by up to ``threads`` concurrent jobs. Returns
    the table paths and the quality report (read back from its written table).

    With ``months``, only those batch months are read (landing folders, or rows of the
    tables) and replaced in the raw tables under ``out_root``, flattened, put on the map and counted
    again; months loaded by earlier runs stay. The aggregate marts are merged from the counts of
    all months, and the checks read the whole tables. ``multiline`` is for landing files whose
    array or record is broken over several lines; each is then read by one task.
    """
    configure(spark)
    root = out_root or scratch_path(spark, "build")
    if landing_root is not None:
        records = {n: read_landing(spark, landing_root, n, months=months, multiline=multiline) for n in DATASETS}
    elif sf_dir is not None:
        records = {n: api_records(spark, sf_dir, n, by_month=True) for n in DATASETS}
        if months is not None:
            records = {n: df.where(F.col(MONTH_COL).isin(months)) for n, df in records.items()}
    else:
        raise ValueError("give sf_dir or landing_root")

    sound = records
    if landing_root is not None:
        # broken lines go to a table of their own; the report counts them
        quarantine = {n: f"{root}/quarantine/{n}" for n in records}
        broken = {n: df.where(F.col(CORRUPT_COL).isNotNull()) for n, df in records.items()}
        _write_all(
            {n: (lambda n=n: broken[n].write.mode("overwrite").parquet(quarantine[n])) for n in records}, threads
        )
        sound = {n: df.where(F.col(CORRUPT_COL).isNull()) for n, df in records.items()}
    landed = landing_root is not None
    raw_paths = load_raw(spark, sound, f"{root}/raw", threads, month_clustered=landed, ordered=not landed)

    # flattened layer, stored by batch month: only the months of this run are parsed again
    # and replaced; months flattened by earlier runs stay
    int_paths = {model: f"{root}/int/{model}" for _, _, model in _STAGE.values()}
    int_frames = {}
    for name, (stage_fn, flat_fn, model) in _STAGE.items():
        raw = read_raw(spark, raw_paths[name], name)
        if months is not None:
            raw = raw.where(F.col(MONTH_COL).isin(months))  # partition pruning on the raw table
        keep = (MONTH_COL,)
        # tolerant casts: a value that does not fit becomes null here and is counted in the report
        int_frames[model] = flat_fn(stage_fn(raw, strict=False, keep=keep), keep=keep)
    # rows come from raw files stored one month per file, so no rebalance shuffle is needed
    _write_all(
        {m: (lambda m=m: replace_months(int_frames[m], int_paths[m], rebalance=False)) for m in int_frames}, threads
    )

    # read back with the planned schema: a table whose months all came in empty has no files
    ic = spark.read.schema(int_frames["int_crimes"].schema).parquet(int_paths["int_crimes"])
    ist = spark.read.schema(int_frames["int_stop_search"].schema).parquet(int_paths["int_stop_search"])
    # what the aggregate marts are made of is stored by batch month as well: a run counts its own
    # months again, and the marts are merged from the counts, not from the rows of all months
    state_paths = {state: f"{root}/state/{state}" for state in ("timing_spans", "stop_counts")}
    counted = {
        "timing_spans": lambda rows: marts.timing_spans(rows, strict=False, keep=(MONTH_COL,)),
        "stop_counts": lambda rows: marts.stop_counts(rows, keep=(MONTH_COL,)),
    }
    rows_of = {"timing_spans": ic, "stop_counts": ist}
    run_of = lambda df: df if months is None else df.where(F.col(MONTH_COL).isin(months))
    # tables built before there were states have none yet: then all months are counted
    state_frames = {
        state: counted[state](run_of(rows) if _exists(spark, state_paths[state]) else rows) for state, rows in rows_of.items()
    }
    # the map is as long as the crimes: it is stored by batch month, and a run replaces its months
    crime_map = marts.crime_map(run_of(ic), keep=(MONTH_COL,))
    mart_paths = {m: f"{root}/mart/{m}" for m in ("mart_crime_map", "mart_outcome_timings", "mart_outcome_mix", "mart_reason_trends")}
    jobs = {s: (lambda s=s: replace_months(state_frames[s], state_paths[s])) for s in state_frames}
    jobs["mart_crime_map"] = lambda: replace_months(crime_map, mart_paths["mart_crime_map"], rebalance=False)
    _write_all(jobs, threads)
    spans, stops = (spark.read.schema(state_frames[s].schema).parquet(state_paths[s]) if _exists(spark, state_paths[s]) else state_frames[s] for s in state_frames)
    mart_frames = {
        "mart_outcome_timings": marts.timings_of(spans),
        "mart_outcome_mix": marts.outcome_mix_of(stops),
        "mart_reason_trends": marts.reason_trends_of(stops),
    }
    _write_all({m: (lambda m=m: mart_frames[m].write.mode("overwrite").parquet(mart_paths[m])) for m in mart_frames}, threads)

    raws = {n: read_raw(spark, raw_paths[n], n) for n in DATASETS}
    planned = {**int_frames, **mart_frames}
    typed = {m: _as_stored(spark, {**int_paths, **mart_paths}[m], planned[m]) for m in MODEL_TYPES}
    stored_timings = spark.read.parquet(mart_paths["mart_outcome_timings"])
    report = quality.union_reports(
        [
            quality_report(ic, stored_timings, raws["stop_and_search_data"], typed, raws),
            coverage_report(raws),
        ]
    )
    if landing_root is not None:
        # unparseable lines and rows without their key field, one pass per landing dataset
        report = quality.union_reports(
            [report] + [quality.landing_checks(records[n], n, LANDING_KEYS[n]) for n in DATASETS]
        )
    report_path = f"{root}/checks/report"
    report.coalesce(1).write.mode("overwrite").parquet(report_path)
    return {
        "raw": raw_paths,
        "int": int_paths,
        "mart": mart_paths,
        "report_path": report_path,
        "report": spark.read.parquet(report_path),
        "schemas": {
            **{n: DATASETS[n].raw_schema() for n in DATASETS},
            **{m: df.schema for m, df in {**int_frames, **mart_frames, "mart_crime_map": crime_map}.items()},
        },
    }
