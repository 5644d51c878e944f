"""Data-quality checks. Checks report failures; they never drop rows from a model.

Every check over one model runs as a single aggregation pass: the per-column counts are
``count_if`` expressions side by side, then unpivoted with ``stack`` into
(model, check_name, column_name, failures) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.schemas import MODEL_FIELDS, MODEL_SHAPES, MODEL_TYPES

REPORT_COLUMNS = ["model", "check_name", "column_name", "failures"]


def _unpivot(counts: DataFrame, model: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """One-row ``counts`` with columns ``c0..cn`` -> one report row per (check, column)."""
    args = ", ".join(f"'{check}', '{col}', c{i}" for i, (check, col) in enumerate(pairs))
    return counts.selectExpr(f"stack({len(pairs)}, {args}) AS (check_name, column_name, failures)").select(
        F.lit(model).alias("model"), "check_name", "column_name", F.col("failures").cast("bigint").alias("failures")
    )


def _checks(df: DataFrame, model: str, named: list[tuple[str, str, Column]]) -> DataFrame:
    counts = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, _, cond) in enumerate(named)])
    return _unpivot(counts, model, [(check, col) for check, col, _ in named])


def not_null_checks(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """Rows where each column is null, all columns in one pass."""
    return _checks(df, model, [("not_null", c, F.col(c).isNull()) for c in columns])


def type_checks(df: DataFrame, model: str, types: dict[str, str]) -> DataFrame:
    """Rows whose text is present but does not convert to the declared type.

    ``types`` maps a column to a Spark type name, or to ``month`` for ``yyyy-MM`` text.
    """
    named = []
    for c, t in types.items():
        col = F.col(c)
        conv = F.try_to_date(col, "yyyy-MM") if t == "month" else col.try_cast(t)
        named.append(("type", c, col.isNotNull() & conv.isNull()))
    return _checks(df, model, named)


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their number of occurrences.

    A hash aggregate with map-side combine: a value repeated across a third of all rows is
    counted per task first, so only one partial count per task reaches its reducer.
    """
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def unique_check(df: DataFrame, model: str, column: str) -> DataFrame:
    """Report row: number of distinct values of ``column`` that occur more than once."""
    dup = duplicate_values(df, column)
    return dup.agg(F.count(F.lit(1)).alias("c0")).transform(lambda d: _unpivot(d, model, [("unique", column)]))


def landing_checks(df: DataFrame, model: str, key_columns: list[str], corrupt: str = "_corrupt_record") -> DataFrame:
    """Report rows for a landing scan: lines the JSON reader could not parse (kept, with
    their text, in ``corrupt``) and rows missing a key field, in one pass.

    The key columns also keep the scan from reading the corrupt-record column alone, which
    the JSON source does not allow.
    """
    named = [("corrupt_record", corrupt, F.col(corrupt).isNotNull())]
    named += [("not_null", c, F.col(c).isNull()) for c in key_columns]
    return _checks(df, model, named)


def combined_checks(df: DataFrame, checks: list[tuple[str, str, str, Column]]) -> DataFrame:
    """Many row checks, over possibly several models that are projections of ``df``, in one
    global aggregate over ``df``: a task sends one row of counters.

    ``checks`` holds (model, check_name, column_name, failing-row condition). Uniqueness is
    left to ``unique_check``, whose shuffle carries the key column alone.
    """
    counts = [F.count_if(cond).alias(f"c{i}") for i, (_, _, _, cond) in enumerate(checks)]
    totals = df.agg(*counts)
    args = ", ".join(f"'{m}', '{k}', '{c}', c{i}" for i, (m, k, c, _) in enumerate(checks))
    return totals.selectExpr(f"stack({len(checks)}, {args}) AS (model, check_name, column_name, failures)").select(
        "model", "check_name", "column_name", F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures")
    )


def schema_checks(df: DataFrame, model: str, declared: dict[str, str]) -> DataFrame:
    """Report rows for the documented column types of a model: 1 where a column is missing
    or has another type, else 0. ``df`` should read the stored table without a given schema,
    so that the types are those of its files. They are metadata, so the rows (one per
    declared column) are built from them directly; no data is read."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(model, "schema", c, 0 if actual.get(c) == t else 1) for c, t in declared.items()]
    return df.sparkSession.createDataFrame(
        rows, "model string, check_name string, column_name string, failures bigint"
    )


def conformance_checks(raw: DataFrame, model: str) -> DataFrame:
    """Report rows for every documented column of a flattened model, from its raw rows: how many
    held a value that does not come out as the documented type, in one aggregation.

    A field inside JSON text that does not fit its type is null after ``from_json``, like one that
    was never sent. The text is parsed a second time into a VARIANT, which keeps whatever was there:
    a field that the VARIANT holds and the typed parse lost is a failure (``conforms``). Text that is
    no JSON at all is counted once per raw column (``json``), not for each of its fields."""
    fields, types, shapes = MODEL_FIELDS[model], MODEL_TYPES[model], MODEL_SHAPES[model]
    parsed = raw.selectExpr(
        "*",
        *(f"from_json(`{c}`, '{shape.simpleString()}') AS `parsed_{c}`" for c, shape in shapes.items()),
        *(f"try_parse_json(`{c}`) AS `held_{c}`" for c in shapes),
    )
    named = [("json", c, F.expr(f"trim(`{c}`) <> '' AND `held_{c}` IS NULL")) for c in shapes]
    for column, (source, path) in fields.items():
        if path:
            value = f"try_variant_get(`held_{source}`, '$.{path}', 'variant')"
            held = f"{value} IS NOT NULL AND NOT is_variant_null({value})"
            lost = f"`parsed_{source}`.{path} IS NULL"
        else:
            held, lost = f"`{source}` IS NOT NULL", f"try_cast(`{source}` AS {types[column]}) IS NULL"
        # the cheap test first: the VARIANT is only searched for what the typed parse has not got
        named.append(("conforms", column, F.expr(f"{lost} AND {held}")))
    return _checks(parsed, model, named)


def union_reports(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
