"""Mixing sources to target weights.

Tokens are summed per source, a target per source gives a repetition rate, and every document
is emitted ``floor(rate)`` times plus once more when a hash of its id falls below the fraction.
Built-in functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotter.llm.common import stored

#: The word rule of the size, and the weights given to sources in turn.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: The mix takes SHARE[0] / SHARE[1] of all tokens, and no source more than CAP times its own.
SHARE = (3, 2)
CAP = 2
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Number of words of a text; null and empty texts have 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, cap: int = CAP
) -> DataFrame:
    """Target tokens per source from ``sizes`` (source, source_size; one row per source).

    Sources by code point, null last, take the weights in turn. The budget is shared by weight;
    a target stops at ``cap`` times its source's size and the excess is shared again by weight
    until none is above. The end of that is one water level: sources in order of cap / weight
    are full as long as the level that the others would get reaches their cap. The windows run
    over one row per source, after the aggregate. An empty input gives no rows; sources
    without tokens get 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    so_far = by_room.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    filled = F.sum("cap").over(so_far) - F.col("cap")
    left = F.lit(share[0]) * F.sum("source_size").over(everything) - F.lit(share[1]) * filled
    return (
        sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn.cast("int")))
        .withColumn("cap", F.lit(cap).cast("long") * F.col("source_size"))
        .withColumn("level", left.cast("double") / (F.lit(share[1]) * F.sum("weight").over(from_here)).cast("double"))
        .withColumn("open_level", F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level")))
        .withColumn("open_level", F.first("open_level", ignorenulls=True).over(so_far))
        .select(
            "source",
            "source_size",
            F.coalesce(F.col("weight") * F.col("open_level"), F.col("cap").cast("double")).alias("target"),
        )
    )


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id and the seed only (52 bits of an md5)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def planned_mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    cap: int = CAP,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` (doc_id, text, source and any others) with ``mix_size``, ``mix_source_size``,
    ``mix_target`` and ``mix_copies``.

    Null or empty texts have size 0 and take nothing; a null source is a source; a null id
    draws as one id; repeated rows draw alike. Columns of ``docs`` that carry one of the new
    names are replaced. The totals per source come from partial aggregates, so a source that
    holds a third of the rows sends one row per task; the targets are written as a table, and
    the planner broadcasts it only when its true size is below the session's limit (a join on
    the source otherwise, whose skew AQE splits).
    """
    sized = docs.drop("mix_source", "mix_source_size", "mix_target", "mix_copies").withColumn(
        "mix_size", word_count(F.col("text"))
    )
    totals = sized.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    targets = stored(source_targets(totals, weights, share, cap), "mix-targets").select(
        F.col("source").alias("mix_source"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
    )
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(0.0)
    whole = F.floor(rate)
    extra = (draw(F.col("doc_id"), seed) < rate - whole).cast("long")
    return (
        sized.join(targets, sized["source"].eqNullSafe(targets["mix_source"]), "left")
        .withColumn("mix_copies", whole + extra)
        .drop("mix_source")
    )


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as its plan says, same columns, those
    that carry a name of the plan included."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    planned = planned_mix(docs.select("doc_id", "text", "source", own.alias("own")), **options)
    return (
        planned.where(F.col("mix_copies") > 0)
        .select("own", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies"))))
        .select(*[F.col(f"own.`{c}`") for c in docs.columns])
    )
