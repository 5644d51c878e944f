"""Chat formatting with collapse of cumulative snapshots.

A logged conversation that is a prefix of a longer one, or equal to another, is a snapshot of it.
Every turn gets a rolling hash of the turns up to it; a conversation whose last hash is the hash
of a turn inside another conversation is dropped by an anti-join, and the maximal ones are
rendered. Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotter.llm.common import stored

#: Turns per block: the unit that one task orders and renders.
BLOCK_TURNS = 256
#: Blocks that are summed up together on the way to sums over a conversation.
UNIT_GROUP = 1024
#: The marks around a turn.
START, MIDDLE, END = "<|", "|>\n", "\n"
#: A turn without its text; equal ones are interchangeable.
TURN = ["conv_id", "turn", "content", "more"]


def _joined(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys of which null equals null."""
    for k in keys:
        other = other.withColumnRenamed(k, f"other_{k}")
    same = [F.col(k).eqNullSafe(F.col(f"other_{k}")) for k in keys]
    return rows.join(other, reduce(Column.__and__, same)).drop(*(f"other_{k}" for k in keys))


def _hashed(turns: DataFrame, *more_columns: str) -> DataFrame:
    same = [F.col(c).isNull() for c in ("role", "text")]
    return turns.select(
        "conv_id",
        "turn",
        F.xxhash64(*same, "role", "text").alias("content"),
        F.xxhash64(F.lit(7), *same, "text", "role").alias("more"),
        *more_columns,
    )


def _summed(rows: DataFrame, order: list[Column], value: str, before: str, total: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the earlier rows of their conversation, and over
    all of them: windows order a chunk of a conversation, then the chunks' sums."""
    earlier = (Window.unboundedPreceding, -1)
    in_chunk = Window.partitionBy("conv_id", "chunk").orderBy(*order).rowsBetween(*earlier)
    per_conversation = Window.partitionBy("conv_id")
    sums = (
        rows.groupBy("conv_id", "chunk")
        .agg(F.sum(value).alias("n_chunk"))
        .select(
            "conv_id",
            "chunk",
            F.coalesce(F.sum("n_chunk").over(per_conversation.orderBy("chunk").rowsBetween(*earlier)), F.lit(0)).alias(
                "chunks_before"
            ),
            F.sum("n_chunk").over(per_conversation).alias(total),
        )
    )
    within = rows.withColumn("within", F.coalesce(F.sum(value).over(in_chunk), F.lit(0)))
    return (
        _joined(within, sums, ["conv_id", "chunk"])
        .withColumn(before, F.col("chunks_before") + F.col("within"))
        .drop("chunks_before", "within")
    )


def placed_turns(turns: DataFrame) -> DataFrame:
    """One row per distinct turn: conv_id, turn, content, more, chunk, n (how often it is logged),
    first (turns of the conversation before it, by number, null last, ties by content) and total.

    Chunks are ranges of (conversation, turn, content), so a conversation or a turn number that
    holds a third of all rows, the null ones included, is spread over many.
    """
    order = [F.col("turn").asc_nulls_last(), F.col("content").asc(), F.col("more").asc()]
    chunks = stored(
        _hashed(turns)
        .groupBy(*TURN)
        .agg(F.count("*").alias("n"))
        .repartitionByRange(F.col("conv_id").asc(), *order)
        .withColumn("chunk", F.spark_partition_id()),
        "turn-chunks",
    )
    return _summed(chunks, order, "n", "first", "total")


def _cut(rows: DataFrame, start: Column, number: str) -> DataFrame:
    """Rows of turns ``first`` to ``first + n``, cut where a block of turns counted from
    ``start`` ends: ``number`` of the block, and ``low`` and ``high`` of the part inside it."""
    at = F.lit(BLOCK_TURNS)
    from_start = F.col("first") - start
    blocks = F.sequence(F.floor(from_start / at), F.floor((from_start + F.col("n") - 1) / at))
    begin = start + F.col(number) * at
    return (
        rows.withColumn(number, F.explode(blocks))
        .withColumn("low", F.greatest("first", begin))
        .withColumn("high", F.least(F.col("first") + F.col("n"), begin + at))
    )


def rolling_hashes(placed: DataFrame) -> DataFrame:
    """conv_id, position (from 1), total turns of the conversation, and two rolling hashes of the
    turns up to this one, for every logged turn.

    A rolling hash is the exclusive or of hashes of (position, role, text), so it is summed up in
    blocks of positions: windows order one block, then the blocks' sums.
    """
    # dealt before repeated turns are written out
    parts = _cut(placed, F.lit(0), "unit").select("conv_id", "unit", "low", "high", "total", "content", "more")
    rows = stored(
        parts.repartition("conv_id", "unit")
        .withColumn("position", F.explode(F.sequence(F.col("low") + 1, F.col("high"))))
        .withColumn("z1", F.xxhash64("position", "content"))
        .withColumn("z2", F.xxhash64("position", "more"))
        .select("conv_id", "unit", "position", "total", "z1", "z2"),
        "turn-hashes",
    )
    # sums of the earlier units, in groups of units and then over the groups
    earlier = (Window.unboundedPreceding, -1)
    per_unit = rows.groupBy("conv_id", "unit").agg(F.bit_xor("z1").alias("s1"), F.bit_xor("z2").alias("s2"))
    per_unit = per_unit.withColumn("group", F.floor(F.col("unit") / F.lit(UNIT_GROUP)))
    in_group = Window.partitionBy("conv_id", "group").orderBy("unit").rowsBetween(*earlier)
    across = Window.partitionBy("conv_id").orderBy("group").rowsBetween(*earlier)
    none = F.lit(0)
    groups = (
        per_unit.groupBy("conv_id", "group")
        .agg(F.bit_xor("s1").alias("g1"), F.bit_xor("s2").alias("g2"))
        .select(
            "conv_id",
            "group",
            F.coalesce(F.bit_xor("g1").over(across), none).alias("g1"),
            F.coalesce(F.bit_xor("g2").over(across), none).alias("g2"),
        )
    )
    within_group = per_unit.select(
        "conv_id",
        "unit",
        "group",
        F.coalesce(F.bit_xor("s1").over(in_group), none).alias("u1"),
        F.coalesce(F.bit_xor("s2").over(in_group), none).alias("u2"),
    )
    sums = _joined(within_group, groups, ["conv_id", "group"]).select(
        "conv_id",
        "unit",
        F.col("u1").bitwiseXOR(F.col("g1")).alias("before1"),
        F.col("u2").bitwiseXOR(F.col("g2")).alias("before2"),
    )
    running = (
        Window.partitionBy("conv_id", "unit")
        .orderBy("position")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    within = rows.withColumn("r1", F.bit_xor("z1").over(running)).withColumn("r2", F.bit_xor("z2").over(running))
    return _joined(within, sums, ["conv_id", "unit"]).select(
        "conv_id",
        "position",
        "total",
        F.col("r1").bitwiseXOR(F.col("before1")).alias("h1"),
        F.col("r2").bitwiseXOR(F.col("before2")).alias("h2"),
    )


def maximal_conversations(hashes: DataFrame) -> DataFrame:
    """conv_id, total and copies of the conversations that are no prefix of a longer one; of
    equal ones the smallest id stays (null last). Each side of the anti-join has one row per
    distinct prefix, after a partial aggregate, so a first turn that a third of all
    conversations share is one row."""
    whole = (
        hashes.where(F.col("position") == F.col("total"))
        .groupBy("total", "h1", "h2")
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    )
    inner = (
        hashes.where(F.col("position") < F.col("total"))
        .select(F.col("position").alias("total"), "h1", "h2")
        .distinct()
    )
    return whole.join(inner, ["total", "h1", "h2"], "left_anti").select("conv_id", "total", "copies")


def formatted_conversations(turns: DataFrame) -> DataFrame:
    """The maximal conversations of ``turns`` (conv_id, turn, role, text), rendered: conv_id,
    segment, n_turns, total_turns, copies (equal conversations, itself included) and text.

    A row holds the turns of one ``segment``: 256 turns in order, the last segment what is left, so
    a conversation of up to 256 turns is one row. Turns go by number, null last, ties by content;
    repeated turns stay. Null roles render as ``unknown``, null texts as empty. Rows without a
    conv_id are one conversation, cut like any other. Other columns are ignored.
    """
    placed = stored(placed_turns(turns), "turn-places")
    hashes = stored(rolling_hashes(placed), "turn-prefixes")
    kept = maximal_conversations(hashes).select("conv_id", "copies")
    # by chunk, as a conversation may hold a third of all turns
    chosen = stored(_joined(placed.select("conv_id", "chunk").distinct(), kept, ["conv_id"]), "conversations-kept")
    parts = _cut(_joined(placed, chosen, ["conv_id", "chunk"]), F.lit(0), "segment")
    rendered = F.concat(
        F.lit(START), F.coalesce("role", F.lit("unknown")), F.lit(MIDDLE), F.coalesce("text", F.lit("")), F.lit(END)
    )
    shown = _hashed(turns.select("conv_id", "turn", "role", "text").distinct(), rendered.alias("shown"))
    row = F.struct("low", (F.col("high") - F.col("low")).alias("times"), "shown")
    return (
        _joined(shown, parts.select(*TURN, "segment", "low", "high", "total", "copies"), TURN)
        .groupBy("conv_id", "segment", "total", "copies")
        .agg(F.sort_array(F.collect_list(row)).alias("rows"), F.sum(F.col("high") - F.col("low")).alias("n_turns"))
        .select(
            "conv_id",
            F.col("segment").cast("long").alias("segment"),
            F.col("n_turns").cast("long").alias("n_turns"),
            F.col("total").alias("total_turns"),
            "copies",
            F.array_join(F.transform("rows", lambda r: F.repeat(r["shown"], r["times"].cast("int"))), "").alias("text"),
        )
    )
