"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node it reaches) for every node of ``edges``
    (a, b); a node without edges is not returned. Nodes are of any orderable type.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its
    smallest neighbour, then every node hands its smaller neighbours and itself to the smallest.
    Edges end as stars around the smallest node. Minima are partial aggregates, written before the
    hand-over joins them: a join of two plain shuffles is one that AQE splits, so a node of many
    edges is not gathered in one task. Every round is a written table, which cuts the lineage.
    """
    links = stored(
        edges.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        .distinct(),
        "links",
    )
    state = _state(links)
    while state[0]:
        both = links.select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(
            links.select(F.col("high").alias("u"), F.col("low").alias("v"))
        )
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "links-least")
        large = (
            both.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("m").alias("low"), F.col("v").alias("high"))
            .where(F.col("low") != F.col("high"))
            .distinct()
        )
        large = stored(large, "links-large")
        least = stored(large.groupBy("high").agg(F.min("low").alias("m")), "links-least")
        small = (
            large.join(least, "high")
            .select(F.col("m").alias("low"), F.explode(F.array("low", "high")).alias("high"))
            .where(F.col("low") != F.col("high"))
            .distinct()
        )
        links = stored(small, "links")
        now = _state(links)
        if now == state:
            break
        state = now
    nodes = links.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = links.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return nodes.unionByName(roots)


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)")).alias("sum")
    ).first()
    return row["n"], row["sum"]
