"""Exact top-k search by tiled matrix products.

Vectors are packed into shards and queries into blocks. Every tile, a query block against a
shard, is one matrix product from which each query keeps its best k; the lists of a query block
are then merged in a tree until one is left. A task holds one tile or a few lists at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import groups, stored

SCALE = 64
K = 20
#: Vectors of a shard and of a query block; lists merged at a time.
SHARD = 4096
QUERY_BLOCK = 512
FAN_IN = 8
_EXACT = float(1 << 53)


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, length and floor(scale * x) of every component as 64-bit integers in bytes, for
    vectors that are not null and hold no null or non-finite component. Components beyond the
    range of a long are held at its ends."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, data = [], [], []
            for vec_id, values in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                if vec_id is None or values is None or any(v is None for v in values):
                    continue
                x = np.array(values, dtype=np.float64)
                if not np.isfinite(x).all():
                    continue
                y = np.clip(np.floor(scale * x), -(2.0**63), 2.0**63 - 1024).astype("<i8")
                ids.append(vec_id)
                sizes.append(len(y))
                data.append(y.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(data, pa.binary())],
                names=["vec_id", "length", "data"],
            )

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(
        read, "vec_id long, length int, data binary"
    )


def packed(rows: DataFrame, size: int, count: int) -> DataFrame:
    """Rows of one length packed into about ``count / size`` parts: part, length, and the ids and
    data of its rows, in order of id."""
    parts = max(1, -(-count // size))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in groups(batches, "part"):
            length = table.column("length").to_numpy()
            for n in np.unique(length):
                own = table.filter(pa.array(length == n))
                ids = own.column("vec_id").to_numpy()
                order = np.argsort(ids, kind="stable")
                data = own.column("data").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([int(n)], pa.int32()),
                        pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                        pa.array([b"".join(data[k] for k in order)], pa.binary()),
                    ],
                    names=["part", "length", "ids", "data"],
                )

    return (
        rows.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
        .repartition(parts, "part")
        .sortWithinPartitions("part")
        .mapInArrow(pack, "part int, length int, ids binary, data binary")
    )


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Integer inner products: by floating point where no sum can leave its exact range, by
    64-bit integers where none can overflow, else by Python's integers (kept within a long)."""
    if queries.shape[1] == 0:
        return np.zeros((len(queries), len(shard)), dtype=np.int64)
    q, s = queries.astype(np.float64), shard.astype(np.float64)
    bound = float(np.abs(q).max()) * float(np.abs(s).sum(axis=1).max())
    if bound < _EXACT:
        return (q @ s.T).astype(np.int64)
    if bound < 2.0**62:
        return queries @ shard.T
    whole = queries.astype(object) @ shard.T.astype(object)
    return np.clip(whole, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of one query's scores, ties to the smaller id."""
    scores, ids = scores[allowed], ids[allowed]
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
        scores, ids = scores[some], ids[some]
    order = np.lexsort((ids, -scores.astype(object) if len(scores) and scores.min() == -(1 << 63) else -scores))[:k]
    return scores[order], ids[order]


_LISTS = "block int, length int, part int, query_ids binary, counts binary, ids binary, scores binary"


def _lists(block: int, length: int, part: int, query_ids: np.ndarray, found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block], pa.int32()),
            pa.array([length], pa.int32()),
            pa.array([part], pa.int32()),
            pa.array([query_ids.astype("<i8").tobytes()], pa.binary()),
            pa.array([np.array([len(s) for s, _ in found], dtype="<i4").tobytes()], pa.binary()),
            pa.array([np.concatenate([i for _, i in found]).astype("<i8").tobytes()], pa.binary()),
            pa.array([np.concatenate([s for s, _ in found]).astype("<i8").tobytes()], pa.binary()),
        ],
        names=["block", "length", "part", "query_ids", "counts", "ids", "scores"],
    )


def tile_lists(tiles: DataFrame, k: int) -> DataFrame:
    """Each tile's best k per query."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["length"]
                query_ids = np.frombuffer(row["query_ids"], "<i8")
                ids = np.frombuffer(row["ids"], "<i8")
                scores = products(
                    np.frombuffer(row["query_data"], "<i8").reshape(len(query_ids), n),
                    np.frombuffer(row["data"], "<i8").reshape(len(ids), n),
                )
                found = [best(s, ids, ids != q, k) for s, q in zip(scores, query_ids, strict=True)]
                yield _lists(row["block"], n, row["part"], query_ids, found)

    return tiles.mapInArrow(search, _LISTS)


def merged_lists(lists: DataFrame, k: int, fan_in: int) -> DataFrame:
    """One step of the tree: the lists of ``fan_in`` neighbouring parts become one."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in groups(batches, "gid"):
            rows = table.to_pylist()
            query_ids = np.frombuffer(rows[0]["query_ids"], "<i8")
            scores: list[list[np.ndarray]] = [[] for _ in query_ids]
            ids: list[list[np.ndarray]] = [[] for _ in query_ids]
            for row in rows:
                ends = np.cumsum(np.frombuffer(row["counts"], "<i4"))[:-1]
                for q, (s, i) in enumerate(
                    zip(
                        np.split(np.frombuffer(row["scores"], "<i8"), ends),
                        np.split(np.frombuffer(row["ids"], "<i8"), ends),
                        strict=True,
                    )
                ):
                    scores[q].append(s)
                    ids[q].append(i)
            found = []
            for s, i in zip(scores, ids, strict=True):
                s = np.concatenate(s)
                found.append(best(s, np.concatenate(i), np.ones(len(s), dtype=bool), k))
            yield _lists(rows[0]["block"], rows[0]["length"], rows[0]["part"], query_ids, found)

    gid = F.concat_ws(":", "block", "length", "part")
    dealt = lists.withColumn("part", F.floor(F.col("part") / fan_in).cast("int")).withColumn("gid", gid)
    return dealt.repartition("gid").sortWithinPartitions("gid").mapInArrow(merge, _LISTS)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: for each row that ``is_query`` selects, the
    ``k`` other rows of the highest integer inner products (all, if there are fewer), ties to
    the smaller id.

    Components count as floor(scale * x). Null vectors, vectors with null or non-finite
    components and rows without an id take no part; vectors of different lengths are not
    compared; an empty vector scores 0 with others of its kind. A row is another than the query
    when its id differs, so repeated rows of a query's id are not its candidates, and a repeated
    candidate is listed as often as it occurs. Columns with other names are ignored.
    """
    spark = vectors.sparkSession
    usable = stored(integer_vectors(vectors, scale), "vectors-integer")
    total = usable.count()
    queries = usable.where(is_query).dropDuplicates(["vec_id", "length", "data"])
    blocks = stored(packed(queries, QUERY_BLOCK, queries.count()), "query-blocks").select(
        F.col("part").alias("block"),
        "length",
        F.col("ids").alias("query_ids"),
        F.col("data").alias("query_data"),
    )
    shards = stored(packed(usable, SHARD, total), "shards")
    # every query block meets every shard of its length: the stated queries against all rows, as
    # pairs of packed blocks, spread over tasks by pair
    pairs = stored(
        shards.select("part", "length").join(blocks.select("block", "length"), "length"), "tiles"
    ).repartition(max(1, spark.sparkContext.defaultParallelism), "block", "part", "length")
    tiles = pairs.join(shards, ["part", "length"]).join(blocks, ["block", "length"])
    lists = stored(tile_lists(tiles, k), "tile-lists")
    parts = max(1, -(-total // SHARD))
    while parts > 1:
        lists = stored(merged_lists(lists, k, FAN_IN), "lists")
        parts = -(-parts // FAN_IN)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], "<i4")
                begin = np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.frombuffer(row["query_ids"], "<i8"), counts)),
                        pa.array((np.arange(counts.sum()) - np.repeat(begin, counts) + 1).astype(np.int32)),
                        pa.array(np.frombuffer(row["ids"], "<i8")),
                        pa.array(np.frombuffer(row["scores"], "<i8")),
                    ],
                    names=["query_id", "rank", "vec_id", "score"],
                )

    return lists.mapInArrow(rows, "query_id long, rank int, vec_id long, score long")
