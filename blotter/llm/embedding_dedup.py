"""Near-duplicate embeddings by p-stable hashing.

Equal vectors of a label form a class. Class representatives are normalised and hashed by
quantised random projections into several tables; vectors that share a bucket are compared
exactly, in blocks. A pair is counted in the first table where both share a bucket, so nothing
is counted twice and no pair is ever sent anywhere: a block sends each vector's number of links
and a forest that connects what it linked.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import block_pairs, compared, forest, groups, mixed, rows_of, stored
from blotter.llm.components import connected_components

COSINE = 0.98
#: Width of a quantised step, for vectors of length 1.
WIDTH = 1.5
#: Chance that a pair at exactly COSINE shares a bucket of some table.
RECALL = 0.9999
#: Vectors of a bucket that are compared at a time.
BLOCK = 128
SEED = 20


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised projection of two points at a distance is the same."""
    r = width / distance
    normal = 0.5 * (1 + math.erf(-r / math.sqrt(2)))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_plan(count: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Projections per table and tables: so many projections that unrelated (orthogonal) vectors
    rarely meet among ``count``, then so many tables that pairs at ``cosine`` are found."""
    near = collision(math.sqrt(2 - 2 * cosine))
    projections = max(4, math.ceil(math.log(max(count, 2)) / -math.log(collision(math.sqrt(2)))))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - near**projections))
    return projections, tables


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, key (of label and values), size and the values as doubles in bytes, for the
    rows that can link: label not null, values not null, finite and not all zero."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], [], []]
            rows = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            for vec_id, values, label in rows:
                if values is None or label is None or any(v is None for v in values):
                    continue
                x = np.array(values, dtype=np.float64) + 0.0  # -0.0 becomes 0.0
                if len(x) == 0 or not np.isfinite(x).all() or not x.any():
                    continue
                data = x.tobytes()
                key = hashlib.blake2b(f"{label}|".encode() + data, digest_size=16).hexdigest()
                for column, value in zip(out, (vec_id, label, key, len(x), data), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out[0], batch.schema.field(0).type),
                    pa.array(out[1], batch.schema.field(2).type),
                    pa.array(out[2], pa.string()),
                    pa.array(out[3], pa.int32()),
                    pa.array(out[4], pa.binary()),
                ],
                names=["vec_id", "label", "key", "size", "data"],
            )

    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return vectors.select("vec_id", "embedding", "label").mapInArrow(
        read, f"vec_id {kinds['vec_id']}, label {kinds['label']}, key string, size int, data binary"
    )


def _unit(data: pa.ChunkedArray) -> np.ndarray:
    x = rows_of(data, np.float64)
    # scaled first, so that squares of very large or small values stay finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@lru_cache(maxsize=512)
def _directions(length: int, table: int, projections: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for every task: drawn from the vectors' length and the table's number."""
    rng = np.random.RandomState([SEED, length, table])
    return rng.normal(size=(length, projections)), rng.uniform(0, WIDTH, projections)


def table_hashes(unit: np.ndarray, projections: int, tables: int) -> np.ndarray:
    """One 64-bit bucket per vector for each of the first ``tables`` tables."""
    out = np.zeros((len(unit), tables), dtype=np.uint64)
    for t in range(tables):
        directions, shift = _directions(unit.shape[1], t, projections)
        steps = np.floor((unit @ directions + shift) / WIDTH).astype(np.int64).astype(np.uint64)
        with np.errstate(over="ignore"):
            for p in range(projections):
                out[:, t] = mixed(out[:, t] * np.uint64(0x9E3779B97F4A7C15) + steps[:, p])
    return out


def bucket_rows(classes: DataFrame, projections: int, tables: int) -> DataFrame:
    """key, table, bucket (of the table's hash, the label and the vector length)."""

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes = table.column("size").to_numpy()
            for size in np.unique(sizes):
                part = table.filter(pa.array(sizes == size))
                found = table_hashes(_unit(part.column("data")), projections, tables)
                salt = np.array([hash_label(v) for v in part.column("label").to_pylist()], dtype=np.uint64)
                with np.errstate(over="ignore"):
                    found = mixed(found + salt[:, None] * np.uint64(2 * int(size) + 1))
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.arange(n), tables)).cast(pa.int32()),
                        pa.array(np.tile(np.arange(tables, dtype=np.int32), n)),
                        pa.array(found.reshape(-1).view(np.int64)),
                    ],
                    names=["row", "table", "bucket"],
                ).set_column(0, "key", part.column("key").combine_chunks().take(pa.array(np.repeat(np.arange(n), tables))))

    return classes.select("key", "label", "size", "data").mapInArrow(hash_rows, "key string, table int, bucket long")


def hash_label(label) -> int:
    return int.from_bytes(hashlib.blake2b(str(label).encode(), digest_size=8).digest(), "little")


def linked_blocks(rows: DataFrame, projections: int, tables: int, cosine: float) -> DataFrame:
    """Compare the vectors of each block pair (``gid``): key, links, and root when connected."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in groups(batches, "gid"):
            keys = part.column("key").to_pylist()
            if len(keys) < 2:
                continue
            unit = _unit(part.column("data"))
            side = part.column("side").to_numpy()
            copies = part.column("copies").to_numpy()
            near = np.triu(unit @ unit.T >= cosine, 1)
            near &= compared(side)
            left, right = np.nonzero(near)
            if len(left) == 0:
                continue
            # of the tables where a pair meets, only the first counts it
            hashes = table_hashes(unit, projections, int(part.column("table")[0].as_py()))
            fresh = np.ones(len(left), dtype=bool)
            for t in range(hashes.shape[1]):
                fresh &= hashes[left, t] != hashes[right, t]
            left, right = left[fresh], right[fresh]
            links = np.bincount(left, copies[right], len(keys)) + np.bincount(right, copies[left], len(keys))
            root = dict(forest(len(keys), left, right))
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[k] for k in some], pa.string()),
                    pa.array(links[some].astype(np.int64)),
                    pa.array([keys[root.get(int(k), int(k))] for k in some], pa.string()),
                ],
                names=["key", "links", "root"],
            )

    return rows.mapInArrow(compare, "key string, links long, root string")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id,
    kept.

    Links join vectors of one label, not null, whose cosine in double precision is at least
    ``cosine``; a vector that is null, empty, zero or holds a null or non-finite value, or whose
    label is null, has none (component_id is its own id). Vectors of different lengths do not
    link. Copies are links of each other: they are counted from the size of their class, never
    paired. A component's id is the smallest id in it; a null id never is. Repeated rows count
    as further vectors. Columns with other names are ignored.
    """
    usable = stored(usable_vectors(vectors), "vectors")
    classes = stored(
        usable.groupBy("key").agg(
            F.count("*").alias("copies"),
            F.min("vec_id").alias("least_id"),
            F.first("label").alias("label"),
            F.first("size").alias("size"),
            F.first("data").alias("data"),
        ),
        "vector-classes",
    )
    projections, tables = table_plan(classes.count(), cosine, recall)
    buckets = stored(bucket_rows(classes, projections, tables), "vector-buckets")
    counts = buckets.groupBy("table", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    # the size of the bucket rides with its members, the vectors join only those
    members = block_pairs(buckets.join(counts, ["table", "bucket"]), ["table", "bucket"], BLOCK)
    rows = members.join(classes.select("key", "copies", "data"), "key").select(
        "gid", "table", "side", "key", "copies", "data"
    )
    found = stored(
        linked_blocks(
            rows.repartition(F.col("gid")).sortWithinPartitions("gid"), projections, tables, cosine
        ),
        "vector-links",
    )
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    component = connected_components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    joined = classes.select("key", "copies", "least_id").join(links, "key", "left").join(
        component.withColumnRenamed("node", "key"), "key", "left"
    )
    grouped = joined.withColumn("component", F.coalesce("component", "key"))
    # written, so that the join below is one of plain shuffles, whose hot components AQE splits
    least = stored(grouped.groupBy("component").agg(F.min("least_id").alias("component_id")), "components")
    per_class = stored(
        grouped.join(least, "component").select(
            "key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
        ),
        "vector-results",
    )
    linkable = usable.select("vec_id", "key").join(per_class, "key").select("vec_id", "n_links", "component_id")
    return linkable.unionByName(_unlinkable(vectors)).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


def _unlinkable(vectors: DataFrame) -> DataFrame:
    """The rows that ``usable_vectors`` leaves out, by the same rule."""
    values = F.col("embedding")
    bad = (
        values.isNull()
        | F.col("label").isNull()
        | (F.size(values) == 0)
        | F.exists(values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        | ~F.exists(values, lambda v: v != 0)
    )
    return vectors.where(F.coalesce(bad, F.lit(True))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
