"""Helpers shared by the operators: tables, written intermediates, Arrow groups, hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.session import scratch_path

#: Rows per Arrow batch handed to a Python task; bounds what a task holds when texts are long.
ARROW_ROWS = 512
#: Bytes of such a batch, beyond which it is sent as it is.
ARROW_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings for jobs with Python tasks."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate below the shared checkpoint folder and read it back: lineage is
    cut, lost executors cost no recomputation, and the planner knows the true size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5, is 0: rows whose labels are never learned from.
    A null id is not held out (its label cannot be joined anyway)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """Runs of equal ``key`` in a partition sorted by it. Holds one run at a time, so callers
    bound the size of a run."""
    run: list[pa.Table] = []
    current = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        keys = table.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(keys)], strict=True):
            if run and keys[a] != current:
                yield current, pa.concat_tables(run)
                run = []
            current = keys[a]
            run.append(table.slice(int(a), int(b - a)))
    if run:
        yield current, pa.concat_tables(run)


def rows_of(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """A binary column of equally long values as a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=dtype).reshape(len(values), -1)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (member, smallest member) that connect what the given links connect."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    linked = np.flatnonzero(root != np.arange(n))
    return [(int(i), int(root[i])) for i in linked]


def block_pairs(members: DataFrame, on: list[str], block: int) -> DataFrame:
    """Deal the members (key, ``n`` of their bucket) of each bucket into blocks of about
    ``block`` and give each the pairs of blocks it takes part in: ``gid`` names the pair,
    ``side`` is 2 in a block's pair with itself, else 0 or 1. Small buckets are one block."""
    return (
        members.withColumn("blocks", F.ceil(F.col("n") / F.lit(float(block))).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("key", *on), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("gid", F.xxhash64(*on, F.least("own", "other"), F.greatest("own", "other")))
        .withColumn("side", F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int")))
        .drop("blocks", "own", "other", "n")
    )


def compared(side: np.ndarray) -> np.ndarray:
    """Which rows of a block pair are compared: all in a block's own, else across."""
    return (side[:, None] != side[None, :]) | (side[:, None] == 2)


# --- hashing of words and word shingles, vectorised over a batch of texts -----------------

_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_MASK = (1 << 64) - 1
_LAG = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(16)], dtype=np.uint64)
#: The white space of the word rule, space and \x09 to \x0D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 20)
        for name, p in (("up", _P), ("down", _P_INV)):
            step = np.full(size, p, dtype=np.uint64)
            step[0] = 1
            _POWERS[name] = np.cumprod(step, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none), and the
    position of each text's first word, with the total at the end."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[first:last]
    at = offsets - first
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = ~_SPACE[data]
    # a word also starts and ends at the border of a text
    border = np.zeros(len(data) + 1, dtype=bool)
    border[at] = True
    before = np.r_[False, inside[:-1]]
    after = np.r_[inside[1:], False]
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    ends = np.flatnonzero(inside & (~after | border[1:])) + 1
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
        hashes = mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, at)


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of each text, and where each text's begin. A text
    of fewer words has one shingle of all its words; a text without words has none."""
    hashes, at = word_hashes(texts)
    words = np.diff(at)
    count = np.where(words >= width, words - width + 1, (words > 0).astype(np.int64))
    begin = np.r_[0, np.cumsum(count)]
    total = int(begin[-1])
    if total == 0:
        return np.zeros(0, np.uint64), begin
    where = np.repeat(at[:-1], count) + (np.arange(total) - np.repeat(begin[:-1], count))
    span = np.repeat(np.minimum(words, width), count)
    out = span.astype(np.uint64)
    padded = np.r_[hashes, np.zeros(width, np.uint64)]
    with np.errstate(over="ignore"):
        for k in range(width):
            out += np.where(span > k, padded[where + k] * _LAG[k], np.uint64(0))
        return mixed(out), begin


# --- calibration ---------------------------------------------------------------------------


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights (bias first) of a logistic curve over standardised columns, by Newton steps,
    folded back to the original scale. Only one class: a constant at its smoothed share."""
    x = np.asarray(x, dtype=np.float64).reshape(len(y), -1)
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    flat = np.r_[np.log(share / (1 - share)), np.zeros(x.shape[1])]
    if len(y) == 0 or y.min() == y.max():
        return flat
    mean, scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
    z = np.c_[np.ones(len(y)), (x - mean) / scale]
    w = flat.copy()
    penalty = ridge * np.r_[0.0, np.ones(x.shape[1])] * len(y)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -35, 35)))
        grad = z.T @ (p - y) + penalty * w
        hess = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    slope = w[1:] / scale
    return np.r_[w[0] - (slope * mean).sum(), slope]


def logistic(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    z = weights[0] + np.asarray(x, dtype=np.float64).reshape(len(x), -1) @ weights[1:]
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))
