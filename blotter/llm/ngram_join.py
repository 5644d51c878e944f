"""Jaccard join of word shingles by chosen paths.

Texts of equal shingle sets form a class; class representatives are joined:

* A minhash sketch samples shared tokens. In each run, every set chooses tokens of its sketch by
  a hash of the path so far and the token, about one token in expectation at the threshold, and
  goes to the child buckets of the chosen tokens. Frequent tokens, as a sample tells them, are left
  to the sets that hold little else: strangers do not meet by a common line. Buckets above ``LIMIT`` are split again, by the
  tokens that most of the bucket does not hold: those would only make the same bucket anew. Sets
  that hold enough of a bucket's common tokens link to one of them, and a set chooses the more of
  its other tokens the more common ones it holds, so that similar sets still share about one.
* Buckets that are small or at the last depth are compared by brute force on sketches, in
  blocks. Those of several blocks are first compared with a few pivots: what is near a common pivot
  is one group, and only different groups are compared further. Each block sends a forest of its
  candidates, never its pairs.
* Runs are repeated until pairs at the threshold are found with the target recall.
* Candidates are grouped into components, whose sets are compared exactly, again in blocks:
  each block pair sends the number of links per text and a forest of them.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import compared, forest, groups, mixed, rows_of, shingles, stored
from blotter.llm.components import connected_components

WIDTH = 5
JACCARD = 0.8
RECALL = 0.999
#: Values of a sketch, and how far below the threshold its estimate still makes a candidate
#: (in standard deviations of the estimate at the threshold).
SKETCH = 128
MARGIN = 5.0
#: Buckets up to this size are compared, larger ones split, at most DEPTH times.
LIMIT = 128
DEPTH = 5
#: The depth at which the runs reach the recall: that of the deepest buckets.
PLANNED_DEPTH = DEPTH
#: Sets in which tokens of more holders than LIMIT are looked for, and in how many of these such a token
#: is at least seen: there are so at most about 65,536.
FREQUENT_SAMPLE = 8192
FREQUENT_SEEN = 16
#: A token that this share of a bucket holds is common in it, as seen in about SAMPLE members.
COMMON = 0.5
SAMPLE = 32
#: Sketches of a block of the brute-force comparison.
SKETCH_BLOCK = 256
#: Members of a larger bucket that all its members are compared with first.
PIVOTS = 8
#: Blocks of what is left after that are so many times larger: each member goes to every other block,
#: so larger ones mean fewer copies; a pair of them is 2048 sketches of 128 bytes.
DEALT = 4
#: Texts and shingles of a block of the exact comparison.
BLOCK = 128
BLOCK_SHINGLES = 500_000
_MULTIPLIERS = np.random.RandomState(41).randint(0, 1 << 31, SKETCH).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def runs_needed(recall: float = RECALL, depth: int = PLANNED_DEPTH) -> int:
    """Runs until a pair at the threshold meets in a bucket of the planned depth. It shares one
    chosen token per level in expectation, so a path goes on with chance 1 - exp(-chance below)."""
    chance = 1.0
    for _ in range(depth):
        chance = 1 - math.exp(-chance)
    return math.ceil(math.log(1 - recall) / math.log(1 - chance))


# --- sketches and classes ------------------------------------------------------------------


def _sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    hashes, begin = shingles(texts, width)
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        yield np.unique(hashes[a:b])


def _key(tokens: np.ndarray) -> str | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).hexdigest() if len(tokens) else None


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, key (128-bit digest of the shingle set; null: no words), size and minhash sketch of
    every whole text."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch.column(1), width))
            some = [k for k, s in enumerate(sets) if len(s)]
            values: list[bytes | None] = [None] * len(sets)
            if some:
                tokens = np.concatenate([sets[k] for k in some])
                begin = np.r_[0, np.cumsum([len(sets[k]) for k in some])[:-1]]
                low, high = tokens.astype(np.uint32), (tokens >> np.uint64(32)).astype(np.uint32)
                least = np.empty((len(some), SKETCH), dtype="<u4")
                with np.errstate(over="ignore"):
                    for p, m in enumerate(_MULTIPLIERS):
                        least[:, p] = np.minimum.reduceat((low * m) ^ high, begin)
                for k, row in zip(some, least, strict=True):
                    values[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([_key(s) for s in sets], pa.string()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(values, pa.binary()),
                ],
                names=["doc_id", "key", "size", "sketch"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(sketch, f"doc_id {kind}, key string, size int, sketch binary")


def with_key(docs: DataFrame, name: str, width: int = WIDTH) -> DataFrame:
    """``docs`` with the key of each text's shingle set."""
    names = docs.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_key(s) for s in _sets(batch.column(names.index("text")), width)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.string())], names=[*names, name])

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())]))


# --- chosen paths --------------------------------------------------------------------------


def frequent_tokens(classes: DataFrame) -> np.ndarray:
    """Sorted tokens (place in the sketch above the value) that more than LIMIT sets hold, as told by a
    sample whose size does not grow with the sets."""
    every = max(classes.count() // FREQUENT_SAMPLE, 1)
    least = max(LIMIT / every, FREQUENT_SEEN)

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = rows_of(batch.column("sketch"), "<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(SKETCH), pa.int32()), pa.array([v.tobytes() for v in values.T], pa.binary())],
                    names=["place", "seen"],
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, seen in zip(batch.column("place").to_pylist(), batch.column("seen").to_pylist(), strict=True):
                value, held = np.unique(np.frombuffer(b"".join(seen), dtype="<u4"), return_counts=True)
                tokens = value[held > least].astype(np.int64) + (place + 1 << 32)
                yield pa.RecordBatch.from_arrays([pa.array(tokens)], names=["token"])

    sample = classes.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).select("sketch")
    seen = sample.mapInArrow(columns, "place int, seen binary").groupBy("place").agg(F.collect_list("seen").alias("seen"))
    return np.sort(np.array([r["token"] for r in seen.mapInArrow(count, "token long").collect()], dtype=np.uint64))


def common_tokens_of(large: DataFrame, threshold: float) -> DataFrame:
    """Per bucket of ``large`` (path, n, key, sketch): ``centre`` (a sketch), ``common`` (a byte per
    value: 1 where most of the bucket holds that of the centre) and ``pivot``, a member that holds
    enough of these to be a candidate of the centre. Without such a member fewer values are common, so
    that no other member holds as many. Seen in a sample whose size does not grow with the bucket."""
    least = _least_equal(threshold)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"path": batch.column("path").to_pylist(), "centre": [], "common": [], "pivot": []}
            for seen in batch.column("seen").to_pylist():
                values = np.frombuffer(b"".join(m["sketch"] for m in seen), dtype="<u4").reshape(len(seen), -1)
                # a value of more than half is the middle one
                centre = np.sort(values, axis=0)[len(values) // 2]
                share = (values == centre).mean(axis=0)
                common = share >= COMMON
                held = np.count_nonzero((values == centre) & common, axis=1)
                pivot = seen[int(held.argmax())]["key"] if held.max() >= least else None
                if pivot is None and np.count_nonzero(common) >= least:
                    common[np.argsort(-share, kind="stable")[max(least - 1, 0) :]] = False
                out["centre"].append(centre.tobytes())
                out["common"].append(common.astype(np.uint8).tobytes())
                out["pivot"].append(pivot)
            types = [pa.int64(), pa.binary(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    sample = large.where(F.pmod(F.xxhash64("key", "path"), F.col("n")) < SAMPLE)
    seen = sample.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("key", "sketch"))).alias("seen"))
    return seen.mapInArrow(look, "path long, centre binary, common binary, pivot string")


def child_paths(rows: DataFrame, runs: int, threshold: float, frequent: np.ndarray | None = None) -> DataFrame:
    """key and path for the tokens that each set chooses below its bucket, and in one row of each set
    that is a candidate of its bucket's centre the pivot. Rows: key, sketch and, below the roots, path
    (their bucket) with its centre, common and pivot.

    Two similar sets share at least ``threshold`` of their tokens; what the one that holds fewer common
    ones has not among these, they share of the others. So each chooses of its others one in as many
    as are left: a token that both hold is chosen by both if by the one of fewer common ones.

    At the roots the ``frequent`` tokens are the common ones, up to half of what similar sets share. Sets
    that hold more of them choose of these too, as if none was frequent: two such sets may share no others."""
    below = "path" in rows.columns
    least = _least_equal(threshold)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            keys = table.column("key").combine_chunks()
            values = rows_of(table.column("sketch"), "<u4")
            tokens = values.astype(np.uint64)
            tokens += np.arange(1, SKETCH + 1, dtype=np.uint64)[None, :] << np.uint64(32)
            held = np.isin(tokens, frequent) if not below else None
            tokens = mixed(tokens)
            if below:
                parents = [table.column("path").to_numpy().view(np.uint64)[:, None]]
                held = (values == rows_of(table.column("centre"), "<u4")) & (rows_of(table.column("common"), np.uint8) == 1)
            else:
                parents = [mixed(np.full((1, 1), r + 1, dtype=np.uint64)) for r in range(runs)]
            many = np.count_nonzero(held, axis=1)
            most = max(least - 1, 0) if below else threshold * SKETCH / 2
            bound = np.where(held, np.uint64(0), _one_in(threshold * SKETCH - np.minimum(many, most))[:, None])
            if not below:
                bound[held & (many > most)[:, None]] = _one_in(threshold * SKETCH)
            found = [np.nonzero(mixed(tokens ^ p) < bound) for p in parents]
            row = np.concatenate([f[0] for f in found])
            with np.errstate(over="ignore"):
                path = np.concatenate(
                    [
                        mixed(tokens[f] + np.uint64(3) * np.broadcast_to(p, tokens.shape)[f])
                        for f, p in zip(found, parents, strict=True)
                    ]
                )
            # a set's first path also tells its pivot; one that has a pivot and chooses nothing has no path
            chosen, first = np.unique(row, return_index=True)
            near = many >= least if below else np.zeros(len(many), dtype=bool)
            alone = np.setdiff1d(np.flatnonzero(near), chosen)
            of = np.full(len(row), -1, dtype=np.int64)
            of[first] = np.where(near[chosen], chosen, -1)
            of = np.r_[of, alone]
            pivots = table.column("pivot").combine_chunks() if below else pa.nulls(len(keys), pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(np.r_[row, alone])),
                    pa.concat_arrays([pa.array(path.view(np.int64)), pa.nulls(len(alone), pa.int64())]),
                    pivots.take(pa.array(of, mask=of < 0)),
                ],
                names=["key", "path", "pivot"],
            )

    columns = ["key", "sketch", "path", "centre", "common", "pivot"] if below else ["key", "sketch"]
    return rows.select(*columns).mapInArrow(choose, "key string, path long, pivot string")


def _one_in(left):
    """The bound below which one in ``left`` of all hashes are."""
    return np.minimum(2.0**64 / np.maximum(left, 1.0), 2.0**64 - 4096).astype(np.uint64)


def final_buckets(classes: DataFrame, runs: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """key, path, n of the buckets to compare: no set is dropped but those alone in a bucket. And the
    links (a, b) of sets to the pivots of buckets that were split."""
    done, near = [], []
    rows = child_paths(classes, runs, threshold, frequent_tokens(classes))
    for depth in range(1, DEPTH + 1):
        level = stored(rows, f"paths-{depth}")
        near.append(level.where("pivot IS NOT NULL AND pivot <> key").select(F.col("key").alias("a"), F.col("pivot").alias("b")))
        level = level.where("path IS NOT NULL").select("key", "path")
        counts = level.groupBy("path").agg(F.count("*").alias("n")).where(F.col("n") > 1)
        level = stored(level.join(counts, "path"), f"buckets-{depth}")
        final = F.col("n") <= LIMIT if depth < DEPTH else F.lit(True)
        done.append(level.where(final).select("key", "path", "n"))
        large = level.where(~final)
        if depth == DEPTH or large.isEmpty():
            break
        large = stored(large.select("key", "path", "n").join(classes.select("key", "sketch"), "key"), f"large-{depth}")
        rows = child_paths(large.join(stored(common_tokens_of(large, threshold), f"common-{depth}"), "path"), runs, threshold)
    buckets, links = done[0], near[0]
    for more in done[1:]:
        buckets = buckets.unionByName(more)
    for more in near[1:]:
        links = links.unionByName(more)
    return buckets, links


def _least_equal(threshold: float) -> int:
    """Equal bytes of two cut sketches that make a candidate: the threshold less the margin. Equal
    values by chance count for one in 256, as the sketches are cut to bytes."""
    chance = threshold - MARGIN * math.sqrt(threshold * (1 - threshold) / SKETCH)
    return math.floor(SKETCH * (chance + (1 - chance) / 256))


def pivot_masks(large: DataFrame, cut: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Compare the members of large buckets (path, key, n, cut) with a few pivots of their bucket.

    Returns the members with ``mask`` (bit j: near pivot j; null bits are 0) and ``pivot`` (the first
    near one), and path and ``pivots``. Pivots are the least members by PIVOTS hashes, found by
    partial aggregates; they go to every block of their bucket, so a bucket is never gathered."""
    by_hash = [F.min(F.struct(F.xxhash64(F.lit(j), "key").alias("h"), "key"))["key"].alias(f"p{j}") for j in range(PIVOTS)]
    chosen = stored(
        large.groupBy("path")
        .agg(*by_hash, F.first("n").alias("n"))
        .select("path", "n", F.array_distinct(F.array(*(f"p{j}" for j in range(PIVOTS)))).alias("pivots")),
        "pivots",
    )
    blocks = F.ceil(F.col("n") / F.lit(float(SKETCH_BLOCK))).cast("int")
    gid = F.xxhash64("path", "own").alias("gid")
    members = large.withColumn("own", F.pmod(F.xxhash64("key", "path"), blocks).cast("int")).select(
        gid, F.lit(-1).alias("pivot_at"), "path", "key", "cut"
    )
    pivots = (
        chosen.select("path", "n", F.posexplode("pivots").alias("pivot_at", "key"))
        .join(cut, "key")
        .withColumn("own", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(gid, "pivot_at", "path", "key", "cut")
    )
    least = _least_equal(threshold)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in groups(batches, "gid"):
            at = part.column("pivot_at").to_numpy()
            # two buckets whose numbers collide are compared apart
            path = part.column("path").to_numpy()
            values = rows_of(part.column("cut"), np.uint8)
            rows = np.flatnonzero(at < 0)
            if len(rows) == 0:
                continue
            mask = np.zeros(len(rows), dtype=np.int32)
            first = np.full(len(rows), -1, dtype=np.int64)
            for k in np.flatnonzero(at >= 0)[::-1]:
                near = (np.count_nonzero(values[rows] == values[k], axis=1) >= least) & (path[rows] == path[k])
                mask[near] |= np.int32(1 << int(at[k]))
                first[near] = k
            keys = part.column("key").combine_chunks()
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(path[rows]),
                    keys.take(taken),
                    part.column("cut").combine_chunks().take(taken),
                    pa.array(mask),
                    keys.take(pa.array(first, mask=first < 0)),
                ],
                names=["path", "key", "cut", "mask", "pivot"],
            )

    found = (
        members.unionByName(pivots)
        .repartition(F.col("gid"))
        .sortWithinPartitions("gid", "pivot_at")
        .mapInArrow(compare, "path long, key string, cut binary, mask int, pivot string")
    )
    return stored(found, "pivot-masks"), chosen.select("path", "pivots")


def _bucket_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per path: its masks united where they share a pivot. A group is what hangs together; members
    near no pivot and of groups that fill no block are group -1. Blocks of a bucket are numbered
    through its groups."""
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("path", "mask", "family", "begin", "blocks", "total")}
        for path, counted in zip(batch.column("path").to_pylist(), batch.column("counted").to_pylist(), strict=True):
            family: dict[int, int] = {}
            for mask in (c["mask"] for c in counted if c["mask"]):
                joined = mask
                for other in [f for f in set(family.values()) if f & joined]:
                    joined |= other
                for m, f in list(family.items()):
                    if f & joined:
                        family[m] = joined
                family[mask] = joined
            block = batch.column("block")[0].as_py()
            size: Counter[int] = Counter()
            for c in counted:
                size[family.get(c["mask"], -1)] += c["n"]
            family = {m: f if size[f] >= block else -1 for m, f in family.items()}
            size = Counter()
            for c in counted:
                size[family.get(c["mask"], -1)] += c["n"]
            blocks = {f: -(-n // block) for f, n in size.items()}
            begin, total = {}, 0
            for f in sorted(blocks):
                begin[f] = total
                total += blocks[f]
            for c in counted:
                f = family.get(c["mask"], -1)
                for k, v in (("path", path), ("mask", c["mask"]), ("family", f), ("begin", begin[f]), ("blocks", blocks[f]), ("total", total)):
                    out[k].append(v)
        types = {"path": pa.int64(), "mask": pa.int32()}
        yield pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.int64())) for k, v in out.items()], names=list(out))


def _other_blocks():
    """Blocks of its bucket that a member goes to: all for a member of group -1, else those before and
    behind its own group's. A group of many blocks so takes a row per block of other groups only."""
    return F.expr(
        "CASE WHEN family = -1 THEN sequence(0L, total - 1) "
        "ELSE concat(IF(begin > 0, sequence(0L, begin - 1), array()), "
        "IF(begin + blocks < total, sequence(begin + blocks, total - 1), array())) END"
    )


def bucket_links(buckets: DataFrame, cut: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that connect the candidates of every bucket (path, key, n), each bucket apart.

    A bucket of up to DEALT * SKETCH_BLOCK members is one block. In a larger one, members near a pivot
    link to it, and families of pivots that share members are one group already: only blocks of different
    groups, and of members near no pivot, are compared, and a block pair links groups, not members.
    A bucket of n texts that are all alike so takes n rows, not n times its blocks."""
    rows = buckets.join(cut, "key")
    fits = F.col("n") <= DEALT * SKETCH_BLOCK
    empty = F.lit(None).cast("string").alias("family")
    own = rows.where(fits).select(F.xxhash64("path").alias("gid"), "path", F.lit(2).alias("side"), "key", "cut", empty)
    large = stored(rows.where(~fits), "large-buckets")
    if large.isEmpty():
        return candidate_forest(own, threshold)
    masks, pivots = pivot_masks(large, cut, threshold)
    to_pivot = masks.where("pivot IS NOT NULL AND pivot <> key").select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(PIVOTS - 1)), lambda j: F.expr("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1), j)) != 0)
    between = (
        masks.select("path", "mask")
        .distinct()
        .where("bit_count(mask) > 1")
        .join(pivots, "path")
        .select(F.transform(bits, lambda j: F.get("pivots", j)).alias("near"))
        .select(F.col("near")[0].alias("a"), F.explode("near").alias("b"))
        .where("a <> b")
    )
    known = stored(to_pivot.unionByName(between).distinct(), "pivot-links")
    # what pivots of any run connect is one family in every bucket
    reached = stored(connected_components(known).withColumnRenamed("node", "key"), "pivot-families")
    root = F.coalesce("component", "key")
    roots = (
        pivots.select("path", F.explode("pivots").alias("key"))
        .join(reached, "key", "left")
        .groupBy("path")
        .agg(F.sort_array(F.collect_set(root)).alias("roots"))
    )
    place = F.array_position("roots", F.col("root"))
    grouped = stored(
        masks.select("path", "key", "cut")
        .join(reached, "key", "left")
        .withColumn("root", root)
        .join(roots, "path")
        .select("path", "key", "cut", "root", F.when(place > 0, F.call_function("shiftleft", F.lit(1), (place - 1).cast("int"))).otherwise(0).alias("mask")),
        "bucket-members",
    )
    counted = grouped.groupBy("path", "mask").agg(F.count("*").alias("n"))
    per_path = counted.groupBy("path").agg(F.collect_list(F.struct("mask", "n")).alias("counted"))
    families = stored(
        per_path.withColumn("block", F.lit(DEALT * SKETCH_BLOCK)).mapInArrow(
            _bucket_groups, "path long, mask int, family long, begin long, blocks long, total long"
        ),
        "bucket-families",
    )
    # written, so that AQE splits a hot bucket in the join with its few families
    several = families.where("family = -1 OR blocks < total")
    dealt = (
        grouped.join(several, ["path", "mask"])
        .withColumn("own", F.col("begin") + F.pmod(F.xxhash64("key", F.lit(1)), F.col("blocks")))
        .withColumn("other", F.explode(_other_blocks()))
        .select(
            F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other")).alias("gid"),
            "path",
            F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int")).alias("side"),
            "key",
            "cut",
            F.col("root").alias("family"),
        )
    )
    return candidate_forest(own.unionByName(dealt), threshold).unionByName(known)


def candidate_forest(rows: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that connect the candidates of each block pair (gid, path, side, key, cut,
    family): sets whose sketches agree in enough values. Members of a family hang together already,
    so a family counts as one node."""
    least = _least_equal(threshold)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_keys: list[str] = []
        right_keys: list[str] = []
        for _, part in groups(batches, "gid"):
            if part.num_rows < 2:
                continue
            values = rows_of(part.column("cut"), np.uint8)
            path = part.column("path").to_numpy()
            near = np.zeros((len(values), len(values)), dtype=bool)
            for k in range(len(values) - 1):
                near[k, k + 1 :] = np.count_nonzero(values[k + 1 :] == values[k], axis=1) >= least
            near &= path[:, None] == path[None, :]
            left, right = np.nonzero(near & compared(part.column("side").to_numpy()))
            if len(left):
                keys = part.column("key").to_pylist()
                names = [f or k for f, k in zip(part.column("family").to_pylist(), keys, strict=True)]
                _, first, node = np.unique(names, return_index=True, return_inverse=True)
                for a, b in forest(len(first), node[left], node[right]):
                    left_keys.append(keys[first[a]])
                    right_keys.append(keys[first[b]])
            if len(left_keys) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(left_keys), pa.array(right_keys)], names=["a", "b"])
                left_keys, right_keys = [], []
        if left_keys:
            yield pa.RecordBatch.from_arrays([pa.array(left_keys), pa.array(right_keys)], names=["a", "b"])

    return rows.repartition(F.col("gid")).sortWithinPartitions("gid").mapInArrow(compare, "a string, b string")


# --- the exact comparison ------------------------------------------------------------------


def common_tokens(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, from the tokens that several hold."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.r_[True, tokens[1:] != tokens[:-1]]
    column = np.cumsum(new) - 1
    several = np.bincount(column)[column] > 1
    owner = owner[several]
    _, column = np.unique(column[several], return_inverse=True)
    total = np.zeros((n, n))
    width = int(column.max()) + 1 if len(column) else 0
    for a in range(0, width, columns):
        inside = slice(*np.searchsorted(column, [a, a + columns]))
        held = np.zeros((n, min(columns, width - a)), dtype=np.float32)
        held[owner[inside], column[inside] - a] = 1
        total += held @ held.T
    return total


def block_tiles(members: DataFrame) -> DataFrame:
    """Deal each component's members (key, root, size) into block pairs: ``tiles`` lists gid and
    side. A component that fits is one block. A larger one is dealt by size, as sets whose sizes
    differ by more than the threshold allows cannot be similar: levels of ratio 1.26 meet only
    themselves and their neighbours, each in blocks of bounded texts and shingles."""
    total = stored(
        members.groupBy("root").agg(F.count("*").alias("texts"), F.sum("size").alias("shingles")), "component-sizes"
    )
    fits = (F.col("texts") <= BLOCK) & (F.col("shingles") <= BLOCK_SHINGLES)
    level = F.floor(F.log(F.col("size").cast("double")) / math.log(1.26)).cast("int")
    # written, as the counts per level would otherwise be taken where the join left a component's
    # members: all in one task, which AQE then may not split
    dealt = stored(
        members.join(total, "root")
        .withColumn("level", F.when(fits, F.lit(0)).otherwise(level))
        .select("key", "root", "level", "size", "copies", "least_id"),
        "dealt",
    )
    per_level = stored(
        dealt.groupBy("root", "level").agg(
            F.greatest(
                F.ceil(F.count("*") / float(BLOCK)), F.ceil(F.sum("size") / float(BLOCK_SHINGLES))
            ).alias("blocks")
        ),
        "levels",
    )
    next_up = per_level.select("root", (F.col("level") - 1).alias("level"), F.col("blocks").alias("up"))
    next_down = per_level.select("root", (F.col("level") + 1).alias("level"), F.col("blocks").alias("down"))
    # written, so that AQE splits a hot level in the join below
    around = stored(
        per_level.join(next_up, ["root", "level"], "left").join(next_down, ["root", "level"], "left"), "levels-around"
    )

    def tile(low, a, high, b, side):
        return F.struct(F.xxhash64("root", low, a, high, b).alias("gid"), side.cast("int").alias("side"))

    lvl, own = F.col("level"), F.col("own")
    none = F.array().cast("array<struct<gid:bigint,side:int>>")

    def beside(count, make):
        blocks = F.sequence(F.lit(0).cast("long"), F.col(count) - 1)
        return F.when(F.col(count).isNotNull(), F.transform(blocks, make)).otherwise(none)

    return (
        dealt.join(around, ["root", "level"])
        .withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")))
        .withColumn(
            "tiles",
            F.concat(
                beside(
                    "blocks",
                    lambda c: tile(
                        lvl, F.least(own, c), lvl, F.greatest(own, c),
                        F.when(own == c, 2).otherwise((own > c).cast("int")),
                    ),
                ),
                beside("up", lambda c: tile(lvl, own, lvl + 1, c, F.lit(0))),
                beside("down", lambda c: tile(lvl - 1, c, lvl, own, F.lit(1))),
            ),
        )
        .select("key", "least_id", "copies", "tiles")
    )


def exact_links(docs: DataFrame, members: DataFrame, width: int, threshold: float) -> DataFrame:
    """key, links and root of every representative that links, from the texts themselves."""
    representative = docs.select("doc_id", "text").join(
        members, F.col("doc_id").eqNullSafe(F.col("least_id"))
    )

    def read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch.column(0), width))
            # an id may have further texts: only the representative's own set is taken
            own = [k for k, key in enumerate(batch.column(1).to_pylist()) if _key(sets[k]) == key]
            kept = batch.take(pa.array(own, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns[1:], pa.array([sets[k].tobytes() for k in own], pa.binary())],
                names=["key", "copies", "tiles", "tokens"],
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in groups(batches, "gid"):
            keys = part.column("key").to_pylist()
            first = {key: k for k, key in reversed(list(enumerate(keys)))}  # a repeated row counts once
            rows = sorted(first.values())
            if len(rows) < 2:
                continue
            keys = [keys[k] for k in rows]
            sets = [np.frombuffer(x, dtype=np.uint64) for x in part.column("tokens").take(rows).to_pylist()]
            side = part.column("side").to_numpy()[rows]
            copies = part.column("copies").to_numpy()[rows]
            size = np.array([len(s) for s in sets])
            both = common_tokens(sets)
            near = np.triu(both / (size[:, None] + size[None, :] - both) >= threshold, 1)
            left, right = np.nonzero(near & compared(side))
            if len(left) == 0:
                continue
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

    tiles = "array<struct<gid:bigint,side:int>>"
    sets = representative.select("text", "key", "copies", "tiles").mapInArrow(
        read_sets, f"key string, copies long, tiles {tiles}, tokens binary"
    )
    rows = sets.select("key", "copies", "tokens", F.explode("tiles").alias("tile")).select(
        "tile.gid", "tile.side", "key", "copies", "tokens"
    )
    return (
        rows.repartition(F.col("gid"))
        .sortWithinPartitions("gid")
        .mapInArrow(compare, "key string, links long, root string")
    )


# --- the join ------------------------------------------------------------------------------


def similar_classes(
    docs: DataFrame, keyed: DataFrame, width: int = WIDTH, threshold: float = JACCARD, recall: float = RECALL
) -> DataFrame:
    """Per shingle set: key, copies, least_id, n_links (of each of its texts), class_key and
    class_id (smallest key and id that links reach). ``keyed``: stored ``sketches(docs)``."""
    classes = stored(
        keyed.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("least_id"),
            F.first("size").alias("size"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    buckets, near = final_buckets(classes, runs_needed(recall), threshold)
    # one byte of each sketch value is enough to compare; the sketches join only shared buckets
    cut = classes.select("key", _low_bytes(F.col("sketch")).alias("cut"))
    candidates = stored(bucket_links(buckets, cut, threshold).unionByName(near), "candidates")
    groups_of = connected_components(candidates)
    members = classes.join(groups_of, classes["key"] == groups_of["node"]).select(
        "key", F.col("component").alias("root"), "size", "copies", "least_id"
    )
    found = stored(exact_links(docs, block_tiles(stored(members, "members")), width, threshold), "links-exact")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    component = connected_components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    joined = (
        classes.select("key", "copies", "least_id")
        .join(links, "key", "left")
        .join(component.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("class_key", F.coalesce("component", "key"))
    )
    # written, so that the join below is one of plain shuffles, whose hot classes AQE splits
    least = stored(joined.groupBy("class_key").agg(F.min("least_id").alias("class_id")), "components")
    return joined.join(least, "class_key").select(
        "key",
        "copies",
        "least_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "class_key",
        "class_id",
    )


def _low_bytes(sketch):
    """Every fourth byte, the lowest of each little-endian value, as bytes."""
    text = F.hex(sketch)
    return F.unhex(F.regexp_replace(text, "(..)......", "$1"))


def jaccard_join(
    docs: DataFrame, width: int = WIDTH, threshold: float = JACCARD, recall: float = RECALL
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_links (other rows whose set of ``width``-word
    shingles has a Jaccard similarity of at least ``threshold``), class_id (smallest id that
    links reach) and kept (doc_id = class_id).

    Words are runs of other characters than white space, as written. A text of fewer words than
    ``width`` has one shingle of all its words; a null, empty or blank text has none, links with
    nothing and is its own class. A null id is never a class_id while the class has another.
    Repeated rows are copies of each other. Columns with other names are ignored.
    """
    keyed = stored(sketches(docs, width), "sketches")
    found = stored(similar_classes(docs, keyed, width, threshold, recall), "similar").select(
        "key", "n_links", "class_id"
    )
    with_words = keyed.where(F.col("key").isNotNull()).select("doc_id", "key").join(found, "key")
    alone = keyed.where(F.col("key").isNull()).select(
        "doc_id", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id")
    )
    return (
        with_words.select("doc_id", "n_links", "class_id")
        .unionByName(alone)
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)))
    )


def keep_one_of_each(
    docs: DataFrame, width: int = WIDTH, threshold: float = JACCARD, recall: float = RECALL
) -> DataFrame:
    """``docs`` with one row of each class of ``jaccard_join``, that of the smallest id (null
    last); texts without words all stay. Same columns."""
    docs_columns = docs.columns
    keyed = stored(sketches(docs, width), "sketches")
    found = similar_classes(docs, keyed, width, threshold, recall)
    kept = stored(
        found.groupBy("class_key")
        .agg(F.min(F.struct(F.col("least_id").isNull().alias("last"), "least_id", "key")).alias("least"))
        .select(F.col("least.key").alias("kept_key")),
        "kept",
    )
    name = "shingle_set_key_"
    rows = with_key(docs, name, width)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs_columns])
    first = rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.min_by(row, order).alias("row"))
    chosen = first.join(kept, F.col(name) == F.col("kept_key"), "left_semi").select("row.*")
    return chosen.unionByName(rows.where(F.col(name).isNull()).drop(name))
