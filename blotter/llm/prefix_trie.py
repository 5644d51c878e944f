"""Trie of conversation prefixes, by union-find over sorted neighbours.

Conversations are cut into sections of bounded depth; a section of a conversation is the sequence
of its turns' digests there, below the digest of all turns before it. Sections are sorted, and each
has the length of the prefix it shares with its neighbour (LCP). Going down from the deepest, every
LCP edge unites two components, and each union is a branching node of the trie. A partition does
this for its own rows; components that touch its borders are contracted to a few rows, and those of
neighbouring partitions are merged, in rounds, until all is one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotter.llm.common import stored

#: Depths per section. A section's key is at most 16 bytes for each of SECTION + 1 turns.
SECTION = 32
#: Sections summed up together on the way to sums over a whole conversation.
SECTION_GROUP = 1024
#: Partitions whose contracted forests one task merges in a round.
FAN_IN = 64
#: Ids whose decimal texts make one piece of a digest's input.
ID_PIECE = 4096
WIDTH = 16


def placed_turns(turns: DataFrame) -> DataFrame:
    """conv_id, position (from 1), content (md5 of role and text) and size (UTF-8 bytes of the text)
    of every turn with a conv_id. Turns go by number (null first), ties by content.

    They are dealt by ranges of that order and a row number, so a conversation, or one turn that is
    repeated, may hold any share of the rows; places are counted per range and offset by the counts
    of a conversation's earlier ranges."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    order = [F.asc_nulls_first(c) for c in ("turn", "content", "salt")]
    ranges = stored(
        turns.where(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("content"),
            F.octet_length(text).cast("long").alias("size"),
            F.monotonically_increasing_id().alias("salt"),
        )
        .repartitionByRange(F.asc_nulls_first("conv_id"), *order)
        .withColumn("part", F.spark_partition_id()),
        "trie-ranges",
    )
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("conv_id", "part")
        .agg(F.count("*").alias("n"))
        .select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    return (
        ranges.withColumn("within", within)
        .join(offsets, ["conv_id", "part"])
        .select("conv_id", (F.col("offset") + F.col("within")).alias("position"), "content", "size")
    )


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """The conversations of ``turns`` rebuilt: the first h turns of conversation c - c % 5, then c's
    own turns after its first h, with h = crc32(decimal c) % 9. A row at position 0, without content,
    stands for each conversation, so that those without turns stay."""
    placed = stored(placed_turns(turns), "trie-turns")
    convs = (
        placed.groupBy("conv_id")
        .agg(F.count("*").alias("n"))
        .withColumn("h", F.crc32(F.col("conv_id").cast("string")) % 9)
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    )
    convs = stored(convs, "trie-conversations")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    moved = convs.where(F.col("conv_id") != F.col("base"))
    heads = (
        moved.where("h > 0")
        .select(F.col("conv_id").alias("to"), "base", "h")
        .join(placed.where("position <= 8").withColumnRenamed("conv_id", "base"), "base")
        .where("position <= h")
        .select(F.col("to").alias("conv_id"), "position", "content", "size")
    )
    shifts = moved.join(bases, "base", "left").select(
        "conv_id", F.least(F.coalesce("n_base", F.lit(0)), "h").alias("n_head"), "h"
    )
    own = (
        placed.join(shifts, "conv_id", "left")
        .where("h IS NULL OR position > h")
        .select("conv_id", (F.col("position") - F.coalesce(F.col("h") - F.col("n_head"), F.lit(0))).alias("position"), "content", "size")
    )
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("position"), F.lit("0" * 32).alias("content"), F.lit(0).cast("long").alias("size"))
    return own.unionByName(heads).unionByName(roots)


def _so_far(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """conv_id, section and, per name, the aggregate over the earlier sections of the conversation:
    windows order a group of sections, then the groups."""
    group = F.floor(F.col("section") / SECTION_GROUP)
    earlier = (Window.unboundedPreceding, -1)
    per_section = rows.groupBy("conv_id", "section").agg(*(c.alias(k) for k, c in sums.items())).withColumn("group", group)
    again = {k: F.bit_xor(k) if k.startswith("x") else F.sum(k) for k in sums}
    in_group = Window.partitionBy("conv_id", "group").orderBy("section").rowsBetween(*earlier)
    across = Window.partitionBy("conv_id").orderBy("group").rowsBetween(*earlier)
    groups = per_section.groupBy("conv_id", "group").agg(*(c.alias(k) for k, c in again.items()))
    groups = groups.select("conv_id", "group", *(F.coalesce(c.over(across), F.lit(0)).alias(f"{k}_groups") for k, c in again.items()))
    within = per_section.select("conv_id", "section", "group", *(F.coalesce(c.over(in_group), F.lit(0)).alias(f"{k}_in") for k, c in again.items()))
    joined = within.join(groups, ["conv_id", "group"])
    both = lambda k: F.col(f"{k}_in").bitwiseXOR(F.col(f"{k}_groups")) if k.startswith("x") else F.col(f"{k}_in") + F.col(f"{k}_groups")
    return joined.select("conv_id", "section", *(both(k).alias(f"{k}_before") for k in sums))


def prefixed_turns(rebuilt: DataFrame) -> DataFrame:
    """``rebuilt`` with section and, of the turns before this one (``x1``, ``x2``, ``bytes``) and up
    to it (``x1_to``, ``x2_to``, ``bytes_to``), two digests of their positions and contents and the
    bytes of their texts. Digests are exclusive ors, so they add up over sections in any order."""
    rows = rebuilt.select(
        "conv_id",
        "position",
        F.floor(F.col("position") / SECTION).alias("section"),
        "content",
        "size",
        F.xxhash64("position", "content").alias("z1"),
        F.xxhash64(F.lit(7), "content", "position").alias("z2"),
    )
    before = _so_far(rows, {"x1": F.bit_xor("z1"), "x2": F.bit_xor("z2"), "bytes": F.sum("size")})
    here = Window.partitionBy("conv_id", "section").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    up_to = rows.select(
        "conv_id", "position", "section", "content", "size", "z1", "z2",
        F.bit_xor("z1").over(here).alias("w1"), F.bit_xor("z2").over(here).alias("w2"), F.sum("size").over(here).alias("wb"),
    )
    return up_to.join(before, ["conv_id", "section"]).select(
        "conv_id",
        "position",
        "section",
        "content",
        F.col("w1").bitwiseXOR(F.col("x1_before")).alias("x1_to"),
        F.col("w2").bitwiseXOR(F.col("x2_before")).alias("x2_to"),
        F.col("w1").bitwiseXOR(F.col("x1_before")).bitwiseXOR(F.col("z1")).alias("x1"),
        F.col("w2").bitwiseXOR(F.col("x2_before")).bitwiseXOR(F.col("z2")).alias("x2"),
        (F.col("wb") + F.col("bytes_before")).alias("bytes_to"),
        (F.col("wb") + F.col("bytes_before") - F.col("size")).alias("bytes"),
    )


def sections(prefixed: DataFrame) -> DataFrame:
    """One row per section of a conversation: conv_id, section, the digest of the turns before it
    (x1, x2), ``path`` (the contents of its turns and of the first one of the next section, 16 bytes
    each) and ``bytes`` (bytes of all texts up to each of these turns)."""
    last = (F.col("position") % SECTION == 0) & (F.col("position") > 0)
    both = F.when(last, F.array("section", F.col("section") - 1)).otherwise(F.array("section"))
    turn = F.struct("position", "content", "bytes_to", "x1", "x2")
    listed = (
        prefixed.withColumn("section", F.explode(both))
        .groupBy("conv_id", "section")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )
    return listed.select(
        "conv_id",
        "section",
        F.col("turns")[0]["x1"].alias("x1"),
        F.col("turns")[0]["x2"].alias("x2"),
        F.unhex(F.array_join("turns.content", "")).alias("path"),
        F.col("turns.bytes_to").alias("bytes"),
    )


# --- forests of a run of sorted sections ----------------------------------------------------------

_ROW = ["section", "x1", "x2", "conv_id", "n", "low", "kids", "saved", "leaves", "lcp", "edge_bytes", "edge_leaf"]
_FOREST = "section long, x1 long, x2 long, conv_id long, n long, low long, kids long, saved long, leaves long, lcp long, edge_bytes long, edge_leaf long"
_ENDS = "first_path binary, first_bytes array<long>, last_path binary"
_CHAIN = "section long, conv_id long, top long, bottom long, n long, kids long, saved long, leaves long"
_CHAINS = ["section", "conv_id", "top", "bottom", "n", "kids", "saved", "leaves"]


class Forest:
    """Components of a run of sorted sections, in order: per component its smallest conversation,
    members, depth of its top-most united node (``low``), that node's children, and the sums over its
    edges of shared bytes and of leaves; and the edge to the component before (lcp -1: none)."""

    def __init__(self, columns: dict[str, np.ndarray], first, first_bytes, last):
        self.c = columns
        self.first, self.first_bytes, self.last = first, first_bytes, last

    def __len__(self) -> int:
        return len(self.c["conv_id"])


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common."""
    n = min(len(a), len(b)) // WIDTH
    if n == 0:
        return 0
    x = np.frombuffer(a, np.uint8, n * WIDTH) != np.frombuffer(b, np.uint8, n * WIDTH)
    where = x.argmax()
    return int(where) // WIDTH if x[where] else n


def _edge(section: int, same: bool, path: bytes, sums: list[int], before: bytes) -> tuple[int, int, int]:
    """LCP with the path before, bytes of the shared prefix, and whether the path before does not go
    on into this one. An edge as deep as the section is left to the next section."""
    lcp = _shared(path, before) if same else 0
    owned = 1 <= lcp <= SECTION
    return lcp, int(sums[lcp - 1]) if owned else 0, int(owned and len(before) // WIDTH > lcp)


def _of_batch(batch: pa.RecordBatch) -> Forest | None:
    """The forest of single sections."""
    n = batch.num_rows
    if n == 0:
        return None
    paths, sums = batch.column("path").to_pylist(), batch.column("bytes")
    col = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("section", "x1", "x2", "conv_id")}
    depth = np.array([len(p) // WIDTH for p in paths], dtype=np.int64)
    # neighbours compared as one matrix of padded paths
    full = np.zeros((n, (SECTION + 1) * WIDTH), dtype=np.uint8)
    at = np.arange(full.shape[1])
    full[at < (depth * WIDTH)[:, None]] = np.frombuffer(b"".join(paths), np.uint8)
    equal = (full[1:] == full[:-1]).reshape(n - 1, SECTION + 1, WIDTH).all(2)
    equal &= np.arange(SECTION + 1) < np.minimum(depth[1:], depth[:-1])[:, None]
    lcp = np.where(equal.all(1), SECTION + 1, equal.argmin(1)) if n > 1 else np.zeros(0, np.int64)
    same = (col["section"][1:] == col["section"][:-1]) & (col["x1"][1:] == col["x1"][:-1]) & (col["x2"][1:] == col["x2"][:-1])
    lcp = np.where(same, lcp, 0)
    owned = (lcp >= 1) & (lcp <= SECTION)
    begin = np.r_[0, np.cumsum(depth)]
    values = np.asarray(sums.flatten()).astype(np.int64)
    prefix = values[np.minimum(begin[1:-1] + np.maximum(lcp - 1, 0), len(values) - 1)]
    zero = np.zeros(n, dtype=np.int64)
    col |= {
        "n": zero + 1, "low": depth, "kids": zero, "saved": zero, "leaves": zero,
        "lcp": np.r_[-1, lcp], "edge_bytes": np.r_[0, np.where(owned, prefix, 0)],
        "edge_leaf": np.r_[0, owned & (depth[:-1] > lcp)].astype(np.int64),
    }
    return Forest(col, paths[0], sums[0].as_py(), paths[-1])


def _joined(parts: list[Forest]) -> Forest:
    """Neighbouring runs as one, with the edges between them."""
    columns = {c: np.concatenate([p.c[c] for p in parts]) for c in _ROW}
    at = 0
    for a, b in zip(parts, parts[1:], strict=False):
        at += len(a)
        same = all(a.c[k][-1] == b.c[k][0] for k in ("section", "x1", "x2"))
        edge = _edge(int(b.c["section"][0]), same, b.first, b.first_bytes, a.last)
        for name, value in zip(("lcp", "edge_bytes", "edge_leaf"), edge, strict=True):
            columns[name][at] = value
    return Forest(columns, parts[0].first, parts[0].first_bytes, parts[-1].last)


def _united(forest: Forest, whole: bool) -> tuple[Forest, dict[str, np.ndarray]]:
    """Unite components over their edges, deepest first. Returns what is left and the chains of
    finished nodes: a component's nodes lie from below its parent (``top``) down to ``bottom``.

    Unless the run is the ``whole`` order, a component at a border may go on in the neighbouring run:
    it stays open, and what it is joined to is contracted to one open row per depth and side."""
    c = {k: v.copy() for k, v in forest.c.items()}
    n = len(forest)
    opened = np.zeros(n, dtype=bool)
    if not whole:
        opened[[0, -1]] = True
    chains: list[dict[str, np.ndarray]] = []

    def close(which: np.ndarray, above: int) -> None:
        bottom = np.minimum(c["low"], SECTION)
        some = which & (bottom > above)
        if some.any():
            kids = np.where(c["low"] <= SECTION, c["kids"], 1)
            made = {"section": c["section"], "conv_id": c["conv_id"], "bottom": bottom, "n": c["n"], "kids": kids, "saved": c["saved"], "leaves": c["leaves"]}
            out = {k: v[some] for k, v in made.items()}
            chains.append(out | {"top": np.full(int(some.sum()), above + 1, dtype=np.int64)})

    for depth in range(SECTION + 1, 0, -1):
        linked = c["lcp"] >= depth
        if not linked.any():
            continue
        # runs of components that hang together at this depth
        run = np.cumsum(~linked) - 1
        in_run = np.bincount(run)[run] > 1
        inner = in_run & ~opened
        if not inner.any():
            continue
        close(inner, depth)
        has_open = np.bincount(run, weights=opened)[run] > 0
        # an inner component is united with the inner ones before it in its run
        glued = inner & linked & np.r_[False, inner[:-1]]
        head = np.flatnonzero(~glued)
        add = np.add.reduceat
        child = np.where(c["low"] > depth, 1, c["kids"])
        inside = np.where(glued, 1, 0)
        new = {k: c[k][head] for k in ("section", "x1", "x2", "lcp", "edge_bytes", "edge_leaf")}
        new["conv_id"] = np.minimum.reduceat(c["conv_id"], head)
        new["n"] = add(c["n"], head)
        touched = inner[head]
        new["low"] = np.where(touched, depth, c["low"][head])
        new["kids"] = np.where(touched, add(child, head), c["kids"][head])
        new["saved"] = add(c["saved"], head) + add(inside * c["edge_bytes"], head)
        new["leaves"] = add(c["leaves"], head) + add(inside * c["edge_leaf"], head)
        opened = opened[head] | (touched & has_open[head])
        c = new
    close(~opened, 0)
    rest = {k: v[opened] for k, v in c.items()}
    done = {k: np.concatenate([x[k] for x in chains]) if chains else np.zeros(0, np.int64) for k in _CHAINS}
    return Forest(rest, forest.first, forest.first_bytes, forest.last), done


_OUT = pa.schema(
    [("part", pa.int64()), ("place", pa.int64()), ("open", pa.bool_())]
    + [(c, pa.int64()) for c in _ROW]
    + [("first_path", pa.binary()), ("first_bytes", pa.list_(pa.int64())), ("last_path", pa.binary())]
    + [("top", pa.int64()), ("bottom", pa.int64())]
)
_OUT_SQL = f"part long, place long, open boolean, {_FOREST}, {_ENDS}, top long, bottom long"


def _open_rows(part: int, forest: Forest) -> pa.RecordBatch:
    """The contracted forest of a partition; its first row carries the first path, its last the last."""
    n = len(forest)
    edge = lambda value, at: [value if k == at else None for k in range(n)]
    columns = {
        "part": np.full(n, part), "place": np.arange(n), "open": np.ones(n, bool), **forest.c,
        "first_path": edge(forest.first, 0), "first_bytes": edge(forest.first_bytes, 0), "last_path": edge(forest.last, n - 1),
        "top": [None] * n, "bottom": [None] * n,
    }
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in _OUT], schema=_OUT)


def _chain_rows(done: dict[str, np.ndarray]) -> pa.RecordBatch:
    n = len(done["conv_id"])
    columns = {**done, "open": np.zeros(n, bool)}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _OUT], schema=_OUT
    )


def _of_sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains and the contracted forest of one partition of sorted sections. Each batch is united at
    once, so a task holds a batch and a contracted forest."""
    held, part = None, 0
    for batch in batches:
        found = _of_batch(batch)
        if found is None:
            continue
        part = int(batch.column("part")[0].as_py())
        held = found if held is None else _joined([held, found])
        held, done = _united(held, whole=False)
        yield _chain_rows(done)
    if held is not None:
        yield _open_rows(part, held)


def _forest_of(table: pa.Table) -> Forest:
    columns = {c: table.column(c).to_numpy().astype(np.int64) for c in _ROW}
    return Forest(columns, table.column("first_path")[0].as_py(), table.column("first_bytes")[0].as_py(), table.column("last_path")[-1].as_py())


def _merged(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """One round: the contracted forests of neighbouring partitions, in order, become one."""
    rows = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.concat_tables(rows).combine_chunks()
    parts = table.column("part").to_numpy()
    group = parts // FAN_IN
    for g in np.unique(group):
        at = np.flatnonzero(group == g)
        cuts = np.flatnonzero(np.diff(parts[at])) + 1
        runs = np.split(at, cuts)
        forest = _joined([_forest_of(table.slice(int(r[0]), len(r))) for r in runs])
        left, done = _united(forest, whole)
        yield _chain_rows(done)
        if not whole:
            yield _open_rows(int(g), left)


def trie_chains(cut: DataFrame) -> DataFrame:
    """Chains of trie nodes (section, conv_id, top, bottom, n, kids, saved, leaves) of the sections
    ``cut``: sorted ranges are united on their own, then their borders in rounds of FAN_IN."""
    order = ["section", "x1", "x2", "path", "conv_id"]
    dealt = cut.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id().cast("long"))
    found = stored(dealt.mapInArrow(_of_sections, _OUT_SQL), "trie-forests")
    chains = found.where("NOT open").select(*_CHAINS)
    state = found.where("open").select("part", "place", *_ROW, "first_path", "first_bytes", "last_path")
    while True:
        # one number per partition of the sort, renumbered without holes
        span = state.agg(F.min("part").alias("a"), F.max("part").alias("b")).first()
        if span["a"] is None:
            return chains
        whole = span["b"] // FAN_IN == span["a"] // FAN_IN
        merged = stored(
            state.withColumn("round", F.floor(F.col("part") / FAN_IN))
            .repartition("round")
            .sortWithinPartitions("part", "place")
            .drop("round")
            .mapInArrow(lambda batches, whole=whole: _merged(batches, whole), _OUT_SQL),
            "trie-merged",
        )
        chains = chains.unionByName(merged.where("NOT open").select(*_CHAINS))
        if whole:
            return chains
        state = merged.where("open").select("part", "place", *_ROW, "first_path", "first_bytes", "last_path")


def deeper_sums(chains: DataFrame, prefixed: DataFrame) -> DataFrame:
    """(depth, x1_to, x2_to) of nodes with what lies in later sections below them: ``saved`` and
    ``leaves``. A section's sums stand at its top nodes' smallest members, who are members of every
    node above; from there they are summed along those members' earlier sections only, so nothing is
    done for conversations that share less than a section."""
    tops = chains.where((F.col("section") > 0) & (F.col("top") == 1) & ((F.col("saved") > 0) | (F.col("leaves") > 0)))
    sums = stored(tops.groupBy("conv_id", "section").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")), "trie-deeper")
    own = prefixed.join(sums.select("conv_id").distinct(), "conv_id", "left_semi")
    # from the last section backwards: all of a conversation, less what lies up to a section
    steps = own.select("conv_id", "section").distinct().join(sums, ["conv_id", "section"], "left").na.fill(0)
    so_far = _so_far(steps, {"saved": F.sum("saved"), "leaves": F.sum("leaves")})
    whole = steps.groupBy("conv_id").agg(F.sum("saved").alias("saved_all"), F.sum("leaves").alias("leaves_all"))
    later = (
        steps.join(so_far, ["conv_id", "section"])
        .join(whole, "conv_id")
        .select(
            "conv_id",
            "section",
            (F.col("saved_all") - F.col("saved_before") - F.col("saved")).alias("more_saved"),
            (F.col("leaves_all") - F.col("leaves_before") - F.col("leaves")).alias("more_leaves"),
        )
    )
    return (
        own.join(later, ["conv_id", "section"])
        .groupBy(F.col("position").alias("depth"), "x1_to", "x2_to")
        .agg(F.sum("more_saved").alias("more_saved"), F.sum("more_leaves").alias("more_leaves"))
    )


def _id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined ids of rows sorted by node, in pieces that bound what a digest takes at a time."""
    names = ["depth", "x1_to", "x2_to"]
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names])
        ids = batch.column("conv_id").to_numpy()
        at = np.r_[0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, len(ids)]
        starts = np.concatenate([np.arange(a, b, ID_PIECE) for a, b in zip(at[:-1], at[1:], strict=True)])
        texts = [",".join(map(str, x)) for x in np.split(ids, starts[1:])]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(k[starts]) for k in keys), pa.array(ids[starts]), pa.array(texts)], names=[*names, "first_id", "ids"]
        )


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["depth", "x1_to", "x2_to"]
    key, sha = None, None
    for batch in batches:
        done = []
        for *here, text in zip(*(batch.column(c).to_pylist() for c in (*names, "ids")), strict=True):
            if here != key:
                if key is not None:
                    done.append((*key, sha.hexdigest()))
                key, sha = here, hashlib.sha256(text.encode())
            else:
                sha.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=[*names, "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, sha.hexdigest())], names=[*names, "ends_sha256"])


def end_digests(prefixed: DataFrame) -> DataFrame:
    """(depth, x1_to, x2_to) of nodes where conversations end, with the SHA-256 of their ids in
    order. Ids are dealt by ranges and joined to pieces, and a node's pieces digested in order."""
    key = ["depth", "x1_to", "x2_to"]
    ends = prefixed.groupBy("conv_id").agg(F.max(F.struct("position", "x1_to", "x2_to")).alias("end"))
    ids = ends.select(F.col("end.position").alias("depth"), "end.x1_to", "end.x2_to", "conv_id")
    pieces = (
        ids.repartitionByRange(*key, "conv_id")
        .sortWithinPartitions(*key, "conv_id")
        .mapInArrow(_id_pieces, "depth long, x1_to long, x2_to long, first_id long, ids string")
    )
    return (
        pieces.repartition(*key)
        .sortWithinPartitions(*key, "first_id")
        .mapInArrow(_id_digests, "depth long, x1_to long, x2_to long, ends_sha256 string")
    )


def trie_nodes(rebuilt: DataFrame) -> DataFrame:
    """The trie of ``rebuilt`` conversations (conv_id, position, content, size, with a row at position
    0 each), one row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256."""
    prefixed = stored(prefixed_turns(rebuilt), "trie-prefixes")
    chains = stored(trie_chains(sections(prefixed)), "trie-chains")
    # depth of the first node below a section's root is section * SECTION
    depth = F.col("section") * SECTION + F.col("step") - 1
    nodes = (
        chains.withColumn("step", F.explode(F.sequence("top", "bottom")))
        .select(
            "conv_id",
            depth.alias("position"),
            "n",
            F.when(F.col("step") == F.col("bottom"), F.col("kids")).otherwise(1).alias("kids"),
            "saved",
            "leaves",
        )
        .join(prefixed.select("conv_id", "position", "x1", "x2", "x1_to", "x2_to", "bytes"), ["conv_id", "position"])
        .withColumnRenamed("position", "depth")
    )
    key = ["depth", "x1_to", "x2_to"]
    nodes = stored(nodes, "trie-nodes")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("x1_to").alias("x1"), F.col("x2_to").alias("x2"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        nodes.join(parents, ["depth", "x1", "x2"], "left")
        .join(deeper_sums(chains, prefixed), key, "left")
        .join(end_digests(prefixed), key, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            F.col("n").alias("n_convs"),
            F.col("kids").cast("long").alias("n_children"),
            (1 + F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0)) - (F.col("n") - 1) * F.col("bytes")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie (as ``trie_nodes``) of the rebuilt conversations of ``turns`` (conv_id,
    turn, role, text).

    Turns go by number, null first, ties by md5 of role and text; null roles and texts are empty,
    repeated turns stay, and texts of any length count whole. Ids are numbers; c % 5 has the sign of
    c. Rows without a conv_id belong to no conversation and are left out. A table without
    conversations has no nodes. Other columns are ignored.
    """
    return trie_nodes(stored(rebuilt_turns(turns), "trie-rebuilt"))
