"""Repair of conversation structure: a cost DP, then the least cheapest audit by prefix doubling.

The rows of a conversation, in order, are cut into blocks of bounded rows and bytes. Every block is
reduced to a (min, +) matrix between the states of the role grammar; the matrices, last block first,
give each block the cheapest cost after its end. With that, a block knows which arcs lie on cheapest
ways, ranks its nodes by their least audits of 1, 2, 4, ... letters with doubled pointers, and reads
off one audit and one end state per state it can be entered in. A last pass goes through the blocks
of a conversation in order, takes the audit of the state it is in, and digests the repaired text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import stored

#: Rows and bytes of text in a block: the unit that one task orders and ranks at a time.
BLOCK_ROWS = 1024
BLOCK_BYTES = 1 << 22
#: White space of the word rule, and the marks that end a sentence.
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Cost of each edit, and what an undeleted truncated row adds.
DELETE, INSERT, KEEP, REROLE, CUT_OFF = 2, 5, 0, 1, 5
LETTERS = np.frombuffer(b"DIKR", dtype=np.uint8)
#: A row's fault.
NONE, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
#: States of the grammar ``(s?(ua)+)?``: nothing yet, after s, after u, after a. From each there is
#: one next role besides s, so an edit's letter alone says where it leads.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: Where keeping a row of role s, u, a or another leads from each state; -1: nowhere.
KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
FAR = np.int64(1) << 40
#: Cheapest cost from each state once all rows are gone: inserts up to a whole turn pair.
AT_END = np.array([0, 2 * INSERT, INSERT, 0], dtype=np.int64)

_PLACES = "conv_id {0}, block long"
_ROWS = "roles array<string>, texts array<string>, tids array<string>, faults array<int>"
_TURNS = "least_turn long, most_turn long, turns long, first_turn long, last_turn long"
_COUNTS = "blank long, duplicate long, truncated long, illegal long, first_role int, last_role int"


def damaged_turns(turns: DataFrame) -> DataFrame:
    """``turns`` with faults planted by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1
    empties its text, 2 takes out its ``.!?``, 3 repeats it, 4 makes it the user's. Null roles and
    texts become one space, as do null parts of the hashed key. Dropped rows stay, marked, so that
    their conversation is known."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(part("role")).alias("role"),
        F.when(kind.isin(0, 1), "")
        .when(kind == 2, F.regexp_replace(part("text"), f"[{ENDS}]", ""))
        .otherwise(part("text"))
        .alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def turn_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per block of the conversations of ``rows`` (as ``damaged_turns``): conv_id, block
    (numbers ascend with the order of the rows), lists of the rows' role, text, text digest and
    fault (a duplicate is not known here), and counts of turn numbers.

    Rows go by turn (null first), then role, then md5 of the text. They are dealt by ranges of that
    order and a row number, so a conversation, or one row that is repeated, is spread over many
    tasks. A conversation whose rows are all dropped has a block without rows.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    tail = F.rtrim("text", F.lit(SPACE))
    fault = F.when(tail == "", BLANK).when(F.right(tail, F.lit(1)).isin(*ENDS), NONE).otherwise(TRUNCATED)
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "tid", "salt")]
    dealt = (
        rows.withColumn("tid", F.md5("text"))
        .withColumn("fault", fault.cast("int"))
        .withColumn("salt", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            "role",
            "text",
            "tid",
            "fault",
            "dropped",
            F.spark_partition_id().alias("part"),
        )
    )
    return dealt.mapInArrow(lambda batches: _cut_blocks(batches, block_rows), f"{_PLACES.format(kind)}, {_ROWS}, {_TURNS}")


def _differs(column: pa.ChunkedArray) -> np.ndarray:
    """Where a value differs from the one before; null equals null."""
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    return np.r_[True, ~np.asarray(same.combine_chunks() if isinstance(same, pa.ChunkedArray) else same)]


def _cut_blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    held, number = None, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        new = _differs(table.column("conv_id"))
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        place = np.arange(len(new)) - starts[run]
        own = np.asarray(pc.fill_null(pc.binary_length(table.column("text")), 0)).astype(np.int64)
        before = np.cumsum(own) - own
        cut = place // block_rows
        heavy = (before - before[starts[run]]) // BLOCK_BYTES
        at = np.flatnonzero(new | np.r_[True, (cut[1:] != cut[:-1]) | (heavy[1:] != heavy[:-1])])
        # the last block may go on in the next batch
        if len(at) > 1:
            yield _block_rows(table.slice(0, int(at[-1])), at[:-1], number)
            number += len(at) - 1
        held = table.slice(int(at[-1])).combine_chunks()
    if held is not None:
        yield _block_rows(held, np.array([0]), number)


def _block_rows(table: pa.Table, at: np.ndarray, number: int) -> pa.RecordBatch:
    """The blocks that begin at the rows ``at`` of ``table``, without their dropped rows."""
    live = ~np.asarray(table.column("dropped"))
    before = np.r_[0, np.cumsum(live)]
    offsets = pa.array(before[np.r_[at, len(live)]], pa.int32())
    kept = table.filter(pa.array(live)).combine_chunks()
    turn = kept.column("turn").combine_chunks() if kept.num_rows else pa.array([], pa.int64())
    known, value = np.asarray(turn.is_valid()), np.asarray(turn.fill_null(0))
    ends = before[np.r_[at[1:], len(live)]]
    begins = before[at]
    # within a block turns ascend, unknown ones first
    n_known = np.r_[0, np.cumsum(known)]
    first_known = ends - (n_known[ends] - n_known[begins])
    any_known = first_known < ends
    step = np.r_[True, value[1:] != value[:-1]] if len(value) else np.zeros(0, bool)
    steps = np.r_[0, np.cumsum(step & known)]
    low = value[np.minimum(first_known, len(value) - 1)] if len(value) else np.zeros(len(at), np.int64)
    high = value[np.maximum(ends - 1, 0)] if len(value) else np.zeros(len(at), np.int64)
    safe = np.minimum(first_known, max(len(value) - 1, 0))
    distinct = steps[ends] - steps[safe + 1] + 1 if len(value) else np.zeros(len(at), np.int64)
    null = ~any_known
    lists = [
        pa.ListArray.from_arrays(offsets, kept.column(c).combine_chunks().cast(t) if kept.num_rows else pa.array([], t))
        for c, t in (("role", pa.string()), ("text", pa.string()), ("tid", pa.string()), ("fault", pa.int32()))
    ]
    part = int(table.column("part")[0].as_py())
    bound = lambda x: pa.array(x, pa.int64(), mask=null)
    return pa.RecordBatch.from_arrays(
        [
            table.column("conv_id").combine_chunks().take(pa.array(at)),
            pa.array((part << 40) + number + np.arange(len(at)), pa.int64()),
            *lists,
            bound(low),
            bound(high),
            pa.array(np.where(any_known, distinct, 0), pa.int64()),
            bound(low),
            bound(high),
        ],
        names=["conv_id", "block", "roles", "texts", "tids", "faults", "least_turn", "most_turn", "turns", "first_turn", "last_turn"],
    )


def faulted_blocks(blocks: DataFrame) -> DataFrame:
    """``blocks`` without texts, with a code per row (role + 4 * fault), the counts of faults and of
    illegal neighbours, and the (min, +) matrix from each state before the block to each after it.

    A row is a duplicate where an earlier row of its conversation has its role and text: the first
    of each are a partial aggregate over the text digests, so one text repeated through a hot
    conversation is combined per task, and the first ones return to their block as a list.
    """
    kind = blocks.schema["conv_id"].dataType.simpleString()
    first = (
        blocks.select("conv_id", "block", F.posexplode(F.arrays_zip("roles", "tids")).alias("place", "row"))
        .groupBy("conv_id", "row.roles", "row.tids")
        .agg(F.min(F.struct("block", "place")).alias("at"))
        .groupBy("at.block")
        .agg(F.collect_list("at.place").alias("firsts"))
    )
    light = blocks.drop("texts", "tids").join(first, "block", "left")
    schema = f"{_PLACES.format(kind)}, {_TURNS}, {_COUNTS}, codes binary, matrix array<long>"
    columns = ["conv_id", "block", *(c.split()[0] for c in _TURNS.split(", ")), "roles", "faults", "firsts"]
    return light.select(*columns).mapInArrow(_reduced, schema)


def _role_codes(roles: pa.Array) -> np.ndarray:
    initial = pc.utf8_slice_codeunits(roles, 0, 1)
    return np.asarray(pc.fill_null(pc.index_in(initial, pa.array(["s", "u", "a"])), 3)).astype(np.int64)


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        roles, faults, firsts = (batch.column(c) for c in ("roles", "faults", "firsts"))
        at = np.r_[0, np.cumsum(np.asarray(pc.list_value_length(roles)))]
        role = _role_codes(roles.flatten())
        fault = np.asarray(faults.flatten()).astype(np.int64)
        is_first = np.zeros(len(role), bool)
        n_firsts = np.asarray(pc.fill_null(pc.list_value_length(firsts), 0))
        is_first[np.repeat(at[:-1], n_firsts) + np.asarray(firsts.flatten()).astype(np.int64)] = True
        fault = np.where((fault != BLANK) & ~is_first, DUPLICATE, fault)
        total = lambda x: np.diff(np.r_[0, np.cumsum(x)][at])  # noqa: E731, B023
        legal = np.isin(role[:-1] * 4 + role[1:], [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])
        inside = np.ones(max(len(role) - 1, 0), bool)
        inside[at[(at > 0) & (at < len(role))] - 1] = False
        illegal = np.diff(np.r_[0, np.cumsum(np.r_[0, ~legal & inside])][at]) if len(role) else np.zeros(batch.num_rows, int)
        some = np.diff(at) > 0
        edge = lambda where: pa.array(role[np.clip(where, 0, max(len(role) - 1, 0))] if len(role) else np.zeros(len(some)), pa.int32(), mask=~some)  # noqa: E731, B023
        code = (role + 4 * fault).astype(np.uint8)
        codes = [code[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        unit = np.where(np.eye(4, dtype=bool), 0, FAR)
        togo = costs_to_go([np.frombuffer(c, np.uint8) for c in codes for _ in range(4)], np.tile(unit, (len(codes), 1)))
        # togo[(block, end), start] -> rows by start
        matrix = togo.reshape(-1, 4, 4).transpose(0, 2, 1).reshape(-1, 16)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(k) for k in range(7)),
                *(pa.array(total(fault == f), pa.int64()) for f in (BLANK, DUPLICATE, TRUNCATED)),
                pa.array(illegal, pa.int64()),
                edge(at[:-1]),
                edge(at[1:] - 1),
                pa.array(codes, pa.binary()),
                pa.array(list(matrix), pa.list_(pa.int64())),
            ],
            names=[*batch.schema.names[:7], "blank", "duplicate", "truncated", "illegal", "first_role", "last_role", "codes", "matrix"],
        )


def _padded(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(c) for c in codes], dtype=np.int64)
    out = np.full((len(codes), int(n.max(initial=0))), 255, dtype=np.int64)
    if out.size:
        out[np.arange(out.shape[1]) < n[:, None]] = np.concatenate(codes)
    return out, n


def _by_length(codes: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Numbers of the blocks, in groups of about equal length, so that padding is bounded."""
    size = np.array([len(c).bit_length() for c in codes], dtype=np.int64)
    for s in np.unique(size):
        where = np.flatnonzero(size == s)
        step = max(1, (1 << 18) >> int(s))
        for k in range(0, len(where), step):
            yield where[k : k + step]


def _layers(codes: np.ndarray, n: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Cheapest cost from every (block, row, state) to the block's end, whose costs are ``end``."""
    m, length = codes.shape
    togo = np.empty((m, length + 1, 4), dtype=np.int64)
    togo[:, length] = end
    for i in range(length - 1, -1, -1):
        after = togo[:, i + 1]
        role, fault = codes[:, i] % 4, codes[:, i] // 4
        free = ~np.isin(fault, (BLANK, DUPLICATE))
        extra = np.where(fault == TRUNCATED, CUT_OFF, 0)
        to = KEPT[:, role].T
        keep = np.where(free[:, None] & (to >= 0), np.take_along_axis(after, np.maximum(to, 0), 1) + KEEP + extra[:, None], FAR)
        rerole = np.where(free[:, None], after[:, NEXT] + REROLE + extra[:, None], FAR)
        here = np.minimum(np.minimum(keep, rerole), after + DELETE)
        for _ in range(2):  # no cheapest way inserts more than a pair at one place
            here = np.minimum(here, here[:, NEXT] + INSERT)
        togo[:, i] = np.where((i < n)[:, None], here, end)
    return np.minimum(togo, FAR)


def costs_to_go(codes: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    """Per block and state before its first row, the cheapest cost to its end."""
    out = np.empty((len(codes), 4), dtype=np.int64)
    for where in _by_length(codes):
        padded, n = _padded([codes[k] for k in where])
        out[where] = _layers(padded, n, end[where])[:, 0]
    return out


def least_audits(codes: list[np.ndarray], end: np.ndarray) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Per block and entry state: the ASCII-least of its cheapest audits, the state it ends in, and
    its cost to the end of the conversation (``end``: that cost after the block, per state).

    Nodes are (row, state); arcs of the cheapest ways carry a letter. Ranks compare the nodes by
    their least audits of 2**k letters, and pointers lead 2**k arcs on; both double from two of the
    last round. Every node then leaves by the arc of the least letter and target's rank, and the node
    at letter j of an audit is reached by the doubled pointers of the bits of j.
    """
    audits: list = [None] * len(codes)
    ends = np.empty((len(codes), 4), dtype=np.int64)
    cost = np.empty((len(codes), 4), dtype=np.int64)
    for where in _by_length(codes):
        padded, n = _padded([codes[k] for k in where])
        togo = _layers(padded, n, end[where])
        m, length = padded.shape
        cost[where] = togo[:, 0]
        letter, target, good = _arcs(padded, n, togo)
        pointers, rank = _doubled(letter, target, good)
        # leave by the least letter, then the least rest
        key = np.where(good, letter * (rank.max() + 1) + rank[target], np.iinfo(np.int64).max)
        best = key.argmin(1)
        chosen = np.where(good.any(1), LETTERS[best], 0).astype(np.uint8)
        entry = (np.arange(m)[:, None] * (length + 1) * 4 + np.arange(4)).reshape(-1)
        last = pointers[-1][entry]
        ends[where] = (last % 4).reshape(m, 4)
        letters = _walked(entry, pointers, chosen)
        for k, b in enumerate(where):
            audits[b] = [bytes(row[row > 0]) for row in letters[4 * k : 4 * k + 4]]
    return audits, ends, cost


def _arcs(codes: np.ndarray, n: np.ndarray, togo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node, the four edits in letter order: letter code, target node, and whether the arc lies
    on a cheapest way. The nodes of a block's end have none."""
    m, length = codes.shape
    nodes = np.arange(m * (length + 1) * 4).reshape(m, length + 1, 4)
    letter = np.tile(np.arange(1, 5), (nodes.size, 1))
    target = np.repeat(nodes[..., None], 4, axis=3)
    good = np.zeros((m, length + 1, 4, 4), dtype=bool)
    if length:
        here, after = togo[:, :-1], togo[:, 1:]
        role, fault = codes % 4, codes // 4
        inside = (np.arange(length) < n[:, None])[..., None]
        free = inside & ~np.isin(fault, (BLANK, DUPLICATE))[..., None]
        extra = np.where(fault == TRUNCATED, CUT_OFF, 0)[..., None]
        to = KEPT[:, role].transpose(1, 2, 0)
        reach = np.maximum(to, 0)
        row, following = nodes[:, :-1, :1], nodes[:, 1:, :1]
        for k, (ok, price, at) in enumerate(
            (
                (inside, after + DELETE, following + np.arange(4)),
                (inside, here[..., NEXT] + INSERT, row + NEXT),
                (free & (to >= 0), np.take_along_axis(after, reach, 2) + KEEP + extra, following + reach),
                (free, after[..., NEXT] + REROLE + extra, following + NEXT),
            )
        ):
            good[:, :-1, :, k] = ok & (price == here)
            target[:, :-1, :, k] = at
    return letter, target.reshape(-1, 4), good.reshape(-1, 4)


def _doubled(letter: np.ndarray, target: np.ndarray, good: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Pointers 1, 2, 4, ... arcs on along the least way, until all have arrived, and the nodes' ranks
    by their whole least audits."""
    some = good.any(1)
    least = np.where(good, letter, 9).argmin(1)
    nodes = np.arange(len(some))
    pointer = np.where(some, target[nodes, least], nodes)
    rank = np.where(some, letter[nodes, least], 0)
    pointers = [pointer]
    while some[pointer].any():
        pair = rank * (rank.max() + 1) + rank[pointer]
        rank = np.unique(pair, return_inverse=True)[1].reshape(-1)
        pointer = pointer[pointer]
        pointers.append(pointer)
    return pointers, rank


def _walked(entry: np.ndarray, pointers: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """Letters along the least way from each entry: the node at letter j by the bits of j."""
    at = entry[:, None]
    for pointer in reversed(pointers[:-1]):
        at = np.stack([at, pointer[at]], axis=2).reshape(len(entry), -1)
    return chosen[at]


def ends_to_go(blocks: DataFrame) -> DataFrame:
    """block and ``togo``: the cheapest cost per state after each block, from the matrices of the
    later blocks of its conversation. Blocks come last first, so a task holds one vector."""

    def backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, vector = object(), AT_END
        for batch in batches:
            out = []
            for conv, flat in zip(batch.column("conv_id").to_pylist(), batch.column("matrix").to_pylist(), strict=True):
                if conv != current:
                    current, vector = conv, AT_END
                out.append(vector)
                vector = np.minimum((np.array(flat, np.int64).reshape(4, 4) + vector).min(1), FAR)
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), pa.array([v.tolist() for v in out], pa.list_(pa.int64()))], names=["block", "togo"]
            )

    return (
        blocks.select("conv_id", "block", "matrix")
        .repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id"), F.col("block").desc())
        .mapInArrow(backwards, "block long, togo array<long>")
    )


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        codes = [np.frombuffer(c, np.uint8) for c in batch.column("codes").to_pylist()]
        end = np.asarray(batch.column("togo").flatten()).reshape(-1, 4)
        audits, ends, cost = least_audits(codes, end)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("block"),
                pa.array([[a.decode() for a in x] for x in audits], pa.list_(pa.string())),
                pa.array(ends.tolist(), pa.list_(pa.int64())),
                pa.array(cost[:, EMPTY], pa.int64()),
            ],
            names=["block", "audits", "ends", "cost"],
        )


_NAMES = ("user", "assistant")


class _Repaired:
    """The conversation at hand: its counts, audit and digest so far."""

    def __init__(self, conv):
        self.conv, self.state, self.started, self.cost = conv, EMPTY, False, None
        self.audit: list[str] = []
        self.sha = hashlib.sha256()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns, self.low, self.high, self.last_turn, self.last_role = 0, None, None, None, None

    def line(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.started else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.started = True

    def add_counts(self, b: dict) -> None:
        for c in self.counts:
            self.counts[c] += b[c]
        if self.last_role is not None and b["first_role"] is not None:
            legal = (self.last_role, b["first_role"]) in ((0, 1), (1, 2), (2, 1))
            self.counts["illegal"] += not legal
        self.last_role = b["last_role"] if b["last_role"] is not None else self.last_role
        if b["turns"]:
            self.turns += b["turns"] - (b["first_turn"] == self.last_turn)
            self.low = b["least_turn"] if self.low is None else self.low
            self.high = self.last_turn = b["last_turn"]

    def edit(self, audit: str, end: int, roles: list[str], texts: list[str]) -> None:
        state, row = self.state, 0
        for letter in audit:
            if letter == "I":
                state = int(NEXT[state])
                self.line(_NAMES[state == ASSISTANT], "")
                continue
            if letter == "K":
                state = int(KEPT[state, {"s": 0, "u": 1, "a": 2}.get(roles[row][:1], 3)])
                self.line(roles[row], texts[row])
            elif letter == "R":
                state = int(NEXT[state])
                self.line(_NAMES[state == ASSISTANT], texts[row])
            row += 1
        self.audit.append(audit)
        self.state = end

    def row(self) -> tuple:
        # what is left to insert once all rows are gone
        tail = {SYSTEM: "II", USER: "I"}.get(self.state, "")
        self.edit(tail, ASSISTANT, [], [])
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts.values(), self.cost or 0, "".join(self.audit), self.sha.hexdigest())


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation and block; of a block, its audits come before its texts."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    at, plan = None, None
    for batch in batches:
        schema = pa.schema(
            [("conv_id", batch.schema.field("conv_id").type)]
            + [(c, pa.int64()) for c in names[1:7]]
            + [(c, pa.string()) for c in names[7:]]
        )
        done = []
        for b in batch.to_pylist():
            if at is None or b["conv_id"] != at.conv:
                if at is not None:
                    done.append(at.row())
                at = _Repaired(b["conv_id"])
            if b["side"] == 0:
                plan = b
                at.add_counts(b)
                at.cost = b["cost"] if at.cost is None else at.cost
            else:
                at.edit(plan["audits"][at.state], plan["ends"][at.state], b["roles"], b["texts"])
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(at.row(), schema, strict=True)], schema=schema)


def repaired_conversations(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The cheapest repair of every conversation of ``turns`` (conv_id, turn, role, text; as
    ``damaged_turns``, whose dropped rows count as missing): conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit and repaired_sha256.

    Rows go by turn (null first), ties by role and md5 of the text; rows without a conv_id are one
    conversation; repeated rows are duplicates. A role's initial is its first character; rows of
    any other initial than s, u or a, or of none, cannot be kept as they are. Blank texts count as
    blank, long ones are taken whole. A conversation without rows has zeros, an empty audit and the
    digest of an empty text; an empty table gives no rows. Other columns are ignored. The digest of
    a conversation is one pass over its blocks in order, with one block in memory.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    blocks = stored(turn_blocks(turns, block_rows), "repair-rows")
    reduced = stored(faulted_blocks(blocks), "repair-blocks")
    audits = (
        reduced.select("block", "codes")
        .join(ends_to_go(reduced), "block")
        .mapInArrow(_audited, "block long, audits array<string>, ends array<long>, cost long")
    )
    plans = reduced.drop("codes", "matrix").join(audits, "block").withColumn("side", F.lit(0))
    texts = blocks.select("conv_id", "block", "roles", "texts", F.lit(1).alias("side"))
    return (
        plans.unionByName(texts, allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "block", "side")
        .mapInArrow(
            _digested,
            f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired_sha256 string",
        )
    )
