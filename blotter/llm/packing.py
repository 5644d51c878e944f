"""Best-fit packing by a linear grouping scheme.

Documents become token pieces of at most ``capacity``; how they are packed depends on their
lengths only, so the plan is made from the histogram of lengths (at most ``capacity`` rows,
whatever the number of documents):

1. lengths above ``large`` are cut into groups of equal cardinality and rounded up to the
   largest of their group, which leaves a few sizes;
2. the configurations of these sizes are optimised as a linear programme by column generation
   and rounded to whole sequences;
3. the actual lengths take the places of the rounded ones;
4. the small lengths go, longest first, where they fit best.

The plan is a list of slots: from rank ``start`` on, the pieces of one length go to the
sequences from ``sequence`` on. Pieces get their rank within a length in two steps (salted
chunks of a length, then the chunks' offsets), so a length shared by a third of all pieces is
ranked by many tasks.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotter.llm.common import stored

CAPACITY = 4096
END_ID = 1
#: Lengths above capacity / LARGE_PART are large; they are rounded to about so many sizes,
#: whichever of these counts gives the fewest sequences.
LARGE_PART = 4
GROUPS = (8, 12, 24)
#: Pieces ranked together within a length.
CHUNK = 256
#: Chunks whose sizes are summed up together.
GROUP = 1024
VOCABULARY = "word_bpe_49k.json"


# --- pieces ---------------------------------------------------------------------------------

#: White-space words kept with their ids by a Python worker, over its batches and tasks.
KNOWN_WORDS = 600_000
#: A word of these characters is normalised by lower() alone; others go through the tokenizer.
_PLAIN = re.compile(r"[\x21-\x7eÀ-ɏ]*")
#: Texts with these are encoded whole: separators that only Python counts as white space, and
#: the start of the vocabulary's special tokens.
_WHOLE = re.compile(r"[\x1c-\x1f]|<\|")


class WordEncoder:
    """Token ids of texts, as the tokenizers library gives them for this vocabulary. It splits
    at white space and never joins across it, so each distinct word is encoded once."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        # the byte alphabet of byte-level vocabularies: printable bytes stand for themselves
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = str.maketrans({b: chr(256 + k) for k, b in enumerate(hidden)})
        self.code = [int(i).to_bytes(4, "little") for i in range(self.whole.get_vocab_size())]
        self.known: dict[str, bytes] = {}
        self.known_parts: dict[str, bytes] = {}

    def part(self, part: str) -> bytes:
        """Ids of one pre-token: lower-case letters, a digit or a run of marks."""
        found = self.known_parts.get(part)
        if found is None:
            shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.alphabet)
            code = self.code
            found = self.known_parts[part] = b"".join([code[t.id] for t in self.model.tokenize(shown)])
        return found

    def word(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word):
            return np.array(self.whole.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        word = word.lower()
        if word.isalpha():
            return self.part(word)
        if word[:-1].isalpha() and word[-1] in ".,;:!?":
            return self.part(word[:-1]) + self.part(word[-1])
        return b"".join([self.part(p) for p in self.parts.findall(word)])

    def text(self, text: str) -> bytes:
        if _WHOLE.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        words = text.split()
        known = self.known
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            if len(known) > KNOWN_WORDS:
                known.clear()
                self.known_parts.clear()
            for w in {w for w in words if w not in known}:
                known[w] = self.word(w)
            return b"".join([known[w] for w in words])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None
) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of the token ids of every document, each
    followed by ``end_id``. Only a document longer than ``capacity`` is cut; its last piece may
    be shorter. A null text counts as empty and is one piece of one id; repeated rows give
    their pieces each time. ``vocabulary``: path of a tokenizers file that every worker sees
    (the installed public one by default)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary or vocabulary_path())
        last = np.array([end_id], dtype="<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            where, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = enc.text(text or "") + last
                for k, a in enumerate(range(0, len(ids), step)):
                    part = ids[a : a + step]
                    where.append(row)
                    piece.append(k)
                    start.append(a // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(where, pa.int32())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


# --- the plan, from the histogram of lengths ----------------------------------------------


def best_pattern(value: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Counts per size of the fullest-valued sequence: a knapsack by number of items, of which
    few fit because the sizes are large."""
    most = capacity // int(sizes.min())
    best, picks = np.zeros(capacity + 1), []
    for _ in range(most):
        gain, pick = best.copy(), np.full(capacity + 1, -1)
        for k, size in enumerate(sizes):
            with_it = best[:-size] + value[k]
            better = with_it > gain[size:] + 1e-12
            gain[size:][better] = with_it[better]
            pick[size:][better] = k
        best = gain
        picks.append(pick)
    counts, room = np.zeros(len(sizes)), capacity
    for pick in reversed(picks):
        if pick[room] >= 0:
            counts[pick[room]] += 1
            room -= int(sizes[pick[room]])
    return counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, of the linear programme that covers the
    demand with the fewest sequences: a simplex basis improved by the best pattern for its
    prices until no pattern is worth more than one sequence."""
    basis = np.diag((capacity // sizes).astype(float))
    for _ in range(20 * len(sizes)):
        inverse = np.linalg.inv(basis)
        use = inverse @ demand
        price = np.ones(len(sizes)) @ inverse
        pattern = best_pattern(price, sizes, capacity)
        if price @ pattern <= 1 + 1e-6:
            break
        change = inverse @ pattern
        ratio = np.where(change > 1e-9, use / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(ratio.argmin())] = pattern
    return basis, np.linalg.solve(basis, demand)


class _Open:
    """Unfinished sequences as runs of equal room: (first sequence, how many, fill so far)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def add(self, sequence: int, count: int, room: int) -> None:
        if count > 0 and room > 0:
            if not self.runs[room]:
                insort(self.rooms, room)
            self.runs[room].append((sequence, count))

    def tightest(self, length: int) -> tuple[int, int, int] | None:
        k = bisect_left(self.rooms, length)
        if k == len(self.rooms):
            return None
        room = self.rooms[k]
        sequence, count = self.runs[room].pop()
        if not self.runs[room]:
            self.rooms.pop(k)
        return sequence, count, room


def plan_slots(
    counts: dict[int, int], capacity: int = CAPACITY, group_counts: tuple[int, ...] = GROUPS
) -> np.ndarray:
    """The grouped plan of fewest sequences among the given group counts."""
    plans = [grouped_plan(counts, capacity, g) for g in group_counts]
    return min(plans, key=sequence_count)


def sequence_count(slots: np.ndarray) -> int:
    return int((slots[:, 4] - (slots[:, 1] - slots[:, 2]) // slots[:, 3]).max()) if len(slots) else 0


def grouped_plan(counts: dict[int, int], capacity: int, group_count: int) -> np.ndarray:
    """Slots (length, start, end, each, sequence, offset) for a histogram of lengths.

    The pieces of ``length`` with ranks ``start`` to ``end`` go to consecutive sequences from
    ``sequence`` on, ``each`` of them side by side in every sequence, the first at ``offset``.
    The number of slots depends on the number of distinct lengths, not on their counts.
    """
    slots: list[tuple[int, int, int, int, int, int]] = []
    taken: dict[int, int] = defaultdict(int)
    free = _Open(capacity)
    sequences = 0

    def place(length: int, number: int, each: int, sequence: int, offset: int) -> None:
        slots.append((length, taken[length], taken[length] + number, each, sequence, offset))
        taken[length] += number

    # whole sequences first
    full = counts.get(capacity, 0)
    if full:
        place(capacity, full, 1, 0, 0)
        sequences = full
    bound = capacity // LARGE_PART
    large = sorted((n, c) for n, c in counts.items() if bound < n < capacity and c > 0)
    if large:
        lengths = np.array([n for n, _ in large])
        ends = np.cumsum([c for _, c in large])
        total = int(ends[-1])
        # equal cardinality: group k holds the ranks up to cuts[k]
        cuts = np.unique((np.arange(1, min(group_count, total) + 1) * total) // min(group_count, total))
        tops = lengths[np.searchsorted(ends, cuts)]
        sizes = np.unique(tops)
        demand = np.diff(np.r_[0, [cuts[tops == s].max() for s in sizes]]).astype(float)
        # the pieces of each group, longest first: (length, how many)
        stock: list[list[list[int]]] = []
        low = 0
        for high in np.cumsum(demand).astype(int):
            inside = [
                [int(n), int(min(e, high) - max(b, low))]
                for n, b, e in zip(lengths, np.r_[0, ends[:-1]], ends, strict=True)
                if min(e, high) > max(b, low)
            ]
            stock.append(inside[::-1])
            low = int(high)
        basis, use = configurations(sizes, demand, capacity)
        order = np.argsort(-(basis.T @ sizes))
        for j in order:
            pattern = [g for g in range(len(sizes)) for _ in range(int(round(basis[g, j])))][::-1]
            if not pattern:
                continue
            left = int(np.floor(use[j] + 1e-9))
            while left > 0:
                run, heads = left, []
                needs = {g: pattern.count(g) for g in set(pattern)}
                heads = {}
                for g, need in needs.items():
                    if not stock[g]:
                        run = 0
                        break
                    length, have = stock[g][0]
                    # a stock that ends within a sequence gives its rest to one mixed sequence
                    heads[g] = [length] * need
                    if have >= need:
                        run = min(run, have // need)
                    else:
                        run = min(run, 1)
                        some = [n for n, c in stock[g] for _ in range(min(c, need))][:need]
                        if len(some) < need:
                            run = 0
                            break
                        heads[g] = some
                if run == 0:
                    break
                offset = 0
                for g in needs:
                    for length in heads[g]:
                        place(length, run, 1, sequences, offset)
                        offset += length
                        for item in stock[g]:
                            if item[0] == length:
                                item[1] -= run
                                break
                    stock[g] = [item for item in stock[g] if item[1] > 0]
                free.add(sequences, run, capacity - offset)
                sequences += run
                left -= run
    # what rounding left over, and the small ones: longest first, where they fit best
    for length in sorted((n for n in counts if n < capacity), reverse=True):
        number = counts[length] - taken[length]
        while number > 0:
            run = free.tightest(length)
            if run is None:
                each = capacity // length
                whole = number // each
                if whole:
                    run = (sequences, whole, capacity)
                    sequences += whole
                else:
                    run = (sequences, 1, capacity)
                    sequences += 1
            sequence, count, room = run
            each = room // length
            used = min(count, number // each)
            if used:
                place(length, used * each, each, sequence, capacity - room)
                free.add(sequence, used, room - each * length)
                free.add(sequence + used, count - used, room)
                number -= used * each
            else:
                place(length, number, number, sequence, capacity - room)
                free.add(sequence, 1, room - number * length)
                free.add(sequence + 1, count - 1, room)
                number = 0
    return np.array(slots, dtype=np.int64).reshape(-1, 6)


# --- placing the pieces --------------------------------------------------------------------


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, chunk: int = CHUNK) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with ``sequence_id`` and ``offset``.

    ``pieces`` must be a stored table with ``deal``, a number of its own for every row: it is read
    for the histogram and again for the places. Pieces of a length are dealt to chunks by that
    number, so repeated rows spread as others do.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan_slots(counts, capacity)
    # chunks per length, so that each holds about `chunk` pieces; one row per length
    rows = [(length, -(-n // chunk)) for length, n in counts.items()]
    parts = F.broadcast(spark.createDataFrame(rows, "length long, parts long").coalesce(1))
    salted = pieces.join(parts, "length").withColumn(
        "salt", F.pmod(F.xxhash64("deal"), F.col("parts"))
    )
    # offsets of the chunks of a length: within groups of chunks, then over the groups
    earlier = (Window.unboundedPreceding, -1)
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).withColumn("group", F.floor(F.col("salt") / GROUP))
    in_group = Window.partitionBy("length", "group").orderBy("salt").rowsBetween(*earlier)
    across = Window.partitionBy("length").orderBy("group").rowsBetween(*earlier)
    groups = sizes.groupBy("length", "group").agg(F.sum("n").alias("n")).select(
        "length", "group", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("groups_before")
    )
    offsets = (
        sizes.select("length", "salt", "group", F.coalesce(F.sum("n").over(in_group), F.lit(0)).alias("before"))
        .join(groups, ["length", "group"])
        .select("length", "salt", (F.col("before") + F.col("groups_before")).alias("first"))
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "deal")
    ranked = (
        salted.withColumn("rank", F.row_number().over(within) - 1)
        .join(offsets, ["length", "salt"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("first")).alias("rank"))
    )
    # one row per slot, a few for each distinct length: bounded by the capacity
    order = np.lexsort((slots[:, 1], slots[:, 0])) if len(slots) else np.zeros(0, dtype=np.int64)
    plan = spark.sparkContext.broadcast(slots[order])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plan.value
        wide = np.int64(1) << np.int64(48)
        keys = table[:, 0] * wide + table[:, 1]
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            slot = table[np.searchsorted(keys, length * wide + rank, side="right") - 1]
            turn = rank - slot[:, 1]
            sequence = slot[:, 4] + turn // slot[:, 3]
            offset = slot[:, 5] + turn % slot[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(
        put,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents with the sequence and offset they are packed at. An empty table
    gives no rows; a null id is an id like others, and repeated rows are packed each; texts of any
    length are cut into pieces of ``capacity``; other columns are ignored."""
    pieces = token_pieces(docs, capacity, vocabulary=vocabulary).withColumn("deal", F.monotonically_increasing_id())
    pieces = stored(pieces, "pieces")
    return place_pieces(pieces, capacity)
