"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models over the symbols of a word, one of toxic and one of ordinary
text, give each word a log-likelihood ratio. Their high orders are counted per class; the low
orders, to which rare expressions back off, are shared: how often each n-gram occurs in *all*
documents, so that junk counts as rarely as it is. A document's ratio is divided by its length; so is
each word's, and the largest of its words' ratios tells of one toxic word in a long text.

Expressions of several words are modelled the same way: word bigrams and trigrams per class,
which back off to shared continuation counts of the words over all documents. Their ratio is a
measure of its own, so that a calibrated curve weighs it against that of the symbols.

Counts are Spark aggregates over the texts of the sample and of the documents, stored as tables;
texts never come to the driver, only merged counts of the sample's n-grams do. Symbols are 64 classes of bytes, and n-grams end at word borders, so each
distinct word of a batch is scored once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotter.llm.common import _powers, held_out, logistic, mixed, stored
from blotter.llm.labelled import Curve, sample_rows

TOP = 6  #: highest order, counted per class
SHARED = 3  #: highest order that both classes share
BITS = 6
THRESHOLD = 0.5
#: Rows per class of the fitting sample.
ROWS = 2000
#: Leading bits of a hash that tell whether it may be known.
MARK_BITS = 23
#: Word pairs that a task holds before it sends them.
SENT_PAIRS = 4_000_000


def _symbols() -> np.ndarray:
    """Byte to symbol: 0 ends a word (white space, marks), letters without case, one symbol for
    digits, one for the first bytes of other characters, 32 for their further bytes (without
    the bit that tells Latin capitals from small letters)."""
    table = np.zeros(256, dtype=np.uint8)
    for b in range(26):
        table[[0x41 + b, 0x61 + b]] = 1 + b
    table[0x30:0x3A] = 27
    table[0x80:0xC0] = 32 + (np.arange(0x80, 0xC0) & 0x1F)
    table[0xC0:0x100] = 28 + (np.arange(0xC0, 0x100) >> 4 & 3)
    return table


SYMBOL = _symbols()


def _words(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """Symbols of some texts joined, and start, end, hash and text of each word in them."""
    data = " ".join([*(t or "" for t in texts), ""]).encode("utf-8", "replace")
    symbols = SYMBOL[np.frombuffer(data, dtype=np.uint8)] if data else np.zeros(1, np.uint8)
    inside = symbols > 0
    starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    ends = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1
    up, down = _powers(len(symbols) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(symbols.astype(np.uint64) * up[: len(symbols)], out=total[1:])
        hashes = mixed((total[ends] - total[starts]) * down[starts])
    # the texts' own borders in bytes, one more for each joining space
    sizes = np.array([len((t or "").encode("utf-8", "replace")) + 1 for t in texts], dtype=np.int64)
    text = np.searchsorted(np.cumsum(sizes), starts, side="right")
    return symbols, starts, ends, hashes, text


def word_grams(texts: list[str | None], words: tuple[np.ndarray, ...] | None = None) -> tuple[np.ndarray, ...]:
    """Distinct words of some texts, as n-grams of ``TOP`` symbols.

    Returns keys (one per position of each distinct word, its end included), the first position
    of each distinct word, and for every word of the texts its distinct word and its text.
    """
    symbols, starts, ends, hashes, text = words or _words(texts)
    if len(starts) == 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty
    _, first, word = np.unique(hashes, return_index=True, return_inverse=True)  # equal words, equal hash
    size = ends[first] - starts[first] + 1
    begin = np.r_[0, np.cumsum(size)[:-1]]
    place = np.arange(int(size.sum())) - np.repeat(begin, size)
    at = np.repeat(starts[first], size) + place
    keys = np.zeros(len(at), dtype=np.int64)
    for k in range(TOP):
        symbol = np.where(place >= k, symbols[np.maximum(at - k, 0)], 0).astype(np.int64)
        keys |= symbol << np.int64(BITS * k)
    return keys, begin, word, text


def _low(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & np.int64((1 << (BITS * order)) - 1)


def _counted(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several (keys, counts) as one."""
    keys, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
    return keys, np.bincount(at, weights=np.concatenate([h[1] for h in held]), minlength=len(keys)).astype(np.int64)


def gram_counts(texts: list[str | None], order: int = TOP) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of an order in some texts and how often each occurs."""
    keys, begin, word, _ = word_grams(texts)
    each = np.repeat(np.bincount(word, minlength=len(begin)), np.diff(np.r_[begin, len(keys)]))
    return _counted([(_low(keys, order), each)])


def class_grams(rows: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per class, the n-grams of the highest order in ``rows`` (y, text) and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for c in np.unique(y):
                grams, n = gram_counts([t for t, own in zip(texts, y, strict=True) if own == c])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams), c, np.int32)), pa.array(grams), pa.array(n)], names=["y", "gram", "n"]
                )

    counts = rows.select("y", "text").mapInArrow(count, "y int, gram long, n long").groupBy("y", "gram").agg(F.sum("n").alias("n"))
    found = counts.orderBy("gram").toArrow()
    y, gram, n = (found.column(c).to_numpy() for c in ("y", "gram", "n"))
    return [(gram[y == c], n[y == c]) for c in (0, 1)]


def shared_counts(docs: DataFrame, grams: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per shared order, from 1: the n-grams among ``grams`` (of the sample) with their counts over
    every whole text of ``docs``, and per n-gram the count and the kinds of all that follow its
    context there. The counts of all documents stay a table; only the sample's rows come back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            held.append(gram_counts(batch.column(0).to_pylist(), SHARED))
            if len(held) >= 32:
                held = [_counted(held)]
        if held:
            keys, n = _counted(held)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["gram", "n"])

    counted = stored(
        docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "symbol-counts"
    )
    out = []
    for order in range(1, SHARED + 1):
        mask = (1 << (BITS * order)) - 1
        own = counted.groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.sum("n").alias("n"))
        follow = own.groupBy(F.shiftright("gram", BITS).alias("context")).agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds")
        )
        wanted = docs.sparkSession.createDataFrame(pa.table({"gram": np.unique(_low(grams, order))}))
        found = (
            wanted.withColumn("context", F.shiftright("gram", BITS))
            .join(own, "gram", "left")
            .join(follow, "context", "left")
            .na.fill(0)
            .orderBy("gram")
            .toArrow()
        )
        out.append(tuple(found.column(c).to_numpy() for c in ("gram", "n", "total", "kinds")))
    return out


def _discount(counts: np.ndarray) -> float:
    once, twice = float((counts == 1).sum()), float((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


def _continued(types: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Kneser-Ney counts: how many types one order above end in each n-gram."""
    return np.unique(_low(types, order), return_counts=True)


class _Level:
    """One order of an interpolated model: discounted shares and back-off weights."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts.astype(np.float64)
        self.cut = _discount(counts)
        self.contexts, at, kinds = np.unique(keys >> BITS, return_inverse=True, return_counts=True)
        self.sums = np.bincount(at, weights=self.counts)
        self.weights = self.cut * kinds / self.sums
        self.shares = np.maximum(self.counts - self.cut, 0) / self.sums[at]

    def back_off(self, contexts: np.ndarray) -> np.ndarray:
        """Weight of the lower order; an unseen context leaves everything to it."""
        return _found(self.contexts, self.weights, contexts, 1.0)

    def probability(self, keys: np.ndarray, lower: np.ndarray) -> np.ndarray:
        return _found(self.keys, self.shares, keys, 0.0) + self.back_off(keys >> BITS) * lower


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise: float) -> np.ndarray:
    if len(keys) == 0:
        return np.full(len(wanted), otherwise)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], otherwise)


def _marked(keys: np.ndarray) -> np.ndarray:
    """Which leading bits occur among hashes: most that are looked up are not known, and end here."""
    marks = np.zeros(1 << MARK_BITS, dtype=bool)
    marks[keys >> np.uint64(64 - MARK_BITS)] = True
    return marks


def _known(keys: np.ndarray, values: np.ndarray, marks: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted hashes are among the keys, and their values."""
    some = np.flatnonzero(marks[wanted >> np.uint64(64 - MARK_BITS)])
    at = np.minimum(np.searchsorted(keys, wanted[some]), max(len(keys) - 1, 0))
    hit = keys[at] == wanted[some] if len(keys) else np.zeros(len(some), dtype=bool)
    return some[hit], values[at[hit]]


# --- expressions of several words ------------------------------------------------------------


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(mixed(a + np.uint64(0x9E37)) + np.uint64(3) * b)


def _three(hashes: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
    """Hashes of each word, of the one before it and of the one before that, 0 before a text's start."""
    out = [hashes, np.zeros(len(hashes), dtype=np.uint64), np.zeros(len(hashes), dtype=np.uint64)]
    for k in (1, 2):
        same = text[k:] == text[:-k]
        out[k][k:][same] = hashes[:-k][same]
    return out


def phrase_grams(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Per word: hash of the word, of the one before it (0 at a text's start), and of its word
    bigram, of the context of its trigram and of the trigram, as rows of a matrix."""
    last, before, first = _three(hashes, text)
    context = _pair(first, before)
    return np.stack([last, before, _pair(before, last), context, _pair(context, last)])


def phrase_counts(rows: DataFrame) -> DataFrame:
    """Distinct word trigrams of ``rows`` (y, text): the hashes of their words, the last first (0
    before a text's start), and how often each class has them, n0 and n1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(0).to_numpy()
            *_, hashes, text = _words(batch.column(1).to_pylist())
            last, before, first = _three(hashes, text)
            trigram = _pair(_pair(first, before), last)
            for c in np.unique(y):
                own = np.flatnonzero(y[text] == c)
                _, at, n = np.unique(trigram[own], return_index=True, return_counts=True)
                words = [pa.array(w[own[at]].view(np.int64)) for w in (last, before, first)]
                none = np.zeros(len(n), np.int32)
                times = [n.astype(np.int32) if c == k else none for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*words, *map(pa.array, times)], names=["w0", "w1", "w2", "n0", "n1"])

    found = rows.select("y", "text").mapInArrow(count, "w0 long, w1 long, w2 long, n0 int, n1 int")
    return found.groupBy("w0", "w1", "w2").agg(*(F.sum(n).cast("int").alias(n) for n in ("n0", "n1")))


def followed_words(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kneser-Ney counts of the sample's words over every whole text of ``docs``: after how many
    distinct words each occurs."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def sent(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs)], names=["pair"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # place of the word in the vocabulary, and 32 bits of the hash of the word before it
        words = known.value
        held: list[np.ndarray] = []
        for batch in batches:
            *_, hashes, text = _words(batch.column(0).to_pylist())
            before = np.zeros(len(hashes), dtype=np.uint64)
            same = text[1:] == text[:-1]
            before[1:][same] = hashes[:-1][same]
            distinct, every = np.unique(hashes, return_inverse=True)  # looked up once each
            place = np.minimum(np.searchsorted(words, distinct), max(len(words) - 1, 0))
            known_word = words[place] == distinct if len(words) else np.zeros(len(distinct), dtype=bool)
            at, hit = place[every], known_word[every]
            held.append(np.unique(at[hit] << 32 | (before[hit] & np.uint64(0xFFFFFFFF)).astype(np.int64)))
            if sum(map(len, held)) > SENT_PAIRS:
                held = [np.unique(np.concatenate(held))]
                if len(held[0]) > SENT_PAIRS // 2:
                    yield sent(held.pop())
        if held:
            yield sent(np.unique(np.concatenate(held)))

    pairs = docs.select("text").mapInArrow(mark, "pair long").distinct()
    found = pairs.groupBy(F.shiftright("pair", 32).alias("place")).agg(F.count("*").alias("n")).toArrow()
    place = found.column("place").to_numpy()
    order = np.argsort(place)
    return vocabulary[place[order]], found.column("n").to_numpy()[order]


def _phrase_order(
    contexts: np.ndarray, counts: list[np.ndarray], lower: list[np.ndarray]
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per class, the probabilities of word n-grams of one order from their counts and those one
    order below; then the contexts, sorted, with the log ratio of their back-off weights. A class
    that lacks a context leaves everything to the order below."""
    known, at = np.unique(contexts, return_inverse=True)
    at = at.astype(np.int32)
    p, weights = [], []
    for n, below in zip(counts, lower, strict=True):
        cut = _discount(n)
        sums = np.bincount(at, weights=n, minlength=len(known))
        kinds = np.bincount(at[n > 0], minlength=len(known))
        weight = np.where(sums > 0, cut * kinds / np.maximum(sums, 1), 1.0)
        p.append(np.maximum(n - cut, 0) / np.maximum(sums, 1)[at] + weight[at] * below)
        weights.append(weight)
    return p, known, _log_ratio(weights)


def _log_ratio(p: list[np.ndarray]) -> np.ndarray:
    return (np.log(p[1]) - np.log(p[0])).astype(np.float32)


def fit_phrases(rows: DataFrame, docs: DataFrame) -> list[tuple[np.ndarray, ...]]:
    """The word models of ``rows`` (y, text). For word trigrams, then bigrams: known grams with
    their log ratio, and contexts with the log ratio of their back-off weights. Both classes back
    off to the shared words. Only merged counts come to the driver: five numbers per distinct
    trigram of the sample, and one per word of it over all documents."""
    found = phrase_counts(rows).toArrow()
    last, before, first = (found.column(w).to_numpy().view(np.uint64) for w in ("w0", "w1", "w2"))
    times = [found.column(n).to_numpy().copy() for n in ("n0", "n1")]
    del found
    pa.default_memory_pool().release_unused()
    context = _pair(first, before)
    del first
    vocabulary, followed = followed_words(docs, np.unique(last))
    # bigrams: in how many kinds of trigrams of a class each ends
    pairs, one, at = np.unique(_pair(before, last), return_index=True, return_inverse=True)
    at = at.astype(np.int32)
    kinds = [np.bincount(at[n > 0], minlength=len(pairs)) for n in times]
    total = max(followed.sum(), 1)
    base = np.maximum(_found(vocabulary, followed / total, last[one], 0.0), 1.0 / total)
    low, pair_contexts, pair_weights = _phrase_order(before[one], kinds, [base, base])
    del before, one, kinds, base
    p, contexts, weights = _phrase_order(context, times, [q[at] for q in low])
    trigrams = _pair(context, last)
    del context, last, at, times
    order = np.argsort(trigrams)  # grams are looked up in order
    return [
        (trigrams[order], _log_ratio(p)[order], contexts, weights),
        (pairs, _log_ratio(low), pair_contexts, pair_weights),
    ]


class ToxicityCurve(Curve):
    """A curve over both ratios, each also times the log of the length, that log, and the ratio of
    the most toxic word."""

    def __init__(self, measures: np.ndarray, y: np.ndarray, share: float):
        self.fit(self.columns(measures), y, share)

    @staticmethod
    def columns(measures: np.ndarray) -> np.ndarray:
        log = np.log(np.maximum(measures[:, 3:], 1.0))
        return np.hstack([measures[:, :3], log, measures[:, :2] * log])

    def score(self, measures: np.ndarray) -> np.ndarray:
        return logistic(self.weights, self.columns(measures))


@dataclass
class ToxicityModel:
    """Per order above the shared ones: known n-grams with their log ratio, and contexts with
    the log ratio of their back-off weights, both sorted. No curve: labels of one class only."""

    orders: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    curve: ToxicityCurve | None
    share: float
    phrases: list[tuple[np.ndarray, ...]] = field(default_factory=list)
    marks: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # made where first needed

    def phrase_ratios(self, hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of each word after the two before it."""
        found = phrase_grams(hashes, text)
        if not self.marks:
            self.marks = [(_marked(grams), _marked(contexts)) for grams, _, contexts, _ in self.phrases]
        out = np.zeros(len(hashes))
        left = np.arange(len(hashes))
        for (grams, ratio, contexts, weight), marks, gram, context in zip(self.phrases, self.marks, (4, 2), (3, 1), strict=True):
            at, value = _known(grams, ratio, marks[0], found[gram][left])
            out[left[at]] += value
            left = np.delete(left, at)
            at, value = _known(contexts, weight, marks[1], found[context][left])
            out[left[at]] += value
        return out

    def ratios(self, keys: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio per position: an unknown n-gram gives its context's back-off
        ratio and is looked up one order lower; below that the shared counts cancel."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        for order in range(TOP, SHARED, -1):
            grams, ratio, contexts, weight = self.orders[order]
            wanted = _low(keys[left], order)
            at = np.minimum(np.searchsorted(grams, wanted), max(len(grams) - 1, 0))
            hit = grams[at] == wanted if len(grams) else np.zeros(len(left), dtype=bool)
            out[left[hit]] += ratio[at[hit]]
            left = left[~hit]
            out[left] += _found(contexts, weight, wanted[~hit] >> BITS, 0.0)
        return out

    def differences(self, texts: list[str | None]) -> np.ndarray:
        """Per text, as columns: the length-normalised log-likelihood ratios of its symbols and of
        its expressions, the largest such ratio of the symbols of one word, and the length. A text
        without words has zeros."""
        out = np.zeros((len(texts), 4))
        words = _words(texts)
        keys, begin, word, text = word_grams(texts, words)
        if len(keys) == 0:
            return out
        value = np.add.reduceat(self.ratios(keys), begin)
        size = np.diff(np.r_[begin, len(keys)])
        length = np.bincount(text, weights=size[word], minlength=len(texts))
        expressions = self.phrase_ratios(words[3], text) if self.phrases else np.zeros(len(text))
        for k, each in enumerate((value[word], expressions)):
            out[:, k] = np.bincount(text, weights=each, minlength=len(texts)) / np.maximum(length, 1.0)
        some, first = np.unique(text, return_index=True)  # words are in the order of their texts
        out[some, 2] = np.maximum.reduceat((value / size)[word], first)
        out[:, 3] = length
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.curve is None:
            return np.full(len(texts), self.share)
        return self.curve.score(self.differences(texts))


def _shared_probability(shared: list[tuple[np.ndarray, ...]], keys: np.ndarray) -> np.ndarray:
    """Interpolated probability of n-grams in all documents, from the lowest order up, with an
    absolute discount. An n-gram's count, and what follows its context, are over all documents."""
    p = np.full(len(keys), 1.0 / (1 << BITS))
    for order, (grams, counts, totals, kinds) in enumerate(shared, start=1):
        at = np.searchsorted(grams, _low(keys, order))
        cut = _discount(counts)
        whole = np.maximum(totals[at], 1)
        p = np.where(totals[at] > 0, np.maximum(counts[at] - cut, 0) / whole + cut * kinds[at] / whole * p, p)
    return p


def fit_symbols(rows: DataFrame, docs: DataFrame) -> dict[int, tuple[np.ndarray, ...]]:
    """Per order above the shared ones, known n-grams and contexts with their log ratios."""
    counted = class_grams(rows)
    shared = shared_counts(docs, np.concatenate([grams for grams, _ in counted]))
    # class orders: counts at the top, continuation counts of the class below
    levels = []
    for grams, times in counted:
        own = {TOP: _Level(grams, times)}
        higher = grams
        for order in range(TOP - 1, SHARED, -1):
            keys, counts = _continued(higher, order)
            own[order] = _Level(keys, counts)
            higher = keys
        levels.append(own)

    def probability(own: dict[int, _Level], keys: np.ndarray, order: int) -> np.ndarray:
        p = _shared_probability(shared, keys)
        for k in range(SHARED + 1, order + 1):
            p = own[k].probability(_low(keys, k), p)
        return p

    orders = {}
    for order in range(TOP, SHARED, -1):
        grams = np.union1d(levels[0][order].keys, levels[1][order].keys)
        ratio = np.log(probability(levels[1], grams, order)) - np.log(probability(levels[0], grams, order))
        contexts = np.union1d(levels[0][order].contexts, levels[1][order].contexts)
        weight = np.log(levels[1][order].back_off(contexts)) - np.log(levels[0][order].back_off(contexts))
        orders[order] = (grams, ratio.astype(np.float32), contexts, weight.astype(np.float32))
    return orders


def fit_toxicity(rows: DataFrame, share: float, docs: DataFrame) -> tuple[ToxicityModel, Broadcast | None]:
    """Models from the class counts of the sample ``rows`` (y, doc_id, text: two thirds of them) and
    the counts of all documents; the last third, scored on executors, gives the curve. Without three
    rows of both classes every text scores the labels' share. The model is sent to the executors
    once, without the curve, for this and for the scores."""
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if min(counts.get(0, 0), counts.get(1, 0)) < 3:
        return ToxicityModel({}, None, share), None
    # every third row of a class by the hash of its id; the window's rows are the bounded sample
    place = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id"))
    dealt = stored(rows.withColumn("check", place % 3 == 0), "toxicity-sample")
    learn = dealt.where(~F.col("check"))
    model = ToxicityModel(fit_symbols(learn, docs), None, share, fit_phrases(learn, docs))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sent.value.differences(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found.T)], names=["y", *names])

    names = ("symbols", "expressions", "top", "length")
    kinds = ", ".join(f"{name} double" for name in names)
    found = dealt.where("check").select("y", "text").mapInArrow(measure, f"y int, {kinds}").toArrow()
    y, *measures = (found.column(c).to_numpy().astype(np.float64) for c in ("y", *names))
    order = np.lexsort((*measures, y))  # the same sums whatever the order of the rows
    model.curve = ToxicityCurve(np.column_stack(measures)[order], y[order], share)
    return model, sent


def toxicity_scores(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``; a null text counts as
    empty, and a text without words has no difference. Only the text enters the score. Repeated rows
    score alike, very long texts are scored whole, an empty table gives no rows, other columns are
    ignored; without labels of both classes every text scores the labels' share."""
    rows, share = sample_rows(docs, labels, "toxic", ROWS)
    # its size follows the sample's bound, not the documents
    model, sent = fit_toxicity(stored(rows, "toxicity-rows"), share, docs)
    curve = model.curve
    del model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if sent is None:
                found = np.full(batch.num_rows, share)
            else:
                found = curve.score(sent.value.differences(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        docs.select("doc_id", "text")
        .mapInArrow(score, f"doc_id {kind}, score double")
        .select("doc_id", held_out().alias("held_out"), "score")
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
