"""Bounded samples of labelled documents, for fitting the two classifiers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import fit_logistic, held_out, logistic

#: Bounds of a fitting sample: rows per class, and characters of an excerpt of each row (from a
#: place that a hash chooses). Only fitting is bounded; scoring reads every whole text.
ROWS = 3000
CHARS = 20_000


@dataclass
class Sample:
    """Excerpts by class; ``share`` is the exact share of class 1 among all labelled rows."""

    texts: tuple[list[str], list[str]]
    share: float

    def halves(self) -> tuple[tuple[list[str], list[str]], tuple[list[str], list[str]]]:
        """One part to learn from and one to calibrate on: two of three rows, and the third."""
        learn = tuple([t for k, t in enumerate(c) if k % 3 < 2] for c in self.texts)
        check = tuple(c[2::3] for c in self.texts)
        return learn, check


def sample_rows(
    docs: DataFrame, labels: DataFrame, label: str, rows: int = ROWS, chars: int = CHARS
) -> tuple[DataFrame, float]:
    """Up to ``rows`` training rows (y, doc_id, text) of each class, those of smallest id hash, and
    the exact share of class 1 among all labelled rows.

    Held-out ids, null ids and null labels are left out; several labels of one id count as 1
    when their mean is at least 0.5. The ids are bounded by 2 * ``rows``, so they are sent to
    the scan of the documents; a repeated id takes part once, with the least of its excerpts.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    )
    count = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.where(F.col("y") == c).orderBy(*by_hash).limit(rows) for c in (0, 1)]
    start = 1 + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.lit(1), F.length("text") - chars + 1)).cast("int")
    found = (
        docs.select("doc_id", "text")
        .where(F.col("text").isNotNull())
        .join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
        .select("y", "doc_id", F.substr("text", start, F.lit(chars)).alias("text"))
        .groupBy("y", "doc_id")
        .agg(F.min("text").alias("text"))
    )
    return found, (count.get(1, 0) + 1.0) / (sum(count.values()) + 2.0)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int = ROWS, chars: int = CHARS
) -> Sample:
    """``sample_rows`` as texts by class, in the order of their id hash."""
    found, share = sample_rows(docs, labels, label, rows, chars)
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * rows).collect()
    return Sample(tuple([r["text"] for r in found if r["y"] == c] for c in (0, 1)), share)


class Curve:
    """Calibrated score from a length-normalised difference: a logistic curve over the
    difference, the log of the length and their product, fitted on balanced rows and shifted to
    the true share of class 1."""

    def __init__(self, difference: np.ndarray, length: np.ndarray, y: np.ndarray, share: float):
        self.fit(self.columns(difference, length), y, share)

    def fit(self, columns: np.ndarray, y: np.ndarray, share: float) -> None:
        self.weights = fit_logistic(columns, y, 1e-4)
        both = 0 < y.sum() < len(y)
        seen = y.mean() if both else (y.sum() + 1.0) / (len(y) + 2.0)
        self.weights[0] += np.log(share / (1 - share)) - np.log(seen / (1 - seen))

    @staticmethod
    def columns(difference: np.ndarray, length: np.ndarray) -> np.ndarray:
        log = np.log(np.maximum(length, 1.0))
        return np.column_stack([difference, log, difference * log])

    def score(self, difference: np.ndarray, length: np.ndarray) -> np.ndarray:
        return logistic(self.weights, self.columns(difference, length))
