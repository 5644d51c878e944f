"""Quality classifier by compression.

Two zstandard dictionaries are built from excerpts of good and of bad labelled text. A text is
compressed with each, in blocks so that the dictionaries and not the text's own repetition
decide; the difference of the two sizes, divided by the length, is calibrated into a score.
The dictionaries are small and fixed in size; scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import held_out
from blotter.llm.labelled import Curve, Sample, labelled_sample

DICTIONARY_BYTES = 112_640
BLOCK = 512
LEVEL = 3
THRESHOLD = 0.3


@dataclass
class QualityModel:
    """Dictionaries for bad (0) and good (1) text, and the calibration; None: no labels."""

    dictionaries: tuple[bytes, bytes] | None
    curve: Curve | None
    share: float

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for content in self.dictionaries or ():
            d = zstandard.ZstdCompressionDict(content)
            d.precompute_compress(level=LEVEL)
            made.append(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)
            )
        return made

    def score(self, texts: list[str | None], compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
        if self.curve is None:
            return np.full(len(texts), self.share)
        data = [(t or "").encode("utf-8", "replace") for t in texts]
        size = np.array([len(x) for x in data], dtype=np.float64)
        return self.curve.score(differences(data, compressors), size)


def differences(data: list[bytes], compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Compressed size with the bad dictionary less that with the good one, per byte."""
    out = np.zeros(len(data))
    bad, good = (c.compress for c in compressors)
    for k, x in enumerate(data):
        blocks = [x[i : i + BLOCK] for i in range(0, len(x), BLOCK)]
        if blocks:
            out[k] = (sum(len(bad(b)) for b in blocks) - sum(len(good(b)) for b in blocks)) / len(x)
    return out


def dictionary(texts: list[str]) -> bytes:
    blocks = [x[i : i + BLOCK] for x in (t.encode("utf-8", "replace") for t in texts) for i in range(0, len(x), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: its bytes are the dictionary
        return b"".join(blocks)[-DICTIONARY_BYTES:] or b" " * 16


def fit_quality(sample: Sample) -> QualityModel:
    """Without both classes there is nothing to compare: every text scores the labels' share."""
    if min(map(len, sample.texts)) < 3:
        return QualityModel(None, None, sample.share)
    learn, check = sample.halves()
    model = QualityModel((dictionary(learn[0]), dictionary(learn[1])), None, sample.share)
    data = [t.encode("utf-8", "replace") for t in (*check[0], *check[1])]
    y = np.r_[np.zeros(len(check[0])), np.ones(len(check[1]))]
    size = np.array([len(x) for x in data], dtype=np.float64)
    model.curve = Curve(differences(data, model.compressors()), size, y, sample.share)
    return model


def with_quality(docs: DataFrame, model: QualityModel, score_col: str = "score") -> DataFrame:
    """``docs`` with a score between 0 and 1 for every whole text; a null text counts as empty,
    an empty one has no difference. A column of the same name is replaced."""
    docs = docs.drop(score_col)
    names = docs.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            found = model.score(batch.column(names.index("text")).to_pylist(), compressors)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*names, score_col])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    model = fit_quality(labelled_sample(docs, labels, "quality"))
    # an id is passed through for its flag only; the score sees nothing but the text
    return (
        with_quality(docs.select("doc_id", "text"), model)
        .select("doc_id", held_out().alias("held_out"), "score")
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score at least ``threshold``, with the same columns."""
    model = fit_quality(labelled_sample(docs, labels, "quality"))
    name = "quality_score_"
    return with_quality(docs, model, name).where(F.col(name) >= threshold).drop(name)
