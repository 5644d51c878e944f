"""A training corpus from raw documents: quality, near duplicates, secrets, mix, packing.

Each stage takes the documents that its predecessor kept, written as Parquet and read again.
All but the last return the columns of ``documents``; the last returns token pieces with their
places in sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blotter.llm.common import prepare, read, stored
from blotter.llm.mixing import mix_sources
from blotter.llm.ngram_join import keep_one_of_each
from blotter.llm.packing import pack_documents
from blotter.llm.quality import keep_good
from blotter.llm.secret_scan import mask_secrets


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores at least 0.3; the others go."""
    prepare(spark)
    return keep_good(docs, read(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    prepare(spark)
    return keep_one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found in a text masked and its length set anew."""
    prepare(spark)
    return mask_secrets(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources say."""
    prepare(spark)
    return mix_sources(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the mixed documents with their sequence and offset."""
    prepare(spark)
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scans", secret_scans),
    ("mixing_sources", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]

#: The classifier, the token ids and the packing have no SQL form; the tests hold the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result but the last is a written table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
