"""Corpus preparation: quality, near-dedup, personal data, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written
as Parquet in the shared folder and read back as the next stage's ``docs``.  All
but the last return the columns of ``documents``; the last returns one row per
packed piece.

Defined cases: documents with a NULL id, source or language, with a NULL, blank or very
long text, repeated rows and an empty table pass each stage as its module states it;
columns beyond those of ``documents`` pass all stages but the last, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm.best_fit_packing import digest, vocabulary_path
from shelfwise.llm.common import read_table, scratch_path, scratch_run, written_to
from shelfwise.llm.minhash_dedup import one_of_each
from shelfwise.llm.pii_disclosure import sanitise
from shelfwise.llm.quality_gam import keep_quality
from shelfwise.llm.source_mixing import sample_mix


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality label is 1."""
    return keep_quality(docs, read_table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of near-duplicates
    (shingles of five words, similarity 0.8); of repeated rows one stays."""
    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and disclosing terms replaced."""
    return sanitise(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn by their calibrated probabilities."""
    return sample_mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of at most 4096 tokens."""
    return digest(docs, vocabulary_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: trained models, hashed signatures and a tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_run(spark):  # a stage's own tables go once its result stands
            docs = written_to(stage(spark, docs, sf_dir), path)
    return docs
