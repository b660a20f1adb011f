"""Corpus pipeline: language, exact copies, near copies, benchmark passages, token ids.

Each stage takes the documents that the one before it kept, and all but the last return
rows of the same columns. `run` writes every stage to the shared folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm import (
    decontaminate,
    exact_dedup,
    language_id,
    sentencepiece_sampling,
    simhash_dedup,
)
from cohortloom.llm.common import table
from cohortloom.sources.storage import scratch_path, scratch_scope

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; others and junk go.

    Null and empty texts and texts without letters go. Each row is judged by its text alone,
    however long, so repeated rows share their fate. Columns pass through; no rows give none.
    """
    return language_id.accepted_rows(docs, language_id.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest identifier stays.

    Null and empty texts are equal. Of rows that repeat that identifier too, the first of them
    by its columns stays. Columns of any name and type pass through; no rows give none.
    """
    return exact_dedup.keep_one(docs, exact_dedup.exact_duplicates(docs, keep="largest"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest identifier stays.

    Groups are linked by SimHash fingerprints over shingles of three words that differ in two
    bits at most. Each row is judged by its own whole text, also where identifiers repeat or
    are missing; texts without words are copies of each other. Columns of any name pass
    through; no rows give none.
    """
    return simhash_dedup.keep_one(docs, words=3)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Each row is judged by its whole text; null and empty texts hold nothing and stay, as does
    every row if the benchmark is empty. Columns pass through; no rows give none.
    """
    return decontaminate.without_matches(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of what is left, one row for each row.

    Null counts as empty, which has the empty segmentation; equal rows draw alike.
    """
    return sentencepiece_sampling.sample_segmentations(docs, MODEL)


STAGES = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("benchmark", benchmark),
    ("encode", encode),
]
# Models, fingerprints and sampling can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of a data folder.

    What a stage puts into the shared folder on its way is removed once its result is there.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
