"""Corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on every row that the stage before
kept, and all but the last return the columns of ``documents``.  ``run`` writes
each stage's rows as Parquet in the cluster's shared folder and reads them again
for the next one, so a lost executor never goes back beyond a stage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldops.llm import adaptive_quality, line_chunks, markov_secrets, mixture_packing, tensor_minhash  # noqa: E402
from fieldops.llm.common import documents, staged  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _counted(docs: DataFrame) -> DataFrame:
    """The columns of documents, n_chars after the change of the texts."""
    return docs.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules reject go."""
    return adaptive_quality.filter_documents(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks of lines that stand in an earlier document are cut out; documents of which nothing is left go."""
    return _counted(line_chunks.dedup_lines(docs.select(*COLUMNS))).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5 words, 0.8) stays."""
    return tensor_minhash.keep_one(docs.select(*COLUMNS), k=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blanked in the texts."""
    return _counted(markov_secrets.redact(docs.select(*COLUMNS)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return mixture_packing.pack(docs)


STAGES = [("quality_rules", quality), ("line_dedup", line_dedup), ("minhash_near_dedup", near_dedup), ("secret_scan", secrets), ("packing", packing)]

#: The packing stage's tokens can't be had in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
