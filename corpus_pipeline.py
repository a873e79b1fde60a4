"""Stages that turn raw documents into encoded training text.

Every stage takes what its predecessor kept and drops rows or, in the last, encodes them. A stage's result is
written as Parquet and read again, so a lost executor costs no earlier stage. All stages but the last return
the columns of the documents, whatever they are named. A NULL text counts as empty and a NULL id as an id of its
own; rows equal in id and text are judged alike, of which the deduplicating stages keep one. An empty table gives an
empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from powerflow.llm import byte_bpe, decontaminate, exact_dedup, near_dedup
from powerflow.llm.common import table
from powerflow.llm.queries import BYTE_VOCABULARY, QUALITY_THRESHOLD, quality_column
from powerflow.session import written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on their labels, does not reject. Empty texts have a score as well."""
    return docs.filter(quality_column(spark, docs, sf_dir) >= QUALITY_THRESHOLD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts that are equal but for blanks: the longest, then the smallest id. Empty texts are one group."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each class of near duplicates. A text without words is near to none but its equals."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in windows of the benchmark; those without words stay."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document left, one row each; an empty text has no tokens."""
    path = public_tokenizers.path(BYTE_VOCABULARY)
    coded = byte_bpe.round_trip(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return coded.select("doc_id", F.col("bpe.n_tokens"), F.col("bpe.ids_sha256"), F.col("bpe.decoded_sha256"))


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("encode", encode),
]

# The classifier's network and the tokenizer are no SQL; tests/llm compares the run with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
