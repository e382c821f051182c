"""From raw documents to token ids: five stages, each over all that the one before it kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the
columns of ``documents``.  Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqgate.llm import bpe, line_dedup, line_rules, mixing, near_dedup
from dqgate.llm.common import ship_package, table, written
from dqgate.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bad lines and documents that lose too much text go."""
    return line_rules.cleaned_documents(docs)


def line_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go."""
    return line_dedup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship_package(spark)
    return near_dedup.deduplicated(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the mix takes."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256`` of each row."""
    ship_package(spark)
    return bpe.encode_decode(docs, vocabulary()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("text", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_repeats),
    ("near_dedup", near_duplicates),
    ("mixing", source_mix),
    ("bpe", token_ids),
]

#: The hash draws of the mix and the merges of the tokenizer are beyond SQL; see the tests.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        rows = written(stage(spark, rows, sf_dir))
    return STAGES[-1][1](spark, rows, sf_dir)
