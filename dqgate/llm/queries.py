"""The registered queries of the text operators: each over its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqgate.llm import (
    bpe,
    chat,
    importance,
    lexical,
    licenses,
    line_dedup,
    line_rules,
    mixing,
    near_dedup,
    neighbours,
    sharding,
    spelling,
    url_filter,
)
from dqgate.llm.common import ship_package, table
from dqgate.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabulary file of ``op8``; a file name of the installed public tokenizers.
VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> bytes:
    import public_tokenizers

    return bpe.read_vocabulary(public_tokenizers.path(VOCABULARY))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.words_taken(table(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op3_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.clean_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lost_chars", "base_failed", "kept",
    )


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary())
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), damage=31)


#: A conversation whose texts are made of control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], given.schema)
    pieces = chat.format_conversations(chat.text_messages(given.unionByName(more)))
    return chat.read_back(pieces).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )


def _shipping(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


_ALL: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_near_dedup": op2_near_dedup,
    "op3_importance": op3_importance,
    "op4_line_rules": op4_line_rules,
    "op5_neighbours": op5_neighbours,
    "op6_url_filter": op6_url_filter,
    "op7_licenses": op7_licenses,
    "op8_bpe": op8_bpe,
    "op9_line_dedup": op9_line_dedup,
    "op10_sharding": op10_sharding,
    "op11_lexical_search": op11_lexical_search,
    "op12_spelling": op12_spelling,
    "op13_chat": op13_chat,
}
QUERIES: dict[str, Query] = {name: _shipping(query) for name, query in _ALL.items()}

__all__ = ["ORACLES", "QUERIES"]
