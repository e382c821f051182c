"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Words and word pairs are hashed into buckets.  Two bucket models are fitted: of the
target, a bounded sample of documents labelled good, and of all raw text.  A document's
log weight is the sum of the log ratios of its buckets.  Adding Gumbel noise to the log
weights and keeping the k largest draws k documents without replacement in proportion to
their weights.

Corpus counts cover every document; tasks add up whole partitions into bucket counts
before anything is shuffled.  Selection ranks all keys in range partitions.

Defined results: NULL or wordless text has log weight 0; noise depends on doc_id and text
only, so reruns agree and equal rows share a key; ties in the key go by doc_id, NULL
last, then text hash; without good labels the models are equal and weights 0; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dqgate.llm.common import ranked, written
from dqgate.llm.textarrays import chunks, grams, word_hashes


@dataclass(frozen=True)
class Resampling:
    """``max_target`` bounds the labelled documents of the target model.

    ``keep_percent`` of the documents are drawn; None takes the share of labelled
    documents whose quality is 1.  With many more buckets the models would know the
    sample's own word pairs and rank other good text lower.
    """

    buckets: int = 1 << 14
    max_target: int = 20_000
    keep_percent: float | None = None
    smoothing: float = 1.0
    noise: float = 1.0
    seed: int = 7


def features(texts: pa.Array, buckets: int) -> Iterator[np.ndarray]:
    """The buckets of all words and word pairs of each text, in order."""
    mask = np.uint64(buckets - 1)
    for _, data, offsets in chunks(texts):
        words, bounds = word_hashes(data, offsets)
        for i in range(len(offsets) - 1):
            own = words[bounds[i] : bounds[i + 1]]
            yield (np.concatenate([grams(own, 1), grams(own, 2)]) & mask).astype(np.int64)


def target_ids(labels: DataFrame, r: Resampling) -> DataFrame:
    """``doc_id`` of at most ``max_target`` documents labelled good and not toxic, by hash order."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id", F.lit(r.seed)), "doc_id").limit(r.max_target)


def fitted(docs: DataFrame, labels: DataFrame, r: Resampling = Resampling()) -> np.ndarray:
    """Log ratio of target to raw probability for each bucket."""
    # Bounded by max_target ids, so a broadcast; all texts stay where they are.
    chosen = F.broadcast(target_ids(labels, r).withColumn("_target", F.lit(True)))
    flagged = docs.select("doc_id", "text").join(chosen, "doc_id", "left").select(
        F.coalesce("_target", F.lit(False)).alias("target"), "text"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, r.buckets), dtype=np.int64)
        for batch in batches:
            wanted = batch.column("target").to_numpy(zero_copy_only=False)
            for is_target, found in zip(wanted, features(batch.column("text"), r.buckets)):
                counts = np.bincount(found, minlength=0)
                totals[0, : len(counts)] += counts
                if is_target:
                    totals[1, : len(counts)] += counts
        used = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(totals[0, used]), pa.array(totals[1, used])], names=["bucket", "raw", "target"]
        )

    summed = (
        flagged.mapInArrow(count, "bucket bigint, raw bigint, target bigint")
        .groupBy("bucket")
        .agg(F.sum("raw"), F.sum("target"))
        .collect()  # one row per bucket, a parameter
    )
    totals = np.zeros((2, r.buckets))
    for bucket, raw, target in summed:
        totals[:, bucket] = raw, target
    if not totals[1].any():
        return np.zeros(r.buckets)
    # Both models carry the same prior, the raw distribution, so unseen buckets weigh nothing.
    raw = (totals[0] + r.smoothing) / (totals[0].sum() + r.smoothing * r.buckets)
    strength = r.smoothing * r.buckets
    target = (totals[1] + strength * raw) / (totals[1].sum() + strength)
    return np.log(target) - np.log(raw)


def log_weights(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``doc_id, text_hash, n_features, log_weight`` for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    buckets = len(ratios)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, weights = [], []
            for found in features(batch.column("text"), buckets):
                numbers.append(len(found))
                weights.append(float(shared.value[found].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(numbers, pa.int64()), pa.array(weights, pa.float64())],
                names=["doc_id", "text_hash", "n_features", "log_weight"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(score, "doc_id bigint, text_hash bigint, n_features bigint, log_weight double")


def resampled(docs: DataFrame, labels: DataFrame, r: Resampling = Resampling()) -> DataFrame:
    """``doc_id, n_features, log_weight, gumbel_key, position, kept`` for each row of ``docs``.

    ``position`` is the place in the order of keys, from 0; the first k are kept.
    """
    scored = log_weights(docs, fitted(docs, labels, r))
    # A number strictly between 0 and 1 from the row itself.
    bits = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(r.seed)), F.lit(1 << 52))
    uniform = (bits.cast("double") + 0.5) / float(1 << 52)
    keyed = scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)) * r.noise)
    order = keyed.withColumn("_down", -F.col("gumbel_key")).withColumn("_last", F.col("doc_id").isNull())
    placed = ranked(order, ["_down", "_last", "doc_id", "text_hash"], "position")
    k = keep_number(docs, labels, r)
    return placed.select(
        "doc_id", "n_features", "log_weight", "gumbel_key", "position", (F.col("position") < k).alias("kept")
    )


def keep_number(docs: DataFrame, labels: DataFrame, r: Resampling = Resampling()) -> int:
    """How many documents are drawn."""
    number = docs.count()
    if r.keep_percent is not None:
        return int(number * r.keep_percent / 100)
    known, good = labels.where("quality is not null").agg(F.count("*"), F.sum("quality")).first()
    return number if not known else -(-number * int(good) // known)


__all__ = ["Resampling", "features", "fitted", "log_weights", "resampled", "written"]
