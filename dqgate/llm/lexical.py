"""Ranked lexical search without random access (NRA).

The texts are read once into postings of the terms asked for.  Tasks then take blocks of
documents: every term's list is sorted by impact and read from the top, all lists of an item
to the same depth.  Of each document met the sum so far is a lower bound of its score, and
that plus the last impact read of each list it was not met in an upper bound.  An item is
done with a block when no document that was not met can reach the best ones and every document that still
can has one bound left: its score.  So membership, ties and scores are exact, and a list
is read only as deep as needed.  What the blocks of a task have found so far is the bar for
the next one; the results of the tasks are merged.

No row is dealt by term or document, so a word in every text makes no task larger than
others.  Terms of items are handled by hash (64 bits); items go in blocks of about ``TERMS``
terms, and the texts are read once for each such block.

Defined results: NULL text has no terms, and such documents and items have no ranks; of equal
scores the smaller doc_id comes first, a NULL one last; every row is a document of its own,
also with an id or text like another's, and every item row has ranks of its own; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from dqgate.llm.common import written
from dqgate.llm.textarrays import CHUNK_BYTES, chunks, mixed

#: Distinct terms of the items that are searched together: what a task holds of the query set.
TERMS = 200_000
#: Documents, and postings, of a block.
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 1 << 21
#: Depth of the first round of reading; each round reads this many times as deep as the one before.
FIRST_DEPTH, DEEPER = 32, 4
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NO_ID = np.iinfo(np.int64).max


# -- terms --------------------------------------------------------------------

_IS_TERM = np.zeros(256, dtype=bool)
_IS_TERM[48:58] = _IS_TERM[65:91] = _IS_TERM[97:123] = _IS_TERM[128:] = True


def _segments(data: np.ndarray, offsets: np.ndarray, first: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The given chunk, or where it is one long text, parts of that, cut between terms."""
    if len(offsets) > 2 or len(data) <= 2 * CHUNK_BYTES:
        yield first, data, offsets
        return
    at = 0
    while at < len(data):
        end = min(at + CHUNK_BYTES, len(data))
        while end < len(data):  # to the next byte between terms
            gap = np.flatnonzero(~_IS_TERM[data[end : end + 65536]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + 65536, len(data))
        yield first, data[at:end], np.array([0, end - at])
        at = end


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms (A-Z as a-z) in order, and each text's range among them."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = _IS_TERM[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins = inside & (edge[:-1] | np.concatenate(([True], ~inside[:-1])))
    ends = inside & (edge[1:] | np.concatenate((~inside[1:], [True])))
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    lowered = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    # Eight bytes at a time, for as many terms as are that long.
    padded = np.concatenate([lowered, np.zeros(8, dtype=np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    hashes = mixed((e - s).astype(np.uint64), 5)
    todo = np.arange(len(s))
    at = 0
    while len(todo):
        left = e[todo] - s[todo] - at
        word = np.ascontiguousarray(eights[s[todo] + at]).view(np.uint64).ravel()
        short = np.uint64(8) * np.uint64(8) - np.minimum(left, 8).astype(np.uint64) * np.uint64(8)
        word = word << short  # little-endian: drops the bytes after the term
        hashes[todo] = mixed(hashes[todo] * _STEP + word, at + 1)
        at += 8
        todo = todo[left > 8]
    return hashes, np.searchsorted(s, offsets)


def _counted(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, bounds) over the texts; a long text comes in several parts."""
    for first, data, offsets in chunks(texts):
        for row, part, own in _segments(data, offsets, first):
            yield row, *term_hashes(part, own)


def item_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, terms``: the distinct term hashes of each row, by a number of its own; written."""
    rows = written(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"))
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)] * batch.num_rows
            for row, hashes, bounds in _counted(batch.column("text")):
                for i in range(len(bounds) - 1):
                    found[row + i] = np.union1d(found[row + i], hashes[bounds[i] : bounds[i + 1]])
            own = pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.select(["item", "item_id"]).columns, own], names=["item", "item_id", "terms"])

    return written(rows.mapInArrow(run, f"item bigint, item_id {kind}, terms array<bigint>"))


def item_blocks(terms: DataFrame, most: int = TERMS) -> Iterator[dict[int, np.ndarray]]:
    """Items with their terms, so many at a time that their terms are about ``most``."""
    block: dict[int, np.ndarray] = {}
    held = 0
    for row in terms.where(F.size("terms") > 0).select("item", "terms").toLocalIterator():
        block[row["item"]] = np.array(row["terms"], dtype=np.int64).view(np.uint64)
        held += len(row["terms"])
        if held >= most:
            yield block
            block, held = {}, 0
    if block:
        yield block


# -- postings -----------------------------------------------------------------


def postings(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, tfs``: number of terms of each document, and those of the sorted ``wanted`` it holds."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            number = np.zeros(batch.num_rows, dtype=np.int64)
            keys, counts = [], []
            for row, hashes, bounds in _counted(batch.column("text")):
                number[row : row + len(bounds) - 1] += np.diff(bounds)
                at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                hit = np.flatnonzero(wanted[at] == hashes)
                owner = np.searchsorted(bounds, hit, side="right") - 1 + row
                key, count = np.unique(owner * len(wanted) + at[hit], return_counts=True)
                keys.append(key)
                counts.append(count)
            key, back = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_inverse=True)
            tf = np.bincount(back, np.concatenate(counts) if counts else np.zeros(0), minlength=len(key)).astype(np.int64)
            starts = np.searchsorted(key // len(wanted), np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(number),
                    pa.ListArray.from_arrays(pa.array(starts), pa.array((key % len(wanted)).astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(starts), pa.array(tf)),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")


@dataclass(frozen=True)
class Statistics:
    """``docs`` with a term, ``total`` terms of all, and the weight of each wanted term."""

    docs: int
    total: int
    weights: np.ndarray


def statistics(rows: DataFrame, number: int) -> Statistics:
    """Counts over all postings; the driver gets one row per wanted term."""
    docs, total = rows.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    df = np.zeros(number, dtype=np.int64)
    for term, count in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[term] = count
    weights = [math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in df]
    return Statistics(docs, total or 0, np.array(weights, dtype=np.int64))


def impacts(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, known: Statistics) -> np.ndarray:
    """The scores of single terms, in whole numbers."""
    if len(n) and 50 * int(n.max()) * known.docs >= 1 << 62:
        share = np.array([50 * int(x) * known.docs // known.total for x in n], dtype=np.int64)
    else:
        share = 50 * n * known.docs // max(known.total, 1)
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * (50 + share)))


# -- search -------------------------------------------------------------------


class Lists:
    """The postings of a block of documents: for each term its documents, greatest impact first."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, known: Statistics):
        self.ids = ids
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        value = impacts(tfs, n[owner], known.weights[terms], known)
        order = np.lexsort((-value, terms))
        self.docs, self.impacts = owner[order], value[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(known.weights) + 1))

    def best(self, terms: np.ndarray, k: int, bar: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the block, with scores, that can be among the ``k`` best.

        ``bar`` has the scores of the best documents found before; a score below its k-th is of no use.
        """
        at, last = self.starts[terms], self.starts[terms + 1]
        used = at < last
        at, last = at[used], last[used]
        size = len(self.ids)
        nothing = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        floor = int(bar[k - 1]) if len(bar) >= k else 0
        first = self.impacts[at]
        if not len(at) or first.sum() < max(floor, 1):
            return nothing
        lower = np.zeros(size)
        seen_docs, seen_lists = [], []
        met_all = np.ones(size, dtype=bool)
        closed = False
        begin, depth = at, FIRST_DEPTH
        while True:
            to = np.minimum(begin + depth, last)
            lengths = to - at
            which = np.repeat(np.arange(len(at)), lengths)
            entries = np.arange(len(which)) - np.repeat(np.cumsum(lengths) - lengths - at, lengths)
            met, value = self.docs[entries], self.impacts[entries]
            if closed:  # nobody new can come in: read for those still open only
                mine = met_all[met]
                met, value, which = met[mine], value[mine], which[mine]
            lower += np.bincount(met, value, minlength=size)  # whole numbers, exact in doubles
            seen_docs.append(met)
            seen_lists.append(which)
            # The last impact read bounds what is still unread of a list.
            ceiling = np.where(to < last, self.impacts[to - 1], 0)
            rest = int(ceiling.sum())
            upper = lower + rest
            if rest:
                for docs, lists in zip(seen_docs, seen_lists):
                    upper -= np.bincount(docs, ceiling[lists], minlength=size)
            scores = np.concatenate([lower, bar])
            least = max(int(np.partition(scores, len(scores) - k)[len(scores) - k]), 1) if len(scores) >= k else 1
            closed = closed or rest < least
            met_all &= (upper >= least) & ((lower > 0) | (not closed))
            if closed and (upper[met_all] == lower[met_all]).all():
                found = np.flatnonzero(met_all)
                return found, lower[found].astype(np.int64)
            at, depth = to, depth * DEEPER


def _blocks(batches: Iterator[pa.RecordBatch], known: Statistics) -> Iterator[Lists]:
    """Consecutive documents with terms, ``BLOCK_DOCS`` at a time, fewer if they hold many."""
    held: list[tuple[np.ndarray, ...]] = []

    def made() -> Lists:
        ids, n, sizes, terms, tfs = (np.concatenate(c) for c in zip(*held))
        return Lists(ids, n, sizes, terms, tfs, known)

    docs = entries = 0
    for batch in batches:
        for first in range(0, batch.num_rows, 1024):
            part = batch.slice(first, 1024)
            lists, counts = part.column("terms"), part.column("tfs")
            ids = part.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            sizes = np.diff(lists.offsets.to_numpy())
            held.append((ids, part.column("n").to_numpy(), sizes, lists.flatten().to_numpy(), counts.flatten().to_numpy()))
            docs, entries = docs + len(ids), entries + int(sizes.sum())
            if docs >= BLOCK_DOCS or entries >= BLOCK_POSTINGS:
                yield made()
                held, docs, entries = [], 0, 0
    if held:
        yield made()


def search(rows: DataFrame, asked: dict[int, np.ndarray], known: Statistics, k: int) -> DataFrame:
    """``item, doc_id, score``: the best of each task for each of ``asked`` (item: numbers of its terms)."""
    shared = rows.sparkSession.sparkContext.broadcast((asked, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, known = shared.value
        best = {item: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for item in asked}
        for lists in _blocks(batches, known):
            for item, terms in asked.items():
                ids, scores = best[item]
                found, own = lists.best(terms, k, scores)
                if len(found):
                    ids, scores = np.concatenate([ids, lists.ids[found]]), np.concatenate([scores, own])
                    order = np.lexsort((ids, -scores))[:k]
                    best[item] = ids[order], scores[order]
        for item, (ids, scores) in best.items():
            if len(ids):
                named = pa.array(ids, mask=ids == _NO_ID)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), item)), named, pa.array(scores)], names=["item", "doc_id", "score"]
                )

    return rows.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 50, most_terms: int = TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents with a score for each row of ``items``."""
    terms = item_terms(items)
    found = None
    for block in item_blocks(terms, most_terms):
        wanted = np.unique(np.concatenate(list(block.values())))
        rows = written(postings(docs, wanted))
        asked = {item: np.searchsorted(wanted, own) for item, own in block.items()}
        best = search(rows, asked, statistics(rows, len(wanted)), k)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = _nothing(docs.sparkSession)
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .join(terms.select("item", "item_id"), "item")
        .select("item_id", "rank", "doc_id", "score")
    )


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "item bigint, doc_id bigint, score bigint")
