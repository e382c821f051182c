"""Approximate nearest neighbours by a forest of hash prefixes.

Every tree gives a vector a long string of bits, one per random hyperplane, and is the
sorted array of these strings.  A query descends in every tree to its longest prefix
match, then all trees ascend together, one bit at a time, until the matches are enough
candidates, the last bit tree by tree; so the prefix length varies from query to query.
Candidates are scored in full.  For inner products, vectors get one more coordinate that
makes them equally long (zero for queries), so that near in angle means large in product.

That coordinate says nothing about direction, and would drown the others of short vectors
beside a long one.  So the index is in order of norm, and is cut into shards of a fixed
size and these into bands of like norm, each with its own forest and maximum; in a small band
the ascent ends at the root by itself.  Queries are sent to all shards in blocks: a stated set of
queries against all rows.  Trees thus have about the same depth, and recall, whatever the size
of the table and its norms.  Equal vectors are one entry with their smallest ids, so many
copies neither fill a shard nor multiply work.

Recall against brute force is measured on vectors without any structure, of equal and of
unequal norms; see the tests and the README.

Defined results: vectors that are NULL, empty or zero, or hold NULL or non-finite
components, take no part, nor do those whose length is not the most frequent one, nor
rows without id; of equal scores the smaller id comes first; rows with one id are
neighbours under that id like any others, but never of a query of that id; fewer rows
than asked for give fewer neighbours; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from dqgate.llm.common import ranked, written

#: Queries whose candidates are scored at once.
TOGETHER = 64


@dataclass(frozen=True)
class Forest:
    """``candidates`` counts matches over all trees, per band; ``band_ratio`` is its longest norm by its shortest."""

    trees: int = 96
    bits: int = 32
    candidates: int = 8192
    shard_rows: int = 8192
    band_ratio: float = 1.15
    query_block: int = 16384
    neighbours: int = 20
    every: int = 20
    seed: int = 11


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` (array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite_and_not_zero(F.col("v"))
    )
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length["n"] if length else 0))


def finite_and_not_zero(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return fine & F.exists(v, lambda x: x != 0)


def entries(rows: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """``entry, v, ids``: distinct vectors with their smallest ids (one more than asked for).

    ``entry`` is the position by norm, from 0.
    """
    by_id = Window.partitionBy("v").orderBy("vec_id")
    few = rows.dropDuplicates(["v", "vec_id"]).withColumn("_n", F.row_number().over(by_id))
    few = few.where(F.col("_n") <= forest.neighbours + 1)
    grouped = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    squares = F.aggregate(F.col("v"), F.lit(0.0), lambda a, x: a + x * x)
    return ranked(grouped.withColumn("_norm", squares), ["_norm", "v"], "entry").select("entry", "v", "ids")


def _depth(number: int, forest: Forest) -> int:
    """Bits that matter among so many entries; longer prefixes hold none but equal ones."""
    return min(forest.bits, int(np.ceil(np.log2(number + 1))) + 8)


def _planes(dimension: int, forest: Forest) -> np.ndarray:
    rng = np.random.default_rng(forest.seed)
    return rng.standard_normal((forest.trees, forest.bits, dimension + 1), dtype=np.float32)


def _labels(x: np.ndarray, planes: np.ndarray, depth: int) -> np.ndarray:
    """One number of ``depth`` bits per tree (row) and vector (column); the first hyperplane is the top bit."""
    x = x.astype(np.float32)
    out = np.zeros((len(planes), len(x)), dtype=np.uint64)
    for t, normals in enumerate(planes):
        signs = (normals[:depth] @ x.T) > 0
        for bit in signs:
            out[t] = (out[t] << np.uint64(1)) | bit
    return out


class Trees:
    """The forest of one band: for each tree the sorted bit strings of the entries."""

    def __init__(self, x: np.ndarray, most: float, planes: np.ndarray, depth: int) -> None:
        """``most`` is the greatest squared norm."""
        extra = np.sqrt(np.maximum(most - (x * x).sum(axis=1), 0))
        own = _labels(np.column_stack([x, extra]), planes, depth)
        self.order = np.argsort(own, axis=1, kind="stable")
        self.arrays = np.take_along_axis(own, self.order, axis=1)
        self.depth = depth

    def ranges(self, asked: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query, the places of the entries that share the first ``length`` bits."""
        low, high = np.empty(asked.shape, dtype=np.int64), np.empty(asked.shape, dtype=np.int64)
        rest = (self.depth - length).astype(np.uint64)
        for t, array in enumerate(self.arrays):
            prefix = asked[t] >> rest
            low[t] = np.searchsorted(array, prefix << rest, side="left")
            high[t] = np.searchsorted(array, (prefix + np.uint64(1)) << rest, side="left")
        return low, high

    def matches(self, asked: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """The places where the ascent ends: as long a prefix, the same in all trees, as gives ``enough`` matches.

        Shorter prefixes match no fewer entries, so the ascent's end is found by halving its
        way.  Of the last bit only as many trees go up as needed; the others stay one bit deeper.
        With too few entries the ascent ends at the root.
        """
        number = asked.shape[1]
        fine, over = np.zeros(number, dtype=np.int64), np.full(number, self.depth + 1, dtype=np.int64)
        while (unsure := over - fine > 1).any():
            middle = (fine + over) // 2
            low, high = self.ranges(asked, middle)
            met = (high - low).sum(axis=0) >= enough
            fine, over = np.where(unsure & met, middle, fine), np.where(unsure & ~met, middle, over)
        low, high = self.ranges(asked, fine)
        deep_low, deep_high = self.ranges(asked, np.minimum(fine + 1, self.depth))
        matched, was = high - low, deep_high - deep_low
        gained = was.sum(axis=0) + np.cumsum(matched - was, axis=0)
        spare = np.vstack([was.sum(axis=0)[None], gained[:-1]]) >= enough
        spare &= fine < self.depth
        return np.where(spare, deep_low, low), np.where(spare, deep_high, high)


def search_shard(x: np.ndarray, q: np.ndarray, most: float, forest: Forest) -> Iterator[np.ndarray]:
    """For each query the entries of one band that its descent and ascent give."""
    planes, depth = _planes(x.shape[1], forest), _depth(len(x), forest)
    asked = _labels(np.column_stack([q, np.zeros(len(q))]), planes, depth)
    for part in found_in(Trees(x, most, planes, depth), asked, forest):
        yield from (np.flatnonzero(row) for row in part)


def found_in(trees: Trees, asked: np.ndarray, forest: Forest) -> Iterator[np.ndarray]:
    """For ``TOGETHER`` queries at a time, which entries the forest gives (rows: queries)."""
    low, high = trees.matches(asked, forest.candidates)
    for first in range(0, asked.shape[1], TOGETHER):
        part = np.zeros((min(TOGETHER, asked.shape[1] - first), trees.order.shape[1]), dtype=bool)
        for i, row in enumerate(part, first):
            row[np.concatenate([places[a:b] for places, a, b in zip(trees.order, low[:, i], high[:, i])])] = True
        yield part


def bands(norms: np.ndarray, forest: Forest) -> list[np.ndarray]:
    """Positions of like norm: in a band the longest is at most ``band_ratio`` times the shortest."""
    order = np.argsort(-norms, kind="stable")
    falling, out, start = -norms[order], [], 0
    while start < len(order):
        end = int(np.searchsorted(falling, falling[start] / forest.band_ratio, side="right"))
        out.append(order[start : max(end, start + 1)])
        start = max(end, start + 1)
    return out


def search_bands(x: np.ndarray, q: np.ndarray, forest: Forest) -> Iterator[np.ndarray]:
    """For ``TOGETHER`` queries at a time, the entries of one shard that the forests of its bands give (rows: queries)."""
    peak = np.abs(x).max(axis=1)
    flat = x / peak[:, None]
    lengths = np.sqrt((flat * flat).sum(axis=1))
    # By logarithm, as the product of the two could be out of range.
    logs = np.log(peak) + np.log(lengths)
    norms = np.exp(logs - logs.max())
    planes, depth = _planes(x.shape[1], forest), _depth(len(x), forest)
    directions = q / np.abs(q).max(axis=1)[:, None]
    asked = _labels(np.column_stack([directions, np.zeros(len(q))]), planes, depth)
    searched = []
    for band in bands(norms, forest):
        even = flat[band] * (norms[band] / norms[band[0]] / lengths[band])[:, None]
        searched.append((band, found_in(Trees(even, 1.0, planes, depth), asked, forest)))
    for first in range(0, len(q), TOGETHER):
        part = np.zeros((min(TOGETHER, len(q) - first), len(x)), dtype=bool)
        for band, found in searched:
            part[:, band] = next(found)
        yield part


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added up in the order of the components."""
    total = np.zeros(len(x))
    with np.errstate(over="ignore", invalid="ignore"):
        for d in range(x.shape[1]):
            total += x[:, d] * q[:, d]
    return total


def best_found(x: np.ndarray, q: np.ndarray, found: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, entry, score) of the ``found`` entries (rows: queries) that can be among the ``keep`` best.

    A matrix product, good to some rounding, leaves out entries that are worse by more than
    that; what is left is scored exactly.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        rough = q @ x.T
        longest = np.sqrt((x * x).sum(axis=1).max(initial=0.0))
        slack = 8 * x.shape[1] * np.finfo(float).eps * longest * np.sqrt((q * q).sum(axis=1))
    certain = np.isfinite(rough).all(axis=1) & np.isfinite(slack)
    rough[~certain] = 0.0  # out of range: all that is found is scored exactly
    rough[~found] = -np.inf
    if x.shape[0] > keep:
        least = np.partition(rough, len(x) - keep, axis=1)[:, len(x) - keep]
        near = rough >= (least - np.where(certain, 2 * slack, 0.0))[:, None]
    else:
        near = found.copy()
    query, entry = np.nonzero(near & found)
    return query, entry, products(x[entry], q[query])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    whole = column.combine_chunks()
    flat = whole.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(whole), -1) if len(whole) else np.zeros((0, 0))


def matches(index: DataFrame, queries: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """``query, entry, score``: for each query entry the best entries of each shard."""
    number = max(1, index.count())
    shards = -(-number // forest.shard_rows)
    asked = queries.count()
    blocks = max(1, -(-asked // forest.query_block))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    own = index.select(
        F.floor(F.col("entry") * shards / number).cast("int").alias("shard"),
        every_block.alias("block"), "entry", "v", F.element_at("ids", 1).alias("first_id"),
    )
    sent = queries.select(
        every_shard.alias("shard"), F.pmod(F.xxhash64("entry"), F.lit(blocks)).cast("int").alias("block"),
        F.col("entry").alias("query"), "v",
    )
    keep = forest.neighbours + 1

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_e, out_s = [], [], []
        if left.num_rows and right.num_rows:
            x, q = _matrix(left.column("v")), _matrix(right.column("v"))
            names, firsts = left.column("entry").to_numpy(), left.column("first_id").to_numpy()
            asked_by = right.column("query").to_numpy()
            for k, found in enumerate(search_bands(x, q, forest)):
                first = k * TOGETHER
                query, entry, scores = best_found(x, q[first : first + TOGETHER], found, keep)
                # Of equal scores, smaller ids first.
                order = np.lexsort((firsts[entry], -scores, query))
                query, entry, scores = query[order], entry[order], scores[order]
                place = np.arange(len(query)) - np.searchsorted(query, query)
                kept = place < keep
                out_q.append(asked_by[first + query[kept]])
                out_e.append(names[entry[kept]])
                out_s.append(scores[kept])
        made = [np.concatenate(a) if a else np.zeros(0) for a in (out_q, out_e, out_s)]
        return pa.table(
            [pa.array(made[0].astype(np.int64)), pa.array(made[1].astype(np.int64)), pa.array(made[2].astype(np.float64))],
            names=["query", "entry", "score"],
        )

    return own.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInArrow(
        search, "query bigint, entry bigint, score double"
    )


def nearest(vectors: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``."""
    rows = usable(vectors)
    index = written(entries(rows, forest))
    is_query = F.col("vec_id") % forest.every == 0
    askers = written(
        rows.where(is_query).select("vec_id", "v").join(index.select("entry", "v"), "v").select(
            F.col("vec_id").alias("query_id"), F.col("entry").alias("query")
        ).distinct()
    )
    asked = askers.select(F.col("query").alias("entry")).distinct()
    queries = written(index.join(asked, "entry", "left_semi").select("entry", "v"))
    best = matches(index, queries, forest)
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    named = best.join(index.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    named = named.withColumn("_n", F.row_number().over(by_score)).where(F.col("_n") <= forest.neighbours + 1)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        askers.join(named, "query")
        .where("query_id != vec_id")
        .withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= forest.neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
