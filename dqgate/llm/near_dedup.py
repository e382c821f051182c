"""Near-duplicates by min-max hashing, with every link confirmed on full shingle sets.

Under each hash function a document keeps both the least and the greatest value of its
shingles, so half the evaluations give as many values; a value agrees between two
documents with probability equal to their similarity.  Values are banded: documents
that agree in a whole band are candidates.  At similarity 0.75 a pair shares no band with
probability (1 - 0.75**5)**50, about one in a million.

Documents with the same set form one class and are handled as one from then on.
Candidate pairs first compare short sketches (a bound six standard errors below the
threshold), then their full sets.  Buckets are never paired out: each class meets the most
central members of its buckets, one after the other, and links join classes into
components.  Classes whose buckets still hold several components after that are compared
across components by an exact prefix filter: similar sets share one of their rarest shingles.
Classes that share one that few have are paired.  The others, that share only ones many have,
are grouped by these into families and compared within a family, in blocks of fixed size that
return links only.  Components come from alternating star contractions, a fixed number of
joins a round.

Texts, sketches and sets are wide, and most steps want few of them.  Before they are
shuffled, a table of hash bits of the wanted keys (a Bloom filter with one hash function,
of bounded size) leaves most others out where they are read; the join that follows is exact.
Tables and shuffle files go as soon as they have been read for the last time, so the disk holds
those of the widest step and not those of all.

Defined results: NULL or blank text has no shingles, and is its own component; a text of
fewer than ``SHINGLE`` words has one shingle; rows with one text are linked, also with
one doc_id; NULL doc_id counts as the largest; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from dqgate.llm.common import numbered, restored, spent, written_once as written
from dqgate.llm.textarrays import mixed, shingle_sets

SHINGLE = 5
#: Hash cells in which shingles are counted, to tell common ones from rare ones.
CELL_BITS = 18
#: Central members of a bucket that the others are compared with, one after the other.
CENTRES = 1
#: Classes of a family that a task compares with as many others.
BLOCK = 512
#: Open classes with one shingle up to which all of them are paired.
PAIRED = 32
#: Classes with one rare shingle from which on it counts as common.
COMMON = 8
#: Bits of a filter, 64 a row: with more keys than that it only lets more rows through.
FILTER_BITS = 1 << 24
CELLS = 1 << CELL_BITS


@dataclass(frozen=True)
class Banding:
    """``bands`` of ``rows`` values; the hash functions are half as many as the values."""

    bands: int = 50
    rows: int = 5
    percent: int = 75

    @property
    def functions(self) -> int:
        return -(-self.bands * self.rows // 2)

    @property
    def least_agreeing(self) -> int:
        """Sketch values that must agree: six standard errors below the expected number."""
        n, p = 2 * self.functions, self.percent / 100
        return max(1, int(n * p - 6 * (n * p * (1 - p)) ** 0.5 - n / 256))


def min_max(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Least values under all functions, then greatest values."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    most = np.zeros(len(factors), dtype=np.uint32)
    for first in range(0, len(short), 4096):
        values = short[None, first : first + 4096] * factors[:, None]
        np.minimum(least, values.min(axis=1), out=least)
        np.maximum(most, values.max(axis=1), out=most)
    return np.concatenate([least, most])


def signatures(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """``doc_id, text_hash, n_shingles, class, bands, sketch`` for each row of ``docs``.

    ``class`` identifies the shingle set (128 bits, NULL for an empty set).
    """
    factors = (mixed(np.arange(1, banding.functions + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | 1
    weights = mixed(np.arange(banding.rows, dtype=np.uint64), 77) | np.uint64(1)
    salts = mixed(np.arange(banding.bands, dtype=np.uint64), 99)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, classes, bands, sketches = [], [], [], []
            for found in shingle_sets(batch.column("text")):
                numbers.append(len(found))
                if not len(found):
                    classes.append(None)
                    bands.append(None)
                    sketches.append(None)
                    continue
                ids = np.array([mixed(found, 1).sum(), mixed(found, 2).sum()], dtype=np.uint64)
                classes.append(ids.tobytes())
                values = min_max(found, factors)
                sketches.append((values * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).tobytes())
                banded = values[: banding.bands * banding.rows].reshape(banding.bands, banding.rows)
                keys = mixed((banded.astype(np.uint64) * weights).sum(axis=1) + salts)
                bands.append(keys.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(numbers, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "class", "bands", "sketch"],
            )

    return _hashed(docs).mapInArrow(
        run,
        "doc_id bigint, text_hash bigint, n_shingles bigint, class binary, bands array<bigint>, sketch binary",
    )


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")


def _cell_of(key: tuple[str, ...]) -> tuple[Column, Column]:
    """The row of a filter that ``key`` falls into, and the bit in it."""
    cell = F.pmod(F.xxhash64(*key), F.lit(FILTER_BITS))
    return F.floor(cell / 64), F.pmod(cell, F.lit(64)).cast("int")


def filter_of(wanted: DataFrame, *key: str) -> DataFrame:
    """``word, bits``: the hash cells of the keys in ``wanted``, in ``FILTER_BITS / 64`` rows at most."""
    word, bit = _cell_of(key)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return written(wanted.select(word.alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")))


def probable(rows: DataFrame, found: DataFrame, *key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in the filter ``found``; the rest all stay.

    Nothing is shuffled: a filter is small by construction, so it is sent to the rows.
    """
    word, bit = _cell_of(key)
    is_set = F.call_function("shiftright", F.col("bits"), bit).bitwiseAND(F.lit(1).cast("bigint")) == 1
    return rows.join(F.broadcast(found), (word == F.col("word")) & is_set, "left_semi")


def buckets(classes: DataFrame) -> DataFrame:
    """``key, class, n, size``: members of the buckets that hold several (``size``) classes.

    Buckets are counted before their members are looked up.  The result is written.
    """
    members = classes.select("class", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    by_key = Window.partitionBy("key").orderBy("class")
    several = members.withColumn("_b", F.lag("class").over(by_key)).withColumn("_a", F.lead("class").over(by_key))
    several = written(several.where("_a is not null or _b is not null").select("key", "class", "n"))
    counted = written(several.join(several.groupBy("key").agg(F.count("*").alias("size")), "key"))
    spent(several)
    return counted


def with_centres(members: DataFrame) -> DataFrame:
    """``key, class, n, centres``: the ``CENTRES`` most central members of each bucket, in order.

    A class is the more central the more members its buckets have: what copies were made
    from comes before the copies, which are less like one another.
    """
    weight = members.groupBy("class").agg(F.sum("size").alias("weight"))
    placed = members.join(weight, "class")
    bucket = Window.partitionBy("key").orderBy(F.desc("weight"), "class")
    placed = placed.withColumn("_at", F.row_number().over(bucket))
    whole = Window.partitionBy("key")
    one = F.struct("class", "n")
    centres = F.array(*[F.max(F.when(F.col("_at") == i, one)).over(whole) for i in range(1, CENTRES + 1)])
    return placed.select("key", "class", "n", centres.alias("centres"))


def _sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def central_pairs(members: DataFrame, which: int, percent: int, component: DataFrame | None = None) -> DataFrame:
    """``a, b``: each class with the centre (number ``which``) that it meets in most buckets.

    One pair for each class at most; none within one ``component``.
    """
    near = members.select("class", "n", F.get("centres", F.lit(which)).alias("_c")).where(
        (F.col("_c.class") != F.col("class")) & _sizes_allow(F.col("n"), F.col("_c.n"), percent)
    )
    counted = near.groupBy("class", F.col("_c.class").alias("other")).agg(F.count("*").alias("_n"))
    if component is not None:
        mine = component.select("class", F.col("component").alias("_mine"))
        its = component.select(F.col("class").alias("other"), F.col("component").alias("_its"))
        counted = counted.join(mine, "class", "left").join(its, "other", "left").where(
            F.coalesce("_mine", "class") != F.coalesce("_its", "other")
        )
    best = counted.groupBy("class").agg(F.max(F.struct("_n", "other")).alias("_best"))
    pairs = best.select(F.col("class").alias("a"), F.col("_best.other").alias("b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def open_members(members: DataFrame, component: DataFrame) -> DataFrame:
    """``class, n, component`` of the members of buckets that are not all connected."""
    known = members.join(component, "class", "left").select(
        "key", "class", "n", F.coalesce("component", "class").alias("component")
    )
    several = (
        known.groupBy("key")
        .agg(F.min("component").alias("_a"), F.max("component").alias("_b"))
        .where("_a != _b")
        .select("key")
    )
    return known.join(several, "key", "left_semi").select("class", "n", "component").distinct()


def shingle_weights(sets: DataFrame) -> np.ndarray:
    """How common shingles are among ``sets``, by hash cell; ``CELLS`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            for found in batch.column("shingles"):
                totals += np.bincount(_cells(_shingles(found)), minlength=CELLS)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], names=["cell", "n"])

    cells = sets.select("shingles").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n"))
    found = cells.toDF("cell", "n").toArrow()  # CELLS rows at most, in two columns
    weights = np.zeros(CELLS, dtype=np.int64)
    weights[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return weights


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _shingles(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=np.uint64)


def rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """``class, shingle``: of each set its rarest shingles, as many as a similar set cannot all lack.

    Sets of n shingles that are similar enough share ``percent`` of n at least, so they
    have one of the first n - that + 1 in common, in any order that is the same for all.
    With the rarest first, what many texts have in common comes last and joins nothing.
    Hash cells are too coarse to tell all that is common, so what is found to be common among
    the first shingles comes after all others.
    """
    weights = sets.sparkSession.sparkContext.broadcast(shingle_weights(sets))
    first = _first_shingles(sets, percent, weights, None)
    found = first.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") > COMMON)
    found = found.orderBy(F.desc("n"), "shingle").limit(CELLS).select("shingle").toArrow()  # CELLS numbers at most
    last = np.sort(found.column("shingle").to_numpy().view(np.uint64))
    return _first_shingles(sets, percent, weights, sets.sparkSession.sparkContext.broadcast(last))


def _first_shingles(sets: DataFrame, percent: int, weights: Broadcast, last: Broadcast | None) -> DataFrame:
    """``class, shingle`` of the first shingles by weight; those in ``last`` (sorted) come after all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = last.value if last else np.zeros(0, np.uint64)
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                rows = []
                for found in part.column("shingles"):
                    own = _shingles(found)
                    late = np.searchsorted(common, own, "right") > np.searchsorted(common, own, "left")
                    order = np.lexsort((own, weights.value[_cells(own)], late))
                    rows.append(own[order[: len(own) - -(-len(own) * percent // 100) + 1]])
                owner = np.repeat(np.arange(part.num_rows), [len(r) for r in rows])
                yield pa.RecordBatch.from_arrays(
                    [part.column("class").take(pa.array(owner)), pa.array(np.concatenate(rows).view(np.int64))],
                    names=["class", "shingle"],
                )

    return sets.select("class", "shingles").mapInArrow(run, "class binary, shingle bigint")


def shared_shingles(still_open: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """``shingle, class, n, component, crowded`` of the rare shingles of open classes that several
    components have, and the tables that this is read from.

    ``sets`` may hold other classes too.  Similar classes of different components have at least
    one of these in common.  More than ``PAIRED`` classes have a ``crowded`` one.
    """
    rare = written(rare_shingles(sets, percent).join(still_open, "class"))
    counted = rare.groupBy("shingle").agg(
        F.count("*").alias("_n"), F.min("component").alias("_a"), F.max("component").alias("_z")
    )
    several = written(counted.where("_a != _z").select("shingle", (F.col("_n") > PAIRED).alias("crowded")))
    return rare.join(several, "shingle"), [rare, several]


def shared_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """``a, b``: classes of different components, and of sizes that allow it, with a shingle in common.

    A class has ``PAIRED`` partners a shingle at most.
    """
    x, y = shared.alias("x"), shared.alias("y")
    met = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.class") < F.col("y.class")))
    met = met.where(F.col("x.component") != F.col("y.component")).where(_sizes_allow(F.col("x.n"), F.col("y.n"), percent))
    return met.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()


def crowded_families(still_open: DataFrame, shared: DataFrame) -> DataFrame:
    """``class, n, component, family``: open classes by the family they share shingles in.

    Each shingle links its classes to one of them, so the links are no more than the shingles.
    The result is written.
    """
    rows = written(shared.select("shingle", "class"))
    first = rows.groupBy("shingle").agg(F.min("class").alias("a"))
    edges = rows.join(first, "shingle").where("a != class").select("a", F.col("class").alias("b"))
    family = components(edges)
    found = written(still_open.join(family.withColumnRenamed("component", "family"), "class"))
    spent(rows, family)
    return found


def family_links(members: DataFrame, sets: DataFrame, sketches: DataFrame, banding: Banding) -> DataFrame:
    """``a, b``: links between different components of a family, all of them but repeats.

    Families are cut into blocks in the order of components, and tasks compare two blocks
    at a time: sketches first, then full sets.  Pairs of blocks within one component are
    left out.  Only links are returned, and of a component one for each class at most.
    The result is written.
    """
    in_order = Window.partitionBy("family").orderBy("component", "class")
    placed = members.withColumn("block", F.floor((F.row_number().over(in_order) - 1) / BLOCK).cast("int"))
    placed = written(placed)
    spans = placed.groupBy("family", "block").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    x, y = spans.alias("x"), spans.alias("y")
    meet = x.join(y, (F.col("x.family") == F.col("y.family")) & (F.col("x.block") <= F.col("y.block"))).where(
        "not (x.lo = y.hi and x.hi = y.hi and x.lo = y.lo)"
    )
    meet = written(meet.select("x.family", F.col("x.block").alias("i"), F.col("y.block").alias("j")))
    ends = meet.select("family", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    asked = filter_of(placed, "class")
    content = placed.join(sketches, "class").join(probable(sets, asked, "class"), "class")
    rows = ends.join(content, ["family", "block"]).select(
        "family", "i", "j", "block", "class", "n", "component", "sketch", "shingles"
    )
    percent, least = banding.percent, banding.least_agreeing

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table.column("block").to_numpy()
        first = np.flatnonzero(side == table.column("i")[0].as_py())
        second = np.flatnonzero(side == table.column("j")[0].as_py())
        names, groups = table.column("class").to_pylist(), table.column("component").to_pylist()
        number = {c: k for k, c in enumerate(dict.fromkeys(groups))}
        group = np.array([number[c] for c in groups])
        sizes = table.column("n").to_numpy()
        own = [_shingles(v) for v in table.column("shingles")]
        marks = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint8).reshape(len(own), -1)
        out_a, out_b = [], []
        for i in first:
            near = (np.minimum(sizes[i], sizes[second]) * 100 >= np.maximum(sizes[i], sizes[second]) * percent)
            rest = second[near & (group[second] != group[i])]
            rest = rest[(marks[rest] == marks[i]).sum(axis=1) >= least]
            done: set[int] = set()
            for j in rest:
                if group[j] in done:
                    continue
                shared = len(np.intersect1d(own[i], own[j], assume_unique=True))
                if 100 * shared >= percent * (len(own[i]) + len(own[j]) - shared):
                    done.add(group[j])
                    out_a.append(names[i])
                    out_b.append(names[j])
        return pa.table([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], names=["a", "b"])

    found = written(rows.groupBy("family", "i", "j").applyInArrow(compare, "a binary, b binary"))
    spent(placed, meet, asked)
    return found


def sketch_filter(pairs: DataFrame, sketches: DataFrame, banding: Banding) -> DataFrame:
    """Pairs whose sketches agree in enough values to be similar at all."""
    a = sketches.select(F.col("class").alias("a"), F.col("sketch").alias("sketch_a"))
    b = sketches.select(F.col("class").alias("b"), F.col("sketch").alias("sketch_b"))
    least = banding.least_agreeing

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
                for c in ("sketch_a", "sketch_b")
            )
            enough = (x == y).sum(axis=1) >= least
            yield batch.select(["a", "b"]).filter(pa.array(enough))

    return pairs.join(a, "a").join(b, "b").mapInArrow(run, "a binary, b binary")


def full_sets(docs: DataFrame, wanted: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """``class, shingles`` of the classes in ``wanted`` (class, doc_id, text_hash).

    ``found`` is the filter of its rows, if there is one already.
    Rows of ``docs`` with equal doc_id and text are put together by the shuffle of the join.
    """
    row = ["text_hash", "_id", "_null"]
    keys = [F.col("text_hash"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.isnull("doc_id").alias("_null")]
    if found is None:
        found = filter_of(wanted, "doc_id", "text_hash")
    some = probable(_hashed(docs), found, "doc_id", "text_hash")
    one = some.select(*keys, "text").groupBy(*row).agg(F.first("text").alias("text"))
    texts = one.join(wanted.select(*keys, "class"), row).select("class", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), pa.array(sets, pa.binary())], names=["class", "shingles"]
            )

    return texts.mapInArrow(run, "class binary, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a = sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                p = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                q = np.frombuffer(y.as_buffer(), dtype=np.uint64)
                shared = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """``class, component`` for every class in ``links`` (a, b); the least class names it.

    Large and small star contractions alternate until no class that an edge leads to has
    an edge of its own; each then leads straight to the least class.  Every round's edges
    are written, and so is the result.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct())
        spent(edges)
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .unionByName(down.select("u", F.col("m").alias("v")))
        )
        edges = written(small.distinct())
        spent(large)
        ends = edges.select(F.col("u").alias("c"), F.lit(True).alias("from_here")).unionByName(
            edges.select(F.col("v").alias("c"), F.lit(False).alias("from_here"))
        )
        both_ways = ends.groupBy("c").agg(F.max("from_here").alias("a"), F.min("from_here").alias("b")).where("a and not b")
        several = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        if both_ways.select("c").unionByName(several.select(F.col("u").alias("c"))).isEmpty():
            break
    own = edges.select(F.col("v").alias("class"), F.col("v").alias("component")).distinct()
    found = written(edges.select(F.col("u").alias("class"), F.col("v").alias("component")).unionByName(own))
    spent(edges)
    return found


def _joined(found: DataFrame, *links: DataFrame) -> DataFrame:
    """The components of ``found`` with ``links`` added: the stars known so far are edges already.

    The tables are spent.
    """
    edges = found.where("class != component").select(F.col("class").alias("a"), F.col("component").alias("b"))
    for more in links:
        edges = edges.unionByName(more)
    joined = components(edges)
    spent(found, *links)
    return joined


def grouped(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component, component_id`` for each row of ``docs``.

    ``component`` names the group, whatever the ids of its rows; NULL without shingles.
    """
    return _grouped(docs, banding)[0]


def _grouped(docs: DataFrame, banding: Banding) -> tuple[DataFrame, list[DataFrame]]:
    """:func:`grouped`, and the tables that it is read from."""
    signed = written(signatures(docs, banding))
    filled = signed.where("class is not null")
    classes = filled.dropDuplicates(["class"]).select("class", "n_shingles", "bands")
    counted = buckets(classes)
    members = written(with_centres(counted))
    spent(counted)
    named = filled.groupBy("class").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_hash")).alias("_row")
    )
    wanted = named.join(members.select("class").distinct(), "class", "left_semi").select(
        "class", "_row.doc_id", "_row.text_hash"
    )
    wanted = written(wanted)
    asked = filter_of(wanted, "doc_id", "text_hash")
    sets = written(full_sets(docs, wanted, asked))
    sketches = probable(filled, asked, "doc_id", "text_hash").select("class", "sketch")
    sketches = written(sketches.join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"]))
    spent(wanted, asked)

    def check(pairs: DataFrame) -> DataFrame:
        near = written(sketch_filter(pairs, sketches, banding))
        alike = written(confirmed(near, sets, banding.percent))
        spent(near)
        return alike

    links = check(central_pairs(members, 0, banding.percent))
    found = components(links)
    spent(links)
    for which in range(1, CENTRES):
        found = _joined(found, check(central_pairs(members, which, banding.percent, found)))
    still_open = written(open_members(members, found))
    spent(members)
    wanted = filter_of(still_open, "class")
    shared, read = shared_shingles(still_open, probable(sets, wanted, "class"), banding.percent)
    few = check(shared_pairs(shared.where("not crowded"), banding.percent))
    families = crowded_families(still_open, shared.where("crowded"))
    spent(still_open, wanted, *read)
    many = family_links(families, sets, sketches, banding)
    spent(families, sets, sketches)
    found = _joined(found, few, many)

    ids = named.join(found, "class", "left").select(
        "class", "first_id", F.coalesce("component", "class").alias("component")
    )
    ids = written(ids)
    spent(found)
    least = ids.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_class = ids.join(least, "component").select("class", "component", "component_id")
    component_id = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    rows = signed.join(by_class, "class", "left").select(
        "doc_id", "text_hash", "n_shingles", "component", component_id.alias("component_id")
    )
    return rows, [signed, ids]


def near_duplicates(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept`` for each row of ``docs``."""
    return grouped(docs, banding).select(
        "doc_id", "text_hash", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def deduplicated(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """``docs`` with one row of each component; all columns stay.

    It is the row with the smallest id, NULL last; of several with that id, one with the smallest
    hash of its text.  Of rows without shingles with equal doc_id and text one stays.
    """
    rows, read = _grouped(docs, banding)
    rows = written(rows.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("_rows")))
    spent(*read)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "_rows")).alias("_row")
    of_groups = rows.where("component is not null").groupBy("component").agg(first)
    alone = rows.where("component is null").select("doc_id", "text_hash", "_rows")
    kept = written(alone.unionByName(of_groups.select("_row.doc_id", "_row.text_hash", "_row._rows")))
    spent(rows)
    rows, old = numbered(docs)
    d, k = rows.withColumn("_h", F.xxhash64(old["text"])).withColumn("_id", old["doc_id"]).alias("d"), kept.alias("k")
    same = (F.col("d._h") == F.col("k.text_hash")) & F.col("d._id").eqNullSafe(F.col("k.doc_id"))
    found = d.join(k, same, "left_semi")
    if not kept.where("_rows > 1").isEmpty():
        found = found.dropDuplicates(["_id", "_h"])
    return restored(found, docs, old["text"])
