"""Sharding by histogram sort: shards of near equal bytes, cut from one global key order.

Keys are the hash of the text, then ``doc_id``, then a number that tells equal rows
apart; so equal texts lie side by side and meet in one shard wherever sizes allow it.
The splitters are found without sorting: every round counts exact bytes and rows below a
set of candidate keys in all partitions, and narrows each splitter's interval to the
candidates around it, until a splitter is near enough or its interval holds one key.
Then each row is sent once, to its place.  Shards are cut into several pieces by the same
counts, so that no task gets a whole shard, and the counts give every piece its first slot.

The driver sees counts only: at most ``PROBES`` per open splitter and round.

Defined results: NULL text has no bytes; NULL doc_id comes after all others; rows equal
in every column are told apart by a number given when they are first written; a row is
never cut, so a shard may differ by one large row; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from dqgate.llm.common import written

#: Candidate keys per open splitter and round.
PROBES = 64
_KEY_BYTES = 24


@dataclass(frozen=True)
class Sharding:
    """``tolerance`` is the allowed error of a splitter, as a share of a shard's bytes."""

    shards: int = 40
    pieces: int = 8
    row_bytes: int = 16
    tolerance: float = 0.001


@dataclass(frozen=True)
class Splitter:
    """All rows with a smaller key come before it: so many bytes and rows."""

    key: int
    bytes: int
    rows: int


def keyed(docs: DataFrame, law: Sharding = Sharding()) -> DataFrame:
    """``doc_id, size, text_crc32, text_hash, copy`` of each row; written once, so that keys stay.

    ``copy`` numbers the rows of the table; it only matters between rows that are equal.
    """
    digest = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + law.row_bytes).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.monotonically_increasing_id().alias("copy"),
    )
    return written(digest)


@dataclass(frozen=True)
class KeySpace:
    """Keys as whole numbers: hash, then id above the least id, then copy."""

    least_id: int
    id_bits: int
    copy_bits: int

    @property
    def top(self) -> int:
        return 1 << (64 + self.id_bits + self.copy_bits)

    def packed(self, key: int) -> bytes:
        """The key as bytes that sort like it: 8 each for hash, id and copy."""
        if key >= self.top:
            return b"\xff" * _KEY_BYTES
        copy = key & ((1 << self.copy_bits) - 1)
        own = (key >> self.copy_bits) & ((1 << self.id_bits) - 1)
        return b"".join(n.to_bytes(8, "big") for n in (key >> (self.copy_bits + self.id_bits), own, copy))

    def arrays(self, batch: pa.RecordBatch) -> np.ndarray:
        """The packed keys of a batch of (doc_id, text_hash, copy)."""
        ids = batch.column("doc_id")
        known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        # Differences wrap to the right unsigned number whatever the signs.
        own = known.view(np.uint64) - np.uint64(self.least_id % (1 << 64))
        own = np.where(ids.is_null().to_numpy(zero_copy_only=False), np.uint64((1 << self.id_bits) - 1), own)
        hashed = batch.column("text_hash").to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
        copy = batch.column("copy").to_numpy().view(np.uint64)
        stacked = np.stack([hashed, own, copy], axis=1).astype(">u8")
        return np.ascontiguousarray(stacked).view(f"S{_KEY_BYTES}").ravel()


def key_space(rows: DataFrame) -> KeySpace:
    least, most, copies = rows.agg(F.min("doc_id"), F.max("doc_id"), F.max("copy")).first()
    least, most, copies = least or 0, most or 0, copies or 0
    # One number more than the ids need stands for NULL.
    return KeySpace(least, max(1, (most - least + 1).bit_length()), max(1, copies.bit_length()))


def counts_below(rows: DataFrame, space: KeySpace, keys: list[int]) -> list[tuple[int, int]]:
    """Exact (bytes, rows) below each of the sorted ``keys``, summed over all partitions."""
    probes = np.array([space.packed(k) for k in keys], dtype=f"S{_KEY_BYTES}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(len(probes) + 1, dtype=np.int64)
        numbers = np.zeros(len(probes) + 1, dtype=np.int64)
        for batch in batches:
            cell = np.searchsorted(probes, space.arrays(batch), side="right")
            np.add.at(sizes, cell, batch.column("size").to_numpy())
            np.add.at(numbers, cell, 1)
        used = np.flatnonzero(numbers)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(sizes[used]), pa.array(numbers[used])], names=["cell", "bytes", "rows"]
        )

    cells = rows.select("doc_id", "text_hash", "copy", "size").mapInArrow(count, "cell bigint, bytes bigint, rows bigint")
    summed = cells.groupBy("cell").agg(F.sum("bytes"), F.sum("rows")).collect()
    sizes, numbers = np.zeros(len(keys) + 1, dtype=np.int64), np.zeros(len(keys) + 1, dtype=np.int64)
    for cell, size, number in summed:
        sizes[cell], numbers[cell] = size, number
    return list(zip(np.cumsum(sizes)[:-1].tolist(), np.cumsum(numbers)[:-1].tolist()))


def find_splitters(rows: DataFrame, law: Sharding = Sharding()) -> tuple[KeySpace, list[Splitter]]:
    """One splitter for every piece but the first, in key order.

    An interval is closed when one of its ends is near enough to the wanted bytes, or no
    key lies between its ends; the nearer end is the splitter.
    """
    space = key_space(rows)
    total, number = rows.agg(F.sum("size"), F.count("*")).first()
    total = total or 0
    parts = law.shards * law.pieces
    wanted = [total * i // parts for i in range(1, parts)]
    near = law.tolerance * total / law.shards
    low = [Splitter(0, 0, 0)] * len(wanted)
    high = [Splitter(space.top, total, number)] * len(wanted)

    def is_open(i: int) -> bool:
        error = min(wanted[i] - low[i].bytes, high[i].bytes - wanted[i])
        return error > near and high[i].key - low[i].key > 1 and high[i].rows - low[i].rows > 1

    while todo := [i for i in range(len(wanted)) if is_open(i)]:
        probes = sorted(
            {
                low[i].key + (high[i].key - low[i].key) * j // (PROBES + 1)
                for i in todo
                for j in range(1, PROBES + 1)
            }
        )
        found = [Splitter(k, *c) for k, c in zip(probes, counts_below(rows, space, probes))]
        sizes = [s.bytes for s in found]
        for i in todo:
            at = bisect_left(sizes, wanted[i])
            if at < len(found) and found[at].key < high[i].key:
                high[i] = found[at]
            if at > 0 and found[at - 1].key > low[i].key:
                low[i] = found[at - 1]
    nearer = [a if w - a.bytes <= b.bytes - w else b for w, a, b in zip(wanted, low, high)]
    return space, nearer


def sharded(rows: DataFrame, law: Sharding = Sharding()) -> DataFrame:
    """``rows`` of :func:`keyed` with ``shard`` and ``slot``, gapless from 0 within a shard."""
    space, splitters = find_splitters(rows, law)
    keys = np.array([space.packed(s.key) for s in splitters], dtype=f"S{_KEY_BYTES}")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            piece = np.searchsorted(keys, space.arrays(batch), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(piece)], names=[*batch.schema.names, "piece"])

    placed = rows.mapInArrow(place, f"{_ddl(rows)}, piece int")
    # Rows before a piece, less the rows before its shard: the piece's first slot.
    before = [0, *(s.rows for s in splitters)]
    first = F.array(*[F.lit(n - before[i - i % law.pieces]) for i, n in enumerate(before)])
    inside = Window.partitionBy("piece").orderBy("text_hash", F.col("doc_id").asc_nulls_last(), "copy")
    slot = F.row_number().over(inside) - 1 + F.element_at(first, F.col("piece") + 1)
    return placed.select(
        *rows.columns, F.floor(F.col("piece") / law.pieces).cast("int").alias("shard"), slot.cast("long").alias("slot")
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def shard_documents(docs: DataFrame, law: Sharding = Sharding()) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row of ``docs``."""
    return sharded(keyed(docs, law), law).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
