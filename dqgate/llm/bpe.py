"""BPE encoding and decoding with a contiguous rank array per short word.

A word is held as an array of part boundaries with the merge rank of every adjacent pair
beside it.  The smallest rank is found by scanning the short array, its boundary deleted,
and only the two neighbouring ranks looked up again.  Words of more than ``LONG`` parts,
where scanning would be quadratic, take their next merge from a heap instead, with the
same result.  Tasks work on Arrow batches of rows; a word is merged once per task cache.

Defined results: NULL text is encoded like the empty text (no ids; decodes to the empty
text); every row is encoded by itself, so NULL or repeated ids, repeated rows and very
long texts need no special case; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

#: Above this many parts a heap replaces the scan.
LONG = 64
#: Merged words kept per Python worker.
CACHED = 400_000
#: Ids per Arrow batch handed back to Spark.
BATCH_IDS = 4_000_000

ENCODED = "doc_id bigint, ids array<int>"
DECODED = "doc_id bigint, text string"

# Fixed values of the vocabulary's format.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_END = "</w>"
_WIDE_SPACES = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: str.split() also breaks at these, which the format does not take for white space.
_NOT_SPACE = regex.compile("[\x1c-\x1f]")
_SPACE = regex.compile("[\\t-\\r\\x20" + "".join(map(chr, _WIDE_SPACES)) + "]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte.

    Printable Latin-1 bytes stand for themselves; the others, in order, take the code
    points from 256 on.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class Tokenizer:
    """One vocabulary file: lower-case word BPE with a word-end mark."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.tokens = {i: t for t, i in chain(self.ids.items(), special.items())}
        marks = "|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True))
        self._marks = regex.compile(f"({marks})") if marks else None
        self._pieces = regex.compile(_PIECES)
        self._letters = byte_letters()
        self._words = _Cache(self._chunk)
        self._merged = _Cache(self._merge)

    def encode(self, text: str) -> np.ndarray:
        if self._marks is None or "<|" not in text:
            return self._plain(text)
        parts = [
            np.array([self.special[part]], dtype=np.int32) if part in self.special else self._plain(part)
            for part in self._marks.split(text)
        ]
        return np.concatenate(parts)

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens with single spaces between, special ones included; unknown ids are left out."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids if i in tokens])

    def _plain(self, text: str) -> np.ndarray:
        chunks = text.split() if _NOT_SPACE.search(text) is None else _SPACE.split(text)
        return np.fromiter(chain.from_iterable(map(self._words.__getitem__, chunks)), dtype=np.int32)

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of a run without white space.  No rule looks across white space."""
        if chunk.isascii():
            lowered = chunk.lower()
        else:
            # Letter by letter: the format lower-cases without looking at a letter's place.
            lowered = "".join([c.lower() for c in unicodedata.normalize("NFC", chunk)])
        if lowered.isalpha():
            return self._merged[lowered]
        return tuple(chain.from_iterable([self._merged[p] for p in self._pieces.findall(lowered)]))

    def _merge(self, piece: str) -> tuple[int, ...]:
        parts = [self._letters[b] for b in piece.encode("utf-8", "surrogatepass")]
        parts[-1] += _WORD_END
        merged = scan_merge(parts, self.ranks) if len(parts) <= LONG else heap_merge(parts, self.ranks)
        return tuple([self.ids[p] for p in merged])


class _Cache(dict):
    """Words by text, filled on demand and emptied when full."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key: str):
        if len(self) >= CACHED:
            self.clear()
        value = self.make(key)
        if len(key) <= 4 * LONG:
            self[key] = value
        return value


_NONE = 1 << 60
_loaded: dict[bytes, Tokenizer] = {}


def tokenizer_of(vocabulary: bytes) -> Tokenizer:
    """The tokenizer of this Python worker; the words it has merged serve later tasks too."""
    key = hashlib.sha256(vocabulary).digest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Tokenizer(vocabulary)
    return _loaded[key]


def scan_merge(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge by rank: scan the adjacent ranks for the smallest, delete its boundary.

    ``parts`` lies contiguously with ``near[i]``, the rank of the pair that meets at
    boundary i + 1, beside it.  Of equal ranks the leftmost goes first.
    """
    get = ranks.get
    near = [get(pair, _NONE) for pair in zip(parts, parts[1:])]
    while near and (least := min(near)) != _NONE:
        i = near.index(least)
        joined = parts[i] = parts[i] + parts[i + 1]
        del parts[i + 1], near[i]
        if i:
            near[i - 1] = get((parts[i - 1], joined), _NONE)
        if i < len(near):
            near[i] = get((joined, parts[i + 1]), _NONE)
    return parts


def heap_merge(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The same merges for a long word: pairs wait in a heap by (rank, place)."""
    text = list(parts)
    after = [*range(1, len(parts)), -1]
    before = list(range(-1, len(parts) - 1))
    heap = [
        (rank, i, a, b)
        for i, (a, b) in enumerate(zip(parts, parts[1:]))
        if (rank := ranks.get((a, b))) is not None
    ]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if j < 0 or text[i] != a or text[j] != b:
            continue
        text[i], text[j] = a + b, ""
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for left in (before[i], i):
            right = after[left] if left >= 0 else -1
            if right >= 0 and (rank := ranks.get((text[left], text[right]))) is not None:
                heapq.heappush(heap, (rank, left, text[left], text[right]))
    return [t for t in text if t]


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, vocabulary: bytes) -> DataFrame:
    """``doc_id, ids`` for each row of ``docs`` (doc_id, text).

    ``vocabulary`` is the content of the vocabulary file, read once on the driver; it is
    broadcast, a fixed file of one or two MB.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(shared.value)
        for batch in batches:
            rows: list[np.ndarray] = []
            first = held = 0
            for i, text in enumerate(batch.column(1)):
                ids = tokenizer.encode(text.as_py() or "")
                rows.append(ids)
                held += len(ids)
                if held >= BATCH_IDS:
                    yield _ids_batch(batch.column(0).slice(first, len(rows)), rows)
                    first, held, rows = i + 1, 0, []
            if rows:
                yield _ids_batch(batch.column(0).slice(first, len(rows)), rows)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, ENCODED)


def _ids_batch(keys: pa.Array, rows: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows)))
    return pa.RecordBatch.from_arrays([keys, ids], names=["doc_id", "ids"])


def decode(encoded: DataFrame, vocabulary: bytes) -> DataFrame:
    """``doc_id, text`` for each row of ``encoded`` (doc_id, ids)."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(shared.value)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts = [tokenizer.decode(ids.values.to_numpy()) if ids.is_valid else "" for ids in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, DECODED)


def encode_decode(docs: DataFrame, vocabulary: bytes) -> DataFrame:
    """``doc_id, ids, text``: the ids of each row and what they decode to, in one pass.

    The rows are not joined back: repeated or NULL ids would not tell them apart.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(shared.value)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                rows = [tokenizer.encode(text.as_py() or "") for text in part.column(1)]
                texts = pa.array([tokenizer.decode(ids.tolist()) for ids in rows], pa.string())
                made = _ids_batch(part.column(0), rows)
                yield pa.RecordBatch.from_arrays(
                    [made.column(0), made.column(1), texts], names=["doc_id", "ids", "text"]
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, ids array<int>, text string"
    )
