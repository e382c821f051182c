"""Words and shingles of many texts as hash arrays, for use inside Arrow tasks.

Texts are handled as bytes, a few MB at a time, without a Python step per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on together.
CHUNK_BYTES = 2_000_000
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, up to ``n`` at least."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n], _powers["down"][:n]


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows holding about ``CHUNK_BYTES``."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + CHUNK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def _blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _piece_end(data: np.ndarray, at: int) -> int:
    """Where to cut so that no word is cut: before a blank, about ``CHUNK_BYTES`` after ``at``."""
    end = at + 2 * CHUNK_BYTES
    while end < len(data):
        blanks = np.flatnonzero(_blank(data[end : end + 65_536]))
        if len(blanks):
            return end + int(blanks[0])
        end += 65_536
    return len(data)


def _hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of ``data``, in which texts begin at ``offsets``."""
    upper = (data >= 65) & (data <= 90)
    lowered = data + (upper * np.uint8(32))
    inside = ~_blank(data)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = inside & (edge[:-1] | np.concatenate(([True], ~inside[:-1])))
    ends = inside & (edge[1:] | np.concatenate((~inside[1:], [True])))
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((lowered.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return mixed((sums[e] - sums[s]) * down[s]), s


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z as a-z) in order, and each text's range among them.

    A long text is worked on in pieces cut between words; the hash of a word does not
    depend on its place.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    hashes, places, at = [], [], 0
    while at < len(data):
        end = _piece_end(data, at)
        own, first = _hashed_words(data[at:end], offsets[(offsets >= at) & (offsets <= end)] - at)
        hashes.append(own)
        places.append(first + at)
        at = end
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    if len(words) < n:
        return words[:0]
    total = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for j in range(n):
        total = total * _STEP + words[j : j + len(total)]
    return mixed(total, n)


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; fewer words make one shingle."""
    return np.unique(grams(words, min(n, len(words)))) if len(words) else words


def shingle_sets(texts: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """The shingle set of each text, in order."""
    for _, data, offsets in chunks(texts):
        words, bounds = word_hashes(data, offsets)
        for i in range(len(offsets) - 1):
            yield shingle_set(words[bounds[i] : bounds[i + 1]], n)
