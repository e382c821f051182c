"""Importance resampling recomputed word by word in plain Python, over the whole documents table."""

import collections
import math
import os
import re
import struct
from pathlib import Path

import duckdb
import pytest
import xxhash

from dqgate.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
FULL = (1 << 64) - 1
BUCKETS, SEED = 1 << 14, 7

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def _mixed(x, salt=0):
    x ^= salt
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & FULL
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & FULL
    return x ^ (x >> 31)


_words: dict[bytes, int] = {}


def _word(word):
    if word not in _words:
        total = 0
        for byte in reversed(word):
            total = (total * (0x9E3779B97F4A7C15 | 1) + byte + 1) & FULL
        _words[word] = _mixed(total)
    return _words[word]


def _features(text):
    own = [_word(w) for w in WORD.findall((text or "").encode().lower())]
    pairs = [_mixed((a * 0xD6E8FEB86659FD93 + b) & FULL, 2) for a, b in zip(own, own[1:])]
    return collections.Counter(h % BUCKETS for h in [*(_mixed(w, 1) for w in own), *pairs])


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _uniform(doc_id, text):
    """From the row's hash: the id, the text's hash and the seed, one after the other."""
    of_text = 42 if text is None else _signed(xxhash.xxh64_intdigest(text.encode(), seed=42))
    h = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
    h = xxhash.xxh64_intdigest(struct.pack("<q", of_text), seed=h)
    h = xxhash.xxh64_intdigest(struct.pack("<i", SEED), seed=h)
    return (_signed(h) % (1 << 52) + 0.5) / (1 << 52)


def test_weights_keys_and_positions(spark):
    duck = duckdb.connect()
    docs = duck.execute(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    labels = duck.execute(f"SELECT doc_id, quality, toxic FROM '{SF_DIR}/labels.parquet'").fetchall()
    target = {d for d, quality, toxic in labels if quality == 1 and not toxic}
    found = [(doc, _features(text)) for doc, text in docs]
    raw, good = collections.Counter(), collections.Counter()
    for doc, counts in found:
        raw.update(counts)
        if doc in target:
            good.update(counts)
    raw_total, good_total = sum(raw.values()), sum(good.values())
    ratio = {}
    for bucket in range(BUCKETS):
        p = (raw[bucket] + 1) / (raw_total + BUCKETS)
        ratio[bucket] = math.log((good[bucket] + BUCKETS * p) / (good_total + BUCKETS)) - math.log(p)
    want = {}
    for (doc, text), (_, counts) in zip(docs, found):
        weight = math.fsum(ratio[b] * n for b, n in counts.items())
        want[doc] = (sum(counts.values()), weight, weight - math.log(-math.log(_uniform(doc, text))))
    assert len(want) == len(docs)
    rows = {r.doc_id: r for r in QUERIES["op3_importance"](spark, SF_DIR).collect()}
    assert set(rows) == set(want)
    for doc, (number, weight, key) in want.items():
        assert rows[doc].n_features == number
        assert math.isclose(rows[doc].log_weight, weight, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(rows[doc].gumbel_key, key, rel_tol=1e-9, abs_tol=1e-9)
    known = [quality for _, quality, _ in labels if quality is not None]
    kept = -(-len(docs) * sum(known) // len(known))
    order = sorted(want, key=lambda d: (-want[d][2], d))
    for place, doc in enumerate(order):
        assert rows[doc].position == place and rows[doc].kept == (place < kept)
