"""Families in several blocks, repeated ids, common passages and texts of many MB."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from dqgate.llm import line_dedup, near_dedup, textarrays
from dqgate.llm.common import ship_package

LETTERS = "abcdefghijklmnopqrstuvwxyz"
SCHEMA = "doc_id bigint, text string"


def _words(rng, n):
    return ["".join(rng.choices(LETTERS, k=6)) for _ in range(n)]


@pytest.fixture(scope="module")
def edited(spark):
    """Texts of several groups, most of them edits of one."""
    ship_package(spark)
    rng = random.Random(5)
    base, texts = _words(rng, 150), []
    for i in range(300):
        words = list(base) if i % 3 else _words(rng, 60) + base[:40]
        for at in rng.sample(range(len(words)), rng.choice((0, 1, 2, 5))):
            words[at] = f"edit{i}x{at}"
        texts.append(" ".join(words))
    return texts


def _components(texts):
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


@pytest.mark.parametrize("block", [512, 7])
def test_families_in_blocks_of_any_size(spark, edited, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(edited)), SCHEMA)).collect()
    assert [r.component_id for r in sorted(rows, key=lambda r: r.doc_id)] == _components(edited)


def test_family_links_in_small_blocks(spark, edited, monkeypatch):
    """All links between components, though the members of a family lie in several blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    banding = near_dedup.Banding()
    some = edited[:40]
    docs = spark.createDataFrame(list(enumerate(some)), SCHEMA)
    signed = near_dedup.written(near_dedup.signatures(docs, banding)).dropDuplicates(["class"])
    wanted = signed.select("class", "doc_id", "text_hash")
    sets = near_dedup.written(near_dedup.full_sets(docs, wanted))
    names = {bytes(r["class"]): r.doc_id for r in signed.collect()}
    members = signed.selectExpr("class", "n_shingles as n", "class as component", "cast('one' as binary) as family")
    got = near_dedup.family_links(members, sets, signed.select("class", "sketch"), banding).collect()
    links = {tuple(sorted((names[bytes(r.a)], names[bytes(r.b)]))) for r in got}
    shingles = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in some]
    expected = set()
    for i in names.values():
        for j in names.values():
            both = len(shingles[i] & shingles[j])
            if i < j and 100 * both >= 75 * (len(shingles[i]) + len(shingles[j]) - both):
                expected.add((i, j))
    assert links == expected and len(expected) > 20


def test_one_row_of_a_group_whatever_its_ids(spark):
    ship_package(spark)
    rng = random.Random(6)
    one, two, three = (_words(rng, 200) for _ in range(3))
    near = lambda words, i: " ".join([*words[:100], f"other{i}", *words[101:]])
    rows = [
        (7, near(one, 1)), (7, near(one, 2)), (7, near(one, 2)),  # one id, two texts, one of them twice
        (7, " ".join(two)),  # the same id in another group
        (None, near(three, 1)), (None, near(three, 2)), (None, near(three, 3)),  # no id at all
        (8, None), (8, None), (8, ""), (None, None), (9, " "),
    ]
    kept = near_dedup.deduplicated(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    texts = [r.text or "" for r in kept]
    assert sum("other" in t and one[0] in t for t in texts) == 1
    assert sum(t == " ".join(two) for t in texts) == 1
    assert sum(three[0] in t for t in texts) == 1
    assert {(r.doc_id, r.text) for r in kept if not (r.text or "").strip()} == {(8, None), (8, ""), (None, None), (9, " ")}
    assert len(kept) == 7


def test_pieces_of_a_text_hash_like_the_whole(monkeypatch):
    rng = random.Random(7)
    text = "".join(rng.choice(["A", "b", "é", " ", "\n", "\t", "long" * 30]) for _ in range(20_000))
    texts = pa.array([text, "", text[5:], None, "word"])
    whole = [list(s) for s in textarrays.shingle_sets(texts)]
    monkeypatch.setattr(textarrays, "CHUNK_BYTES", 1000)
    assert [list(s) for s in textarrays.shingle_sets(texts)] == whole


def test_a_text_of_many_megabytes_needs_little_more_than_itself():
    rng = np.random.default_rng(8)
    letters = rng.integers(97, 123, 30_000_000, dtype=np.uint8)
    letters[rng.random(len(letters)) < 1 / 6] = 32
    texts = pa.array([letters.tobytes().decode()])
    tracemalloc.start()
    found = next(iter(textarrays.shingle_sets(texts)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) > 3_000_000
    assert peak < 12 * len(letters)


def test_later_copies_of_one_common_passage(spark):
    """A passage that most texts hold stays in the first only."""
    rng = random.Random(9)
    passage = [" ".join(_words(rng, 20)) for _ in range(4)]
    texts = ["\n".join([" ".join(_words(rng, 9)), *(passage if i % 4 else []), " ".join(_words(rng, 9))]) for i in range(400)]
    rows = line_dedup.line_report(spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(7)).collect()
    assert {r.doc_id for r in rows if r.n_removed} == {i for i in range(400) if i % 4 and i != 1}
    assert {r.removed_lines for r in rows if r.n_removed} == {"1,2,3,4"}
