"""Filters of wanted keys in near-dedup: nothing wanted is lost, and little else is shuffled."""

import random

import pytest

from dqgate.llm import near_dedup
from dqgate.llm.common import ship_package

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def rows(spark):
    """Groups of edits, exact copies, ids that repeat or are missing, and texts of their own."""
    ship_package(spark)
    rng = random.Random(8)
    words = lambda: [f"w{rng.randrange(10**6)}" for _ in range(80)]
    found = []
    for group in range(6):
        base = words()
        for i in range(4):
            found.append((10 * group + i, " ".join([*base[:40], f"edit{i}", *base[41:]])))
    found += [found[1], found[5], (None, found[2][1]), (None, found[2][1]), (500, found[2][1])]
    return found + [(1000 + i, " ".join(words())) for i in range(60)]


@pytest.mark.parametrize("bits", [1 << 24, 64])
def test_a_full_filter_loses_nothing(spark, rows, monkeypatch, bits):
    monkeypatch.setattr(near_dedup, "FILTER_BITS", bits)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None and r.doc_id < 100:
            assert r.component_id == r.doc_id // 10 * 10
        else:
            assert r.component_id == (r.doc_id if r.doc_id and r.doc_id >= 1000 else 0)


def test_filtered_rows(spark):
    wanted = spark.createDataFrame([(1, 5), (None, 6), (None, None)], "doc_id bigint, text_hash bigint")
    others = spark.range(1000).selectExpr("id + 10 as doc_id", "id as text_hash")
    found = near_dedup.filter_of(wanted, "doc_id", "text_hash")
    left = near_dedup.probable(wanted.unionByName(others), found, "doc_id", "text_hash").collect()
    assert {(1, 5), (None, 6), (None, None)} <= {tuple(r) for r in left} and len(left) < 10


def test_only_wanted_texts_are_shuffled(spark, rows):
    """Texts are filtered before their one shuffle, and the sets made of them stay where they are."""
    docs = spark.createDataFrame(rows, SCHEMA)
    signed = near_dedup.written(near_dedup.signatures(docs)).where("class is not null")
    wanted = signed.where("doc_id < 20").groupBy("class").agg({"doc_id": "min"}).toDF("class", "doc_id")
    wanted = near_dedup.written(wanted.join(signed.select("class", "doc_id", "text_hash"), ["class", "doc_id"]).distinct())
    sets = near_dedup.full_sets(docs, wanted)
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("MapInArrow")]
    assert "LeftSemi" in plan[plan.index("Exchange") :]
    assert sorted(bytes(r["class"]) for r in sets.collect()) == sorted(bytes(r["class"]) for r in wanted.collect())
