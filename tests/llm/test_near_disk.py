"""Disk of near-dedup: chains of texts make no large family, and nothing stays that is not read again."""

import random
import time
import uuid
from pathlib import Path

import pytest

from dqgate.functions import lineage
from dqgate.llm import common, near_dedup

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def chain(spark):
    """Texts that are near the next ones, each below the threshold."""
    common.ship_package(spark)
    rng = random.Random(11)
    words = [f"w{rng.randrange(10**9)}" for _ in range(20 * 300 + 100)]
    return spark.createDataFrame([(i, " ".join(words[20 * i : 20 * i + 100])) for i in range(300)], SCHEMA).repartition(3)


def test_a_chain_is_paired_and_not_a_family(spark, chain, monkeypatch):
    given, links = [], near_dedup.family_links
    monkeypatch.setattr(near_dedup, "family_links", lambda members, *a: (given.append(members.count()), links(members, *a))[1])
    found = near_dedup.near_duplicates(chain).collect()
    assert given == [0] and len(found) == 300 and all(r.kept for r in found)


@pytest.mark.parametrize("paired, common_from", [(1, 8), (32, 0)])
def test_links_do_not_depend_on_the_limits(spark, monkeypatch, paired, common_from):
    """Nothing is linked in buckets, so all links are found by rare shingles: paired, or within families."""
    common.ship_package(spark)
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(10**9)}"
    texts = []
    for _ in range(12):
        base = [word() for _ in range(100)]
        texts += [" ".join([*base[:at], word(), *base[at + 1 :]]) for at in (10, 40, 70, 90)]
        texts.append(" ".join([*base[:50], *[word() for _ in range(50)]]))
    monkeypatch.setattr(near_dedup, "PAIRED", paired)
    monkeypatch.setattr(near_dedup, "COMMON", common_from)
    monkeypatch.setattr(near_dedup, "central_pairs", lambda members, *a: members.select("class", "class").toDF("a", "b").limit(0))
    monkeypatch.setattr(near_dedup, "open_members", lambda m, c: m.selectExpr("class", "n", "class as component").distinct())
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in rows} == {i: i if i % 5 == 4 else i // 5 * 5 for i in range(len(texts))}


def test_tables_go_when_they_are_read(spark, chain, tmp_path, monkeypatch):
    monkeypatch.setattr(lineage, "work_dir", lambda _: f"file://{tmp_path}/a b%20/{uuid.uuid4().hex}")
    tables = lambda: {p.parent for p in Path(tmp_path).rglob("*.parquet")}
    assert near_dedup.near_duplicates(chain).count() == 300 and len(tables()) == 2
    assert near_dedup.deduplicated(chain).count() == 300 and len(tables()) == 3


def test_shuffle_files_go_with_their_job(spark):
    files = lambda: {f.getName() for f in _all(disk.getAllFiles()) if f.getName().startswith("shuffle_")}
    _all = lambda found: [found.apply(i) for i in range(found.size())]
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", files()
    was = spark.conf.get(key)
    table = common.written_once(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count())
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and table.count() == 7 and spark.conf.get(key) == was
    common.spent(table)
    assert not Path(table.inputFiles()[0].removeprefix("file://")).exists()
