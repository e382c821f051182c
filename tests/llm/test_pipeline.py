"""The pipeline over the whole documents table, each stage against SQL, the library or brute force."""

import collections
import hashlib
import os
import re
from pathlib import Path

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from dqgate.llm.oracles import LINE_DEDUP, LINE_RULES, NEAR_DEDUP
from dqgate.llm.queries import VOCABULARY
from test_text_queries import _targets

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that go into each stage and those that come out of the last one, as Parquet paths."""
    paths = [f"{SF_DIR}/documents.parquet"]
    for name, stage in corpus_pipeline.STAGES:
        paths.append(str(tmp_path_factory.mktemp("stages") / name))
        stage(spark, spark.read.parquet(paths[-2]), SF_DIR).write.parquet(paths[-1])
    return [p if p.endswith(".parquet") else f"{p}/*.parquet" for p in paths]


def _sql(path, query):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    return connection.execute(query).fetchall()


def _texts(path):
    rows = _sql(path, "SELECT doc_id, text FROM documents")
    assert len({r[0] for r in rows}) == len(rows)
    return dict(rows)


def _columns(path):
    return [r[0] for r in _sql(path, "DESCRIBE documents")]


def test_columns_stay(stages):
    for path in stages[1:-1]:
        assert _columns(path) == _columns(stages[0])
        assert _sql(path, "SELECT count(*) FROM documents WHERE n_chars <> length(text)") == [(0,)]


def test_rules_keep_what_the_sql_keeps(stages):
    before, after = _texts(stages[0]), _texts(stages[1])
    judged = _sql(stages[0], f"SELECT doc_id, n_lost_chars FROM ({LINE_RULES}) WHERE kept")
    assert {d for d, _ in judged} == set(after) and 0 < len(after) < len(before)
    for doc, lost in judged:
        old, new = before[doc].split("\n"), after[doc].split("\n")
        assert sum(map(len, old)) - sum(map(len, new)) == lost
        rest = iter(old)
        assert all(line in rest for line in new) or not after[doc]  # lines left, in order


def test_later_copies_of_runs_go(stages):
    before, after = _texts(stages[1]), _texts(stages[2])
    want = {}
    for doc, removed in _sql(stages[1], f"SELECT doc_id, removed_lines FROM ({LINE_DEDUP})"):
        gone = {int(i) for i in removed.split(",") if i}
        text = "\n".join(x for i, x in enumerate(before[doc].split("\n")) if i not in gone)
        if not gone or WORD.search(text):
            want[doc] = text
    assert after == want and any(before[d] != t for d, t in after.items())


def test_one_document_of_each_group_stays(stages):
    before, after = _texts(stages[2]), _texts(stages[3])
    kept = {d for (d,) in _sql(stages[2], f"SELECT doc_id FROM ({NEAR_DEDUP}) WHERE kept")}
    assert after == {d: t for d, t in before.items() if d in kept} and len(after) < len(before)


def test_the_mix_takes_what_its_targets_ask_for(stages):
    source_of = dict(_sql(stages[3], "SELECT doc_id, source FROM documents"))
    words = {d: WORD.findall(t) for d, t in _texts(stages[3]).items()}
    taken, by_source = collections.Counter(), collections.Counter()
    for doc, source, text in _sql(stages[4], "SELECT doc_id, source, text FROM documents"):
        own = WORD.findall(text)
        assert source == source_of[doc] and not collections.Counter(own) - collections.Counter(words[doc])
        taken[doc] += len(own)
        by_source[source] += len(own)
    assert all(n <= 3 * len(words[d]) for d, n in taken.items())
    sizes = collections.Counter()
    for doc, own in words.items():
        sizes[source_of[doc]] += len(own)
    names = sorted(sizes, key=lambda s: s.encode("utf-32-be"))
    for name, target in zip(names, _targets([sizes[n] for n in names], (1, 2, 3), 3)):
        assert abs(by_source[name] - target) <= 200


def test_tokens_are_those_of_the_library(stages):
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    want = collections.Counter()
    for doc, text in _sql(stages[4], "SELECT doc_id, text FROM documents"):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[doc, tuple(ids), len(ids), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    got = _sql(stages[5], "SELECT doc_id, ids, n_tokens, decoded_sha256 FROM documents")
    assert collections.Counter((d, tuple(ids), n, h) for d, ids, n, h in got) == want


def test_run_is_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "n_tokens", "decoded_sha256").collect()
    want = _sql(stages[5], "SELECT doc_id, n_tokens, decoded_sha256 FROM documents")
    assert sorted(map(tuple, got)) == sorted(want)
