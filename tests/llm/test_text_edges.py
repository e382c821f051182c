"""Defined results of the text operators on NULLs, empty and long texts, ties, repeats, empty tables."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dqgate.llm import (
    bpe, importance, licenses, line_dedup, line_rules, mixing, near_dedup, neighbours, sharding, textarrays, url_filter,
)
from dqgate.llm.common import ranked, ship_package
from dqgate.llm.queries import vocabulary

random.seed(4)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _prose(n, start=0):
    rng = random.Random(n * 1000 + start)
    words = ["".join(rng.choices(LETTERS, k=rng.randint(2, 8))) for _ in range(n)]
    return " ".join(words[:30]) + ".\n" + " ".join(words[30:]) + "."


GOOD, OTHER = _prose(90), _prose(120, 7)
LONG = "\n".join(_prose(80, i) for i in range(120))
CASES = [
    (1, GOOD, "b"), (2, OTHER, "a"), (3, None, "a"), (4, "", "b"), (5, " \t\n ", None),
    (6, "two words", "é"), (7, GOOD, "b"), (7, GOOD, "b"), (8, LONG, "b"), (None, GOOD, "c"),
    (None, None, None), (9, OTHER.replace(OTHER.split()[40], "changed"), "a"),
    (10, "\n".join([GOOD, OTHER]), "z"), (11, "WORD " * 3000, "a"), (12, "ÀÉ\x1c’<|endoftext|> x" * 3, "b"),
]
SCHEMA = "doc_id bigint, text string, source string"
EXTRA = ", size bigint, class string, key int, block int, n_chars int, _text string, rank int, doc string, lines string"


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = [(*c, 1, "x", 2, 3, 4, "t", 5, "d", "l") for c in CASES]
    return spark.createDataFrame(rows, SCHEMA + EXTRA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def _by_id(rows):
    found = collections.defaultdict(list)
    for row in rows:
        found[row.doc_id].append(row)
    return found


def test_mixing(docs, empty):
    rows = mixing.words_taken(docs).collect()
    assert len(rows) == len(CASES)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    found = _by_id(rows)
    assert [r.size for r in found[3] + found[4] + found[5]] == [0, 0, 0]
    assert found[7][0].size == 90 and len(found[7]) == 2
    sizes = collections.Counter()
    for _, text, source in CASES:
        sizes[source] += len(WORD.findall(text or ""))
    assert all(r.source_size == sizes[s] for r in rows for s in [next(c[2] for c in CASES if c[0] == r.doc_id)] if r.doc_id)
    assert mixing.words_taken(empty).collect() == []
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixing.mixed_documents(empty).columns == docs.columns
    texts = mixed.collect()
    assert all(r.n_chars == len(r.text) for r in texts)
    assert sum(len(WORD.findall(r.text)) for r in texts) == sum(r.taken for r in rows)
    assert all(r.text for r in texts)


def test_permutations_are_permutations(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 100):
        rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(9).cast("long")).alias("p"))
        assert sorted(r.p for r in rows.collect()) == list(range(n))


def test_near_duplicates(docs, empty):
    found = _by_id(near_dedup.near_duplicates(docs).collect())
    assert [r.component_id for r in found[7]] == [1, 1] and not found[7][0].kept
    assert found[1][0].kept and found[9][0].component_id == 2
    assert found[3][0].n_shingles == 0 and found[3][0].component_id == 3 and found[4][0].kept
    assert found[6][0].n_shingles == 1 and found[11][0].n_shingles == 1
    assert sorted((r.component_id is None, r.kept) for r in found[None]) == [(False, False), (True, True)]
    assert near_dedup.near_duplicates(empty).collect() == []
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 8, 10, 11, 12]


def test_near_duplicates_of_a_large_family(spark):
    """Copies of one text, each edited differently, and texts that only share a passage."""
    base = ["".join(random.choices(LETTERS, k=6)) for _ in range(160)]
    texts = []
    for i in range(160):
        words = list(base)
        for at in random.sample(range(160), random.choice((1, 2, 4, 6))):
            words[at] = f"edit{i}x{at}"
        texts.append(" ".join(words))
    for i in range(160):
        own = ["".join(random.choices(LETTERS, k=6)) for _ in range(random.choice((20, 60, 200)))]
        texts.append(" ".join(own[:10] + base[:60] + own[10:]))
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert {r.doc_id: r.component_id for r in rows} == {i: root(i) for i in range(len(texts))}


def test_importance(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (11, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    rows = importance.resampled(docs, labels).collect()
    assert len(rows) == len(CASES) and sorted(r.position for r in rows) == list(range(len(CASES)))
    assert all(r.log_weight == 0 for r in rows if r.n_features == 0)
    assert importance.resampled(empty, labels).collect() == []
    none = importance.resampled(docs, labels.limit(0)).collect()
    assert all(r.log_weight == 0 and r.kept for r in none)


def test_line_rules(docs, empty):
    rows = line_rules.clean_lines(docs)
    found = _by_id(rows.collect())
    assert found[1][0].kept and found[7][1].kept and not found[3][0].kept
    assert found[11][0].n_repeat_words == 3000 and found[11][0].base_failed
    assert found[8][0].n_dup_lines == 0 and found[4][0].n_words == 0
    assert line_rules.clean_lines(empty).collect() == []
    kept = line_rules.cleaned_documents(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 7, 8, 9, 10, None}


def test_single_lines(spark):
    from pyspark.sql import functions as F

    lines = {
        "A sentence that ends.": True, "too short": False, "a longer line without any end mark": True,
        "Home | About | Contact": False, "BUY NOW!! CHEAP!! OFFER!!": False, "We use JavaScript here.": False,
        "a### b*** c&&& d%%%.": False, "": True, "Said: “quoted.”": True,
    }
    rows = spark.createDataFrame([(k,) for k in lines], "x string").select("x", line_rules.line_passes(F.col("x")).alias("ok"))
    assert {r.x: r.ok for r in rows.collect()} == lines


def test_scripts_without_case_are_not_shouting(spark):
    """Acronyms in Japanese, Arabic or Hindi lines; whole documents of such lines stay."""
    lines = {
        "NASAは今日、FBIと共に新しい計画を発表した。": True, "أعلنت وكالة NASA اليوم عن خطة جديدة.": True,
        "आज NASA और FBI ने नई योजना बताई।.": True, "THE AGENCY TOLD US TODAY.": False, "ДОБРО ПОЖАЛОВАТЬ СЮДА.": False,
    }
    rows = spark.createDataFrame(list(lines.items()), "x string, ok boolean").withColumn("ok2", line_rules.line_passes(F.col("x")))
    assert {r.x: r.ok2 for r in rows.collect()} == lines
    words = [f"كلمة{chr(0x0627 + i % 28)}{chr(0x0627 + i // 28)}" for i in range(90)]
    text = "\n".join(" ".join(words[i : i + 9]) + " NASA." for i in range(0, 90, 9))
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert line_rules.cleaned_documents(docs).first().text == text


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [nan, 1.0]), (4, [0.0, 0.0]),
        (5, None), (6, [None, 1.0]), (7, [inf, 1.0]), (40, []), (None, [1.0, 1.0]), (8, [1.0]), (60, [-3.0, 1.0]), (2, [0.0, 2.0]),
    ]
    df = spark.createDataFrame([(*v, 1, "x") for v in vectors], "vec_id bigint, embedding array<float>, rank int, score string")
    found = collections.defaultdict(list)
    for r in neighbours.nearest(df).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    assert found[0] == [(1, 1, 1.0), (2, 20, 1.0), (3, 2, 0.0), (4, 60, -3.0)]
    assert found[20] == [(1, 0, 1.0), (2, 1, 1.0), (3, 2, 0.0), (4, 60, -3.0)]
    assert found[60] == [(1, 2, 2.0), (2, 0, -3.0), (3, 1, -3.0), (4, 20, -3.0)]
    assert set(found) == {0, 20, 60} and neighbours.nearest(df.limit(0)).collect() == []


def test_neighbours_of_many_copies(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, [0.5] * 8) for i in range(400)] + [(i, rng.standard_normal(8).tolist()) for i in range(400, 900)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    rows = collections.defaultdict(list)
    for r in neighbours.nearest(df).orderBy("query_id", "rank").collect():
        rows[r.query_id].append(r.vec_id)
    x = np.array([v for _, v in vectors])
    hits = 0
    for q, got in rows.items():
        s = sum(x[:, d] * x[q, d] for d in range(8))
        want = [i for i in sorted(range(900), key=lambda i: (-s[i], i)) if i != q][:20]
        hits += len(set(want) & set(got))
    assert len(rows) == 45 and hits >= 0.9 * 45 * 20


def test_url_filter(spark):
    urls = [
        None, "", "no scheme/x", "http://A.Org/x?y", "http://org", "https://sub.example.org/es/1", "x://example.org/en/12#a",
        "http://freecasino.example.net/en/1", "http://thing.example.net/en/1", "http://a.com/de/", "http://b.com/fr/://c", "http:///", "http://" + "z" * 3000,
        "http://free-casino.example.net/en/2", "http://thing.example.net/en/1",
    ]
    df = spark.createDataFrame(
        [(i, u, "<p>thing free things</p>" if u else None, 1, "w") for i, u in enumerate(urls)],
        "page_id bigint, url string, html string, n int, word string",
    )
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judged(df).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.org", "/x", "org/", "allow") and got[4] == ("org", "", None, "allow")
    assert got[5][2:] == ("example.org/es/", "block") and got[6][2:] == ("example.org/en/1", "block")
    assert got[7][3] == "block" and got[8][3] == "allow" and got[13][3] == "block"
    assert got[9][2:] == ("com/de/", "block") and got[10] == ("b.com", "/fr/://c", "com/fr/", "allow")
    assert len(got) == len(urls) and url_filter.judged(df.limit(0)).collect() == []


def test_viterbi_against_all_splits():
    scores = {"ab": -2.0, "abc": -2.5, "c": -9.0, "cd": -1.0, "d": -3.0, "bcd": -2.2}
    for run in ("abcd", "abccd", "dab", "xyz", "abxcd"):
        found = [(i, j) for i in range(len(run)) for j in range(i + 1, len(run) + 1) if run[i:j] in scores]
        best = url_filter.split_best(run, [i for i, _ in found], [j for _, j in found], [scores[run[i:j]] for i, j in found], -20.0)

        def every(rest):
            if not rest:
                yield 0.0, []
            for n in range(1, len(rest) + 1):
                if rest[:n] in scores or n == 1:
                    for p, words in every(rest[n:]):
                        yield max(scores.get(rest[:n], -99), -20.0 if n == 1 else -99) + p, [rest[:n], *words]

        def score(words):
            return sum(scores.get(w, -20.0 * len(w)) for w in words)

        assert "".join(best) == run and score(best) == max(p for p, _ in every(run))


def test_licenses(spark, docs, empty):
    texts = [
        "Words. Released under the MIT License. More.", "released UNDER the (MIT) license", "Released under the MIT",
        "This work is licensed under the GNU General Public License, version 3.", None, "", "under the GNU General Public License version 3 it is",
    ]
    rows = spark.createDataFrame([(i, t, 3, "w") for i, t in enumerate(texts)], "doc_id bigint, text string, found int, _w string")
    got = {r.doc_id: r.licenses for r in licenses.license_report(rows).collect()}
    assert got == {0: "mit:1/1@1", 1: "mit:1/1@0", 2: "", 3: "gpl-3.0:8/8@0", 4: "", 5: "", 6: ""}
    assert licenses.license_report(docs).count() == len(CASES) and licenses.license_report(empty).collect() == []


def test_bpe(docs, empty):
    content = vocabulary()
    rows = _by_id(bpe.encode_decode(docs, content).collect())
    assert rows[3][0].ids == [] and rows[3][0].text == "" and len(rows[7]) == 2
    apart = _by_id(bpe.decode(bpe.encode(docs, content), content).collect())
    assert {k: sorted(r.text for r in v) for k, v in apart.items()} == {k: sorted(r.text for r in v) for k, v in rows.items()}
    assert bpe.encode(empty, content).collect() == [] and bpe.encode_decode(empty, content).collect() == []


def test_scan_and_heap_merge_alike():
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = bpe.Tokenizer(vocabulary())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for _ in range(300):
        word = "".join(random.choices("aeinrst'é1!", k=random.randint(1, 150)))
        parts = [tokenizer._letters[b] for b in word.encode()]
        assert bpe.scan_merge(list(parts), tokenizer.ranks) == bpe.heap_merge(list(parts), tokenizer.ranks)
        text = f" {word}\u2003İ Σας\x1f<|startoftext|>e\u0301\t{word.upper()}"
        ids = library.encode(text, add_special_tokens=False).ids
        assert tokenizer.encode(text).tolist() == ids
        assert tokenizer.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_line_dedup(docs, empty, spark):
    rows = _by_id(line_dedup.line_report(docs).collect())
    assert rows[1][0].n_removed == 0 and [r.removed_lines for r in rows[7]] == ["0,1", "0,1"]
    assert rows[10][0].n_removed == 4 and rows[3][0].n_lines == 0
    assert line_dedup.line_report(empty).collect() == []
    kept = line_dedup.without_repeats(docs)
    assert kept.columns == docs.columns and 10 not in {r.doc_id for r in kept.collect()}
    line = " ".join(["w"] * 20)
    own = spark.createDataFrame([(1, "\n".join([line] * 6)), (2, "x\n" + "\n\n".join([line] * 2) + "\ny")], "doc_id bigint, text string")
    got = {r.doc_id: r.removed_lines for r in line_dedup.line_report(own).collect()}
    assert got == {1: "1,2,3,4,5", 2: ""}


def test_sharding(docs, empty, spark):
    rows = sharding.shard_documents(docs).collect()
    assert len(rows) == len(CASES) and sharding.shard_documents(empty).collect() == []
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    same = spark.createDataFrame([(7, "one text")] * 4000 + [(None, None)] * 4000, "doc_id bigint, text string")
    sizes = collections.Counter()
    for r in sharding.shard_documents(same.repartition(5)).collect():
        sizes[r.shard] += r.size
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 2 * 0.001 * sum(sizes.values()) / 40 * 2 + 48


def test_ranked_is_a_total_order(spark):
    rows = spark.range(1000).selectExpr("(id * 7919) % 1000 as v", "id")
    got = ranked(rows, ["v"]).collect()
    assert all(r.rank == r.v for r in got)


def test_word_hashes_split_like_words():
    import pyarrow as pa

    texts = ["a B  c", None, "", " x\ty\x0bz ", "no\xa0break", "b"]
    words = [list(textarrays.grams(w, 1)) for _, data, offsets in textarrays.chunks(pa.array(texts)) for h, b in [textarrays.word_hashes(data, offsets)] for w in [h[b[i]:b[i + 1]] for i in range(len(texts))]]
    assert [len(w) for w in words] == [3, 0, 0, 3, 1, 1] and words[0][1] == words[5][0]


def test_pipeline_stages(spark, docs, tmp_path):
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, "")
        rows.write.parquet(str(tmp_path / name))
        rows = spark.read.parquet(str(tmp_path / name))
        assert name == "bpe" or rows.columns == docs.columns
    assert {r.doc_id for r in spark.read.parquet(str(tmp_path / "near_dedup")).collect()} == {1, 2, 8}
    assert {r.doc_id for r in rows.collect()} <= {1, 2, 8} and rows.agg({"n_tokens": "sum"}).first()[0] > 1000


def test_licenses_in_other_words(spark):
    gnu = "you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    texts = {
        "This tool is licensed under the MIT License, see below.": ["mit"],
        "It is distributed under the MIT licence by us.": ["mit"],
        "This program is free software: " + gnu.format("", "3"): ["gpl-3.0"],
        "This library is free software; " + gnu.format("", "2"): ["gpl-2.0"],
        "This one is free too: " + gnu.format("Affero ", "3"): ["agpl-3.0"],
        "The files are released under the GNU General Public License version 2.": ["gpl-2.0"],
        "The files are released under the GNU General Public License v3.0 today.": ["gpl-3.0"],
        "Code available under the Apache License, Version 2.0 (the License).": ["apache-2.0"],
        "All pictures are shared under CC BY-NC 4.0 by the author.": ["cc-by-nc-4.0"],
        "under the Creative Commons Attribution-NonCommercial 4.0 International licence": ["cc-by-nc-4.0"],
        # One word of the first passage is changed; the next passage is whole.
        "Permission is hereby given, free of charge, to any person getting a copy of this software, to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense": ["mit-text"],
        "Redistribution and reuse in source or binary form is fine. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.": ["bsd"],
        "The terms of the sale are published by the seller, either version will do.": [],
        "Nobody was released under the general license of the house.": [],
    }
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: [m.name for m in r.matches] for r in licenses.scan(rows).collect()}
    assert {t: got[i] for i, t in enumerate(texts)} == texts


def test_splits_do_not_depend_on_table_size(spark):
    runs = spark.createDataFrame([("slotsun",), ("unpoker",)], "run string")
    names = spark.createDataFrame([], "host string, path string")
    for size in (1, 3000):
        pages = spark.range(size).selectExpr("'<p>slot sun un</p>' as html")
        got = {r.run: r.words for r in url_filter.segmented(runs, url_filter.word_counts(pages, names)).collect()}
        assert got == {"slotsun": ["slot", "sun"], "unpoker": ["un", "poker"]}


def test_long_words_stay_whole(spark):
    word = "donaudampfschifffahrtsgesellschaft"
    pages = spark.createDataFrame([(f"<p>{word} donau dampf schiff fahrt gesellschaft {word}</p>",)], "html string")
    names = spark.createDataFrame([], "host string, path string")
    inside, both = word + "casino", "dampf" + word + word
    runs = spark.createDataFrame([(word,), ("donaudampf",), (inside,), (both,)], "run string")
    got = {r.run: r.words for r in url_filter.segmented(runs, url_filter.word_counts(pages, names)).collect()}
    assert got == {
        word: [word], "donaudampf": ["donau", "dampf"], inside: [word, "casino"], both: ["dampf", word, word],
    }
