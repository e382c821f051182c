"""URL verdicts recomputed in plain Python over the whole pages table: counts, splits, weights, scores."""

import collections
import functools
import math
import os
from pathlib import Path

import duckdb
import pytest
import regex

from dqgate.llm import url_filter
from dqgate.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TAGS = regex.compile(r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>")
RUN, PART = regex.compile(r"\p{L}+"), regex.compile(r"\p{L}+|\p{N}+")
SHARE = 0.001
UNWANTED = set(url_filter.UNWANTED)

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def _taken_apart(url):
    if not url or "://" not in url:
        return "", ""
    rest = regex.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def _rule(host, path):
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)) if fits else None


def _counts(pages, pairs):
    n = collections.Counter()
    for _, html in pages:
        n.update(RUN.findall(TAGS.sub(" ", html or "").lower()))
    for host, path in pairs:
        for label in host.split("."):
            if "-" in label:
                n.update(RUN.findall(label.lower()))
        n.update(RUN.findall(path.lower()))
    return {w: k for w, k in n.items() if len(w) >= 2} | {w: n[w] for w in UNWANTED}


def _splitter(counts):
    total = sum(counts.values())
    unknown = -math.log(10 * total)

    def log_p(word):
        return math.log((counts[word] / total + (SHARE if word in UNWANTED else 0)) / (1 + SHARE * len(UNWANTED)))

    @functools.cache
    def split(run):
        @functools.cache
        def best(end):
            """Score and words of the first ``end`` letters; a word that is not known is marked by ``?``."""
            if end == 0:
                return 0.0, ()
            score, words = best(end - 1)
            last = words[-1] + run[end - 1] if words and words[-1][0] == "?" else "?" + run[end - 1]
            top = (score + unknown, (*(words[:-1] if len(last) > 2 else words), last))
            for start in range(end - 1):
                if run[start:end] in counts:
                    score, words = best(start)
                    score += log_p(run[start:end])
                    if score > top[0]:
                        top = score, (*words, run[start:end])
            return top

        return [w.removeprefix("?") for w in best(len(run))[1]]

    return split


def test_every_verdict_by_hand(spark):
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{SF_DIR}/pages.parquet'").fetchall()
    named = [(page_id, *_taken_apart(url)) for page_id, url, _ in pages]
    pairs = collections.Counter((host, path) for _, host, path in named)
    split = _splitter(_counts([p[1:] for p in pages], pairs))

    def words(host, path):
        of_path = ["0" if w[0].isnumeric() else w for w in PART.findall(path.lower())]
        return [w for run in RUN.findall(host.lower()) for w in split(run)] + of_path

    said = {pair: words(*pair) for pair in pairs}
    examples, seen = collections.Counter(), {True: collections.Counter(), False: collections.Counter()}
    for pair, n in pairs.items():
        block = bool(UNWANTED.intersection(said[pair]))
        examples[block] += n
        for word in said[pair]:
            seen[block][word] += n
    size = len({*seen[True], *seen[False]})
    room = {block: sum(seen[block].values()) + size + 1 for block in seen}
    prior = math.log((examples[True] + 1) / (examples[False] + 1))
    weight = {
        w: math.log((seen[True][w] + 1) / room[True]) - math.log((seen[False][w] + 1) / room[False])
        for w in {*seen[True], *seen[False]}
    }
    got = {r.page_id: r for r in QUERIES["op6_url_filter"](spark, SF_DIR).collect()}
    assert len(got) == len(pages) and examples[True] and examples[False]
    for page_id, host, path in named:
        row, rule = got[page_id], _rule(host, path)
        score = prior + sum(weight[w] for w in said[host, path])
        learned = "block" if score > 0 and (host or path) else "allow"
        assert (row.host, row.path, row.rule) == (host, path, rule.name if rule else None)
        assert abs(row.score - score) < 1e-6, (host, said[host, path])
        assert row.verdict == (rule.verdict if rule else learned), (host, path, score)
