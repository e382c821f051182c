"""URL filters: host names split into words by unigram Viterbi, judged by naive Bayes.

Host and path rules come first; the longest one that fits decides.  All other urls are
judged by their words: host names run words together, so each run of letters is split
into the words that are most probable by their counts in the pages.  A multinomial naive
Bayes model scores the words of host and path.  It is fitted on the pages themselves:
one that has an unwanted word among its words is an example to block, every other one an
example to allow.

Hosts and paths are taken apart once each, however many pages have them, and scores are
joined back.  Word counts stay distributed: a run of letters asks only for the counts of
its own substrings, up to ``MAX_WORD`` letters or as long as a longer word of the pages; it is
split within one row.

Defined results: NULL url or one without ``://`` has an empty host and path and is
allowed unless its words say otherwise (it has none); rows with equal or NULL page_id
are judged one by one; rules of equal length go by name; equal scores allow; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dqgate.llm.common import lower_ascii, written

#: Substrings of every length up to this are looked up; of longer ones, those as long as a word of the pages.
MAX_WORD = 20


@dataclass(frozen=True)
class Rule:
    """``path`` begins with a slash; the rule fits ``host`` and its subdomains."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
#: Words that make a page an example to block.
UNWANTED = (
    "adult", "ads", "bet", "bets", "betting", "casino", "escort", "gambling", "hentai", "malware",
    "phishing", "pills", "poker", "porn", "sex", "slots", "spam", "viagra", "warez", "xxx",
)
#: Share of all words that each unwanted word has beside its own count, whatever the size of the table.
LEXICON_SHARE = 0.001


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, path`` of each row of ``pages``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return pages.select("page_id", "url", F.coalesce(rest, F.lit("")).alias("_rest")).select(
        "page_id", "url",
        lower_ascii(F.regexp_extract("_rest", r"^[^/?#]*", 0)).alias("host"),
        F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def rule_of(rules: Sequence[Rule], value: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits ``host`` and ``path``; else NULL."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        chosen = F.when(fits & F.col("path").startswith(rule.path), getattr(rule, value)).otherwise(chosen)
    return chosen


def runs_of_letters(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def path_words(path: Column) -> Column:
    """Letter runs of a path, with ``0`` for every number."""
    return F.transform(
        F.regexp_extract_all(F.lower(path), F.lit(r"\p{L}+|\p{N}+"), F.lit(0)),
        lambda w: F.when(w.rlike(r"^\p{N}"), "0").otherwise(w),
    )


def word_counts(pages: DataFrame, names: DataFrame) -> DataFrame:
    """``word, n``: how often words occur in the pages' text, in paths and between hyphens.

    A host name without hyphens may be several words run together, so it is no evidence
    of one.  Words of two letters at least; single letters make any split possible and say nothing.
    """
    text = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " ")
    said = pages.select(F.explode(runs_of_letters(text)).alias("word"))
    apart = F.array_join(F.regexp_extract_all("host", F.lit(r"[^.]*-[^.]*"), F.lit(0)), ".")
    parts = names.select(F.explode(F.concat(runs_of_letters(apart), runs_of_letters(F.col("path")))).alias("word"))
    lexicon = F.explode(F.array(*[F.lit(w) for w in UNWANTED]))
    counted = said.unionByName(parts).groupBy("word").agg(F.count("*").alias("n"))
    # Not said by any page, they count by their share; see segmented.
    extra = pages.sparkSession.range(1).select(lexicon.alias("word"), F.lit(0).cast("long").alias("n"))
    return (
        counted.unionByName(extra).where(F.length("word") >= 2).groupBy("word").agg(F.sum("n").alias("n"))
    )


def split_best(run: str, starts: Sequence[int], ends: Sequence[int], scores: Sequence[float], unknown: float) -> list[str]:
    """The most probable split of ``run``: Viterbi over the words found in it.

    A letter that no word covers becomes part of an unknown word, whose log probability
    is ``unknown`` for each letter.
    """
    arriving: list[list[tuple[int, float]]] = [[] for _ in range(len(run) + 1)]
    for s, e, p in zip(starts, ends, scores):
        arriving[e].append((s, p))
    best = np.full(len(run) + 1, -np.inf)
    best[0], back = 0.0, [0] * (len(run) + 1)
    known = [True] * (len(run) + 1)
    for end in range(1, len(run) + 1):
        best[end], back[end], known[end] = best[end - 1] + unknown, end - 1, False
        for start, score in arriving[end]:
            if best[start] + score > best[end]:
                best[end], back[end], known[end] = best[start] + score, start, True
    words, at, loose = [], len(run), ""
    while at > 0:
        piece = run[back[at] : at]
        if known[at]:
            if loose:
                words.append(loose)
            words.append(piece)
            loose = ""
        else:
            loose = piece + loose
        at = back[at]
    if loose:
        words.append(loose)
    return words[::-1]


def segmented(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """``run, words`` for each distinct ``run`` of letters."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    prior = F.when(F.col("word").isin(*UNWANTED), LEXICON_SHARE).otherwise(0.0)
    part = (F.col("n") / float(total) + prior) / (1 + LEXICON_SHARE * len(UNWANTED))
    cut = F.explode(F.sequence(F.lit(1), F.length("run")))
    size = F.explode(F.sequence(F.lit(2), F.least(F.lit(MAX_WORD), F.length("run") - F.col("s") + 1)))
    parts = (
        runs.select("run", cut.alias("s"))
        .where(F.length("run") > F.col("s"))
        .select("run", "s", size.alias("z"))
        .select("run", (F.col("s") - 1).alias("s"), (F.col("s") - 1 + F.col("z")).alias("e"),
                F.expr("substring(run, s, z)").alias("word"))
    )
    # Longer words: substrings of those lengths only that some such word has.
    longest = runs.agg(F.max(F.length("run"))).first()[0] or 0
    lengths = counts.select(F.length("word").alias("z")).where(F.col("z").between(MAX_WORD + 1, longest)).distinct()
    more = sorted(row["z"] for row in lengths.collect())  # no more than the longest run has letters
    if more:
        fits = F.filter(F.lit(more), lambda z: z <= F.length("run") - F.col("s") + 1)
        longer = runs.where(F.length("run") > MAX_WORD).select("run", cut.alias("s")).select("run", "s", F.explode(fits).alias("z"))
        parts = parts.unionByName(
            longer.select("run", (F.col("s") - 1).alias("s"), (F.col("s") - 1 + F.col("z")).alias("e"),
                          F.expr("substring(run, s, z)").alias("word"))
        )
    found = parts.join(counts, "word").select(
        "run", F.struct("s", "e", F.log(part).alias("p")).alias("_m")
    )
    lists = found.groupBy("run").agg(F.sort_array(F.collect_list("_m")).alias("m"))
    rows = runs.join(lists, "run", "left").select("run", "m")
    unknown = -np.log(10.0 * total) if total > 1 else -10.0

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for run, found in zip(batch.column("run").to_pylist(), batch.column("m").to_pylist()):
                found = found or []
                words.append(split_best(run, *([f[k] for f in found] for k in ("s", "e", "p")), unknown))
            yield pa.RecordBatch.from_arrays(
                [batch.column("run"), pa.array(words, pa.list_(pa.string()))], names=["run", "words"]
            )

    return rows.mapInArrow(split, "run string, words array<string>")


def words_of_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``host, words`` for each distinct ``host``."""
    runs = hosts.select("host", F.explode(runs_of_letters(F.col("host"))).alias("run"))
    words = segmented(runs.select("run").distinct(), counts)
    joined = runs.join(words, "run").groupBy("host").agg(F.flatten(F.collect_list("words")).alias("words"))
    return hosts.join(joined, "host", "left").select("host", F.coalesce("words", F.array().cast("array<string>")).alias("words"))


def _unwanted(words: Column) -> Column:
    return F.arrays_overlap(words, F.array(*[F.lit(w) for w in UNWANTED]))


def word_weights(groups: DataFrame) -> tuple[DataFrame, float]:
    """``word, weight`` (log odds to block) and the prior's, from ``host_words, path_words, n``.

    ``groups`` has a row for each host and path that occur together, with the pages.
    """
    every = F.concat("host_words", "path_words")
    labelled = groups.select(every.alias("words"), "n", _unwanted(every).alias("block"))
    counts = labelled.select(F.explode("words").alias("word"), "n", "block").groupBy("word").agg(
        F.sum(F.when(F.col("block"), F.col("n")).otherwise(0)).alias("b"),
        F.sum(F.when(F.col("block"), 0).otherwise(F.col("n"))).alias("a"),
    )
    counts = written(counts)
    sums = counts.agg(F.sum("b"), F.sum("a"), F.count("*")).first()
    blocked, allowed, size = (float(x or 0) for x in sums)
    pages = labelled.agg(F.sum(F.when(F.col("block"), F.col("n"))), F.sum(F.when(~F.col("block"), F.col("n")))).first()
    prior = float(np.log(((pages[0] or 0) + 1) / ((pages[1] or 0) + 1)))
    weight = F.log((F.col("b") + 1) / (blocked + size + 1)) - F.log((F.col("a") + 1) / (allowed + size + 1))
    return counts.select("word", weight.alias("weight")), prior


def _scores(rows: DataFrame, key: str, words: str, weights: DataFrame) -> DataFrame:
    """``key, score``: the sum of the weights of each row's words."""
    each = rows.select(key, F.explode(words).alias("word")).groupBy(key, "word").agg(F.count("*").alias("_n"))
    summed = each.join(weights, "word").groupBy(key).agg(F.sum(F.round(F.col("weight") * F.col("_n"), 9).cast("decimal(28,9)")).alias("score"))
    return summed.withColumn("score", F.col("score").cast("double"))


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for each row of ``pages`` (page_id, url, html)."""
    named = with_host_and_path(pages)
    pairs = written(named.groupBy("host", "path").agg(F.count("*").alias("n")))
    counts = written(word_counts(pages, pairs))
    hosts = written(words_of_hosts(pairs.select("host").distinct(), counts))
    paths = pairs.select("path").distinct().withColumn("path_words", path_words(F.col("path")))
    groups = pairs.join(hosts.withColumnRenamed("words", "host_words"), "host").withColumn(
        "path_words", path_words(F.col("path"))
    )
    weights, prior = word_weights(groups)
    host_scores = written(_scores(hosts, "host", "words", weights)).withColumnRenamed("score", "host_score")
    path_scores = written(_scores(paths, "path", "path_words", weights)).withColumnRenamed("score", "path_score")
    score = F.lit(prior) + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("path_score", F.lit(0.0))
    scored = named.join(host_scores, "host", "left").join(path_scores, "path", "left").withColumn("score", score)
    learned = F.when(F.col("score") > 0, "block").otherwise("allow")
    learned = F.when((F.col("host") == "") & (F.col("path") == ""), "allow").otherwise(learned)
    return scored.select(
        "page_id", "host", "path", rule_of(rules, "name").alias("rule"),
        F.coalesce(rule_of(rules, "verdict"), learned).alias("verdict"), "score",
    )
