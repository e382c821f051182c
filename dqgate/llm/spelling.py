"""Spelling variants: frequent words and the rare ones an edit away, found with a bidirectional FM-index.

Words at distance one (an inserted, deleted or replaced code point) share one half exactly:
the first half if the edit lies in the second, and the other way round.  The vocabulary,
each word between delimiters, is indexed in both directions: for every string there is the
interval of ranks of the suffixes that begin with it, and that of the reversed suffixes, and
a code point can be added at either end.  A search matches one half exactly, outwards from
the middle to the delimiter, and then extends across the other half, allowing one error.

The index is cut into shards of ``SHARD_WORDS`` words, twice: in the order of the words,
searched by first halves, and in the order of the reversed words, searched by last halves.  A
half is the beginning of adjacent words, so a word is searched in its own shard, and in others
only where the words with that half go on there.  Words next to a shard's own
are sent in blocks of ``VISITORS``.

A word has at most (2 * length + 1) * letters words at distance one, which bounds every
group that is gathered by word.  A form is at least ``ratio`` times as frequent as what it is a form of, so chains
of forms are as short as the logarithm of the greatest count.

Memory of a task follows its shard: about 100 bytes a code point, so a vocabulary word of many MB is
beyond it; texts may be as long as they like.

Defined results: NULL text has no words; a NULL doc_id counts as empty text in the hash that
picks damaged runs; rows with equal ids and texts count like any others; of equally
frequent near words the first in code-point order is the form; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dqgate.llm.common import lower_ascii, ranked, written

#: Words of an index shard.
SHARD_WORDS = 16384
#: Words of other shards that are searched in a shard by one task.
VISITORS = 1 << 17
#: Ranks between counts that are kept; the rest is counted when asked for.
STRIDE = 64
#: Searches extended together.
TOGETHER = 1 << 15


@dataclass(frozen=True)
class Spelling:
    """Words of at least ``min_length`` code points and ``min_count`` occurrences; forms are ``ratio`` times as frequent."""

    min_length: int = 7
    min_count: int = 2
    ratio: int = 10


# -- words --------------------------------------------------------------------


def long_runs(docs: DataFrame, spelling: Spelling = Spelling()) -> DataFrame:
    """``doc_id`` (text) and ``run``: the letter runs of at least ``min_length``, with A-Z as a-z.

    Shorter runs cannot become words and are not taken out of the texts at all.
    """
    letters = rf"[A-Za-zÀ-ÿ]{{{spelling.min_length},}}"
    found = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(letters), F.lit(0))
    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(found).alias("run"))


def damaged(doc_id: Column, run: Column, every: int = 31) -> Column:
    """``run`` without one code point where the hash of ``doc_id:run`` is divisible by ``every``."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(every)) == 0, without).otherwise(run)


def vocabulary(words: DataFrame, spelling: Spelling = Spelling()) -> DataFrame:
    """``word, n`` of the words (one ``word`` a row) that are long and frequent enough."""
    counted = words.where(F.length("word") >= spelling.min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= spelling.min_count)


# -- index --------------------------------------------------------------------


def _suffix_order(text: np.ndarray, ties: int, longest: int) -> np.ndarray:
    """Positions of a cyclic text in the order of what follows; symbols below ``ties`` occur once."""
    rank = text.astype(np.int64)
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        key = rank * (len(text) + ties + 1) + np.roll(rank, -step)
        order = np.argsort(key, kind="stable")
        placed = key[order]
        rank = np.empty_like(rank)
        rank[order] = np.concatenate(([0], np.cumsum(placed[1:] != placed[:-1])))
        step *= 2
        if step > longest or rank[order[-1]] == len(text) - 1:
            return order


class Direction:
    """Ranks in one direction: what comes before each suffix, and counts of that."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, longest: int) -> None:
        """``symbols`` are words in order, each after a 0 at ``starts``; letters are 1 and up."""
        words = len(starts)
        marked = symbols.astype(np.int64) + words
        marked[starts] = np.arange(words)  # a delimiter ranks as the word after it
        order = _suffix_order(marked, words + int(symbols.max(initial=0)), longest)
        before = symbols[order - 1]
        self.letters = int(symbols.max(initial=0))
        counts = np.bincount(symbols, minlength=self.letters + 2)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        blocks = len(before) // STRIDE + 1
        padded = np.full(blocks * STRIDE, self.letters + 1, dtype=symbols.dtype)
        padded[: len(before)] = before
        self.rows = padded.reshape(blocks, STRIDE)
        self.before = before
        # Symbols below each letter, before each block.
        cell = np.repeat(np.arange(blocks), STRIDE) * (self.letters + 2) + padded
        each = np.bincount(cell, minlength=blocks * (self.letters + 2)).reshape(blocks, -1)
        below = np.cumsum(each, axis=1) - each
        self.below = (np.cumsum(below, axis=0) - below).astype(np.int32)
        self.equal = (np.cumsum(each, axis=0) - each).astype(np.int32)

    def counts(self, letter: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols below ``letter``, and equal to it, before ``rank``."""
        block, inside = rank // STRIDE, rank % STRIDE
        rows = self.rows[block]
        counted = np.arange(STRIDE) < inside[:, None]
        below = ((rows < letter[:, None]) & counted).sum(axis=1)
        equal = ((rows == letter[:, None]) & counted).sum(axis=1)
        return self.below[block, letter] + below, self.equal[block, letter] + equal


@dataclass
class Found:
    """Intervals: ``lo`` in the direction that is extended, ``other`` in the opposite one, and ``size``."""

    lo: np.ndarray
    other: np.ndarray
    size: np.ndarray

    def take(self, rows: np.ndarray) -> Found:
        return Found(self.lo[rows], self.other[rows], self.size[rows])

    def turned(self) -> Found:
        return Found(self.other, self.lo, self.size)


def extended(direction: Direction, found: Found, letter: np.ndarray) -> Found:
    """The strings of ``found`` with one more symbol at the end that ``direction`` extends."""
    below_lo, lo = direction.counts(letter, found.lo)
    below_hi, hi = direction.counts(letter, found.lo + found.size)
    return Found(direction.first[letter] + lo, found.other + (below_hi - below_lo), hi - lo)


class Index:
    """A shard of the vocabulary, indexed in both directions."""

    def __init__(self, words: list[str]) -> None:
        self.words = sorted(words)
        points, lengths = code_points(self.words)
        self.alphabet = np.unique(points)
        longest = int(lengths.max(initial=0)) + 1
        coded = np.searchsorted(self.alphabet, points) + 1
        self.dtype = np.uint8 if len(self.alphabet) < 250 else np.int32
        # Extends to the left: ranks of suffixes.  Extends to the right: ranks of reversed suffixes.
        self.left = self._direction(coded, lengths, longest)
        backwards = sorted(range(len(self.words)), key=lambda i: self.words[i][::-1])
        points, lengths = code_points([self.words[i][::-1] for i in backwards])
        self.right = self._direction(np.searchsorted(self.alphabet, points) + 1, lengths, longest)

    def _direction(self, coded: np.ndarray, lengths: np.ndarray, longest: int) -> Direction:
        starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])).astype(np.int64)
        symbols = np.zeros(len(coded) + len(lengths), dtype=self.dtype)
        inside = np.ones(len(symbols), dtype=bool)
        inside[starts] = False
        symbols[inside] = coded
        return Direction(symbols, starts, longest)

    def code(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; one that no word of the shard has is one too high."""
        at = np.searchsorted(self.alphabet, points)
        known = at < len(self.alphabet)
        known[known] = self.alphabet[at[known]] == points[known]
        return np.where(known, at + 1, len(self.alphabet) + 1)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words in a row, and the length of each word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    return points, np.array([len(w) for w in words], dtype=np.int64)


# -- search -------------------------------------------------------------------


def near_words(index: Index, words: list[str], first_half: bool) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, number of the index's word) for pairs at distance one.

    ``first_half`` finds those that have the first half of the word exactly, else those that have
    the last half, whether or not they have the first one too.
    """
    pairs = [_near(index, words[i : i + TOGETHER], first_half, i) for i in range(0, len(words), TOGETHER)]
    return tuple(np.concatenate(c) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2


def _near(index: Index, words: list[str], first_half: bool, base: int) -> tuple[np.ndarray, np.ndarray]:
    points, lengths = code_points(words)
    symbols = index.code(points)
    begin = np.cumsum(lengths) - lengths
    half = lengths // 2
    out, back = (index.left, index.right) if first_half else (index.right, index.left)
    inwards = -1 if first_half else 1
    # From the middle out to the delimiter, exactly.
    exact, rest = (half, lengths - half) if first_half else (lengths - half, half)
    middle = begin + half - (1 if first_half else 0)
    total = len(index.left.before)
    alive = np.arange(len(words))
    found = Found(*(np.full(len(words), v, dtype=np.int64) for v in (0, 0, total)))
    ended: list[tuple[np.ndarray, Found]] = []
    for t in range(int(exact.max(initial=0)) + 1):
        end = exact[alive] == t
        letter = np.where(end, 0, symbols[np.minimum(middle[alive] + inwards * np.where(end, 0, t), len(symbols) - 1)])
        found, alive, kept = _step(out, found, alive, letter)
        end = end[kept]
        ended.append((alive[end], found.take(end)))
        found, alive = found.take(~end), alive[~end]
        if not len(alive):
            break
    word = np.concatenate([a for a, _ in ended])
    clean = Found(*(np.concatenate([getattr(f, n) for _, f in ended]) for n in ("lo", "other", "size"))).turned()

    # Across the other half, from the middle, with one error.
    at0 = middle - inwards
    failed: list[tuple[np.ndarray, Found]] = []  # one error made, waiting at pattern position t
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    nothing = np.zeros(0, dtype=np.int64), Found(*(np.zeros(0, dtype=np.int64),) * 3)
    later = nothing
    for t in range(int(rest.max(initial=0)) + 1):
        due, after = [later], []
        # Symbols of the pattern here; 0, the delimiter, at its end.
        here = _symbol(symbols, at0, inwards, t, rest, word)
        if len(word):
            row, letter, child = _children(back, clean)
            differs = letter != here[row]
            inserted = differs & (letter != 0)
            due.append((word[row[inserted]], child.take(inserted)))
            replaced = inserted & (here[row] != 0)
            after.append((word[row[replaced]], child.take(replaced)))
            # Of a run of equal letters, the last one is deleted.
            gone = (here != 0) & (here != _symbol(symbols, at0, inwards, t + 1, rest, word))
            after.append((word[gone], clean.take(gone)))
            same = ~differs & (here[row] != 0)
            word, clean = word[row[same]], child.take(same)
        # One error behind: only exact steps, and a hit at the delimiter.
        owner, wrong = _joined(due)
        if len(owner):
            letter = _symbol(symbols, at0, inwards, t, rest, owner)
            wrong, owner, kept = _step(back, wrong, owner, letter)
            end = letter[kept] == 0
            hits.append((owner[end], (wrong.other if first_half else wrong.lo)[end]))
            after.append((owner[~end], wrong.take(~end)))
        later = _joined(after) if after else nothing
        if not len(word) and not len(later[0]):
            break
    owner, target = (np.concatenate(c) for c in zip(*hits)) if hits else (nothing[0], nothing[0])
    return owner + base, target


def _symbol(symbols: np.ndarray, at0: np.ndarray, inwards: int, t: int, rest: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The symbol at position ``t`` of each word's other half, 0 beyond its end."""
    at = at0[word] - inwards * t
    return np.where(t < rest[word], symbols[np.clip(at, 0, max(len(symbols) - 1, 0))] if len(symbols) else 0, 0)


def _joined(parts: list[tuple[np.ndarray, Found]]) -> tuple[np.ndarray, Found]:
    owner = np.concatenate([o for o, _ in parts])
    return owner, Found(*(np.concatenate([getattr(f, n) for _, f in parts]) for n in ("lo", "other", "size")))


def _step(direction: Direction, found: Found, owner: np.ndarray, letter: np.ndarray) -> tuple[Found, np.ndarray, np.ndarray]:
    """Extended by one symbol each: the intervals left, their owners, and which they were."""
    known = letter <= direction.letters
    found, owner, letter, was = found.take(known), owner[known], letter[known], np.flatnonzero(known)
    # Many words have the same half: each interval is extended once.
    key = (found.lo * (direction.letters + 1) + letter) * (len(direction.before) + 1) + found.size
    _, one, back = np.unique(key, return_index=True, return_inverse=True)
    step = extended(direction, found.take(one), letter[one])
    new = Found(step.lo[back], found.other + (step.other - found.other[one])[back], step.size[back])
    left = new.size > 0
    return new.take(left), owner[left], was[left]


def _children(direction: Direction, found: Found) -> tuple[np.ndarray, np.ndarray, Found]:
    """(row, symbol, interval) for every symbol that extends the strings of ``found``."""
    key = found.lo * (len(direction.before) + 1) + found.size
    _, one, back = np.unique(key, return_index=True, return_inverse=True)
    lo, size = found.lo[one], found.size[one]
    # Symbols in small intervals are looked up, for large ones all are tried.
    small = np.flatnonzero(size <= direction.letters + 1)
    large = np.flatnonzero(size > direction.letters + 1)
    lengths = size[small]
    entry = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths - lo[small], lengths)
    width = direction.letters + 1
    pair = np.unique(np.repeat(small, lengths) * width + direction.before[entry])
    tried = (large[:, None] * width + np.arange(width)).ravel()
    pair = np.concatenate([pair, tried])
    node, letter = pair // width, pair % width
    child = extended(direction, Found(lo[node], np.zeros(len(node), dtype=np.int64), size[node]), letter)
    used = child.size > 0
    order = np.argsort(node[used], kind="stable")
    node, letter, child = node[used][order], letter[used][order], child.take(used).take(order)
    # Every string has the children of its interval.
    begins = np.searchsorted(node, np.arange(len(one) + 1))
    number = np.diff(begins)[back]
    row = np.repeat(np.arange(len(back)), number)
    of = np.arange(len(row)) - np.repeat(np.cumsum(number) - number - begins[back], number)
    return row, letter[of], Found(child.lo[of], found.other[row] + child.other[of], child.size[of])


# -- jobs ---------------------------------------------------------------------


def sharded(words: DataFrame, backwards: bool) -> DataFrame:
    """``word, n, shard``: adjacent words, or words adjacent when reversed, by shards of ``SHARD_WORDS``; written."""
    keyed = words.withColumn("_key", F.reverse("word") if backwards else F.col("word"))
    return written(
        ranked(keyed, ["_key"], "_at").select("word", "n", F.floor(F.col("_at") / SHARD_WORDS).cast("int").alias("shard"))
    )


def visitors(shards: DataFrame, backwards: bool) -> DataFrame:
    """``shard, word, n``: words that are to be searched in shards other than their own.

    The driver sees the first word of every shard, one in ``SHARD_WORDS``.
    """
    key = F.reverse("word") if backwards else F.col("word")
    firsts = [r["first"] for r in shards.groupBy("shard").agg(F.min(key).alias("first")).orderBy("shard").collect()]
    shared = shards.sparkSession.sparkContext.broadcast(firsts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        firsts = shared.value
        for batch in batches:
            rows, to = [], []
            for i, (word, own) in enumerate(zip(batch.column("word").to_pylist(), batch.column("shard").to_pylist())):
                size = len(word) // 2
                half = word[size:][::-1] if backwards else word[:size]
                # Words that begin with it, that is, from itself to before the next string of its length.
                low = max(bisect_right(firsts, half) - 1, 0)
                high = bisect_right(firsts, half, key=lambda f: f[: len(half)]) - 1
                for shard in range(low, high + 1):
                    if shard != own:
                        rows.append(i)
                        to.append(shard)
            taken = batch.select(["word", "n"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), *taken.columns], names=["shard", "word", "n"])

    return written(shards.mapInArrow(run, "shard int, word string, n bigint"))


def pairs(words: DataFrame, backwards: bool) -> DataFrame:
    """``word, near, near_n``: near words that share the first half (``backwards``: the last, and not the first)."""
    shards = sharded(words, backwards)
    guests = visitors(shards, backwards)
    # Block 0 of a shard searches its own words, further blocks those of others.
    blocks = guests.groupBy("shard").agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("_blocks"))
    more = shards.join(blocks, "shard").select("shard", "word", "n", F.explode(F.sequence(F.lit(1), "_blocks")).alias("block"))
    index = shards.select("shard", "word", "n", F.lit(0).alias("block")).unionByName(more)
    spread = guests.join(blocks, "shard").select(
        "shard", "word", "n", (F.pmod(F.xxhash64("word"), F.col("_blocks")) + 1).cast("int").alias("block")
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.string(), pa.string(), pa.int64())], names=["word", "near", "near_n"])
        held = left.column("word").to_pylist()
        number = dict(zip(held, left.column("n").to_pylist()))
        asked = held if left.column("block")[0].as_py() == 0 else right.column("word").to_pylist()
        index = Index(held)
        owner, target = near_words(index, asked, not backwards)
        words, nears = [asked[i] for i in owner], [index.words[i] for i in target]
        if backwards:
            new = [not b.startswith(a[: len(a) // 2]) for a, b in zip(words, nears)]
            words, nears = ([x for x, keep in zip(side, new) if keep] for side in (words, nears))
        return pa.table(
            [pa.array(words, pa.string()), pa.array(nears, pa.string()), pa.array([number[w] for w in nears], pa.int64())],
            names=["word", "near", "near_n"],
        )

    return index.groupBy("shard", "block").cogroup(spread.groupBy("shard", "block")).applyInArrow(
        run, "word string, near string, near_n bigint"
    )


def variants(words: DataFrame, spelling: Spelling = Spelling()) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for ``words`` (word, n), each word once."""
    words = written(words)
    found = pairs(words, False).unionByName(pairs(words, True))
    best = found.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), F.col("near"))).alias("_best")
    )
    joined = words.join(best, "word", "left").select("word", "n", "n_near", "_best.near", (-F.col("_best.col1")).alias("near_n"))
    is_form = F.col("near_n") >= spelling.ratio * F.col("n")
    rows = written(
        joined.select(
            "word",
            F.when(is_form, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        )
    )
    return rows.join(_roots(rows), "form", "left").select(
        "word", "form", F.coalesce("root", "form", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(rows: DataFrame) -> DataFrame:
    """``form, root`` of the forms that have forms themselves: links that double in length until they end."""
    links = rows.where("form is not null").select("word", "form")
    targets = links.select(F.col("form").alias("word")).distinct()
    chain = written(links.join(targets, "word", "left_semi").select("word", F.col("form").alias("root")))
    while True:
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = written(chain.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), "_next"))
        if longer.where("_next is not null").isEmpty():
            return chain.select(F.col("word").alias("form"), "root")
        chain = longer.select("word", "root")


def spelling_variants(docs: DataFrame, spelling: Spelling = Spelling(), damage: int | None = None) -> DataFrame:
    """:func:`variants` of the words of ``docs``; with ``damage``, of every so many runs one loses a letter first."""
    runs = long_runs(docs, spelling)
    word = F.col("run") if damage is None else damaged(F.col("doc_id"), F.col("run"), damage)
    return variants(vocabulary(runs.select(word.alias("word")), spelling), spelling)
