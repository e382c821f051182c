"""Line dedup: a suffix array over line ids by prefix doubling; later copies of runs go.

Lines become ids, in the order of their hashes, and a text a sequence of ids.  Suffixes
are ranked by their first 1, 2, 4, ... lines: a round pairs the rank of a place with the
rank as many lines further on and ranks the pairs.  Suffixes that share their first n
lines lie together in that order (an interval of longest common prefix n or more), and
any stretch of lines is named by two overlapping ranks.

A run of lines with at least ``min_words`` words that has occurred before, in an earlier
text or earlier in its own, is deleted.  A line is in such a run if and only if it is in
one that is shortest from its start or shortest up to its end: such a stretch depends on
its own lines only, so copies of it have the same length and fall into one interval,
whose first member stays.  Since lines have a word at least, the order is needed up to
``min_words`` lines only: doubling ends with the longest shortest stretch.  Places whose
first 1, 2, 4, ... lines are unique take no further part.

Built-in expressions only.  Counts and minima are taken per line, pair and interval
before anything is joined; joins carry numbers, never text; ranks come from range
partitions and their sizes.

Defined results: lines are equal if all their characters are; lines without a word are
neither counted nor deleted and do not end a run; texts come in the order of doc_id, NULL
last, then text hash; rows with equal doc_id and text are one document and get the same
answer; NULL text has no lines; an empty table gives no rows; other columns are ignored
here, and :func:`without_repeats` keeps them, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dqgate.llm.common import HAS_WORD, WORD, computed, numbered, ranked, restored, written

MIN_WORDS = 50


def doc_key(doc_id: Column, text: Column) -> Column:
    """A document's place in the order of documents, as one value without NULL."""
    return F.struct(
        doc_id.isNull().alias("last"),
        F.coalesce(doc_id.cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64(text).alias("hash"),
    )


def spoken_lines(docs: DataFrame) -> DataFrame:
    """``doc, at, line, words, h1, h2``: the lines with a word, numbered by ``at`` in their text."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    spoken = F.filter(lines, lambda s: s["x"].rlike(HAS_WORD))
    numbered = docs.select(doc_key(F.col("doc_id"), F.col("text")).alias("doc"), F.posexplode(spoken).alias("at", "_s"))
    return numbered.select(
        "doc", "at", F.col("_s.i").alias("line"),
        F.regexp_count("_s.x", F.lit(WORD)).cast("long").alias("words"),
        F.xxhash64("_s.x").alias("h1"), F.xxhash64(F.lit(1), "_s.x").alias("h2"),
    ).dropDuplicates(["doc", "at"])


def ranks_of(rows: DataFrame, key: list[str]) -> DataFrame:
    """``key, rank``: the keys that occur more than once, by their order."""
    repeated = rows.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1").select(*key)
    return ranked(repeated, key, "rank")


def repeated_lines(lines: DataFrame) -> DataFrame:
    """``doc, at, line, words, rank, run, before, after, total`` of the lines that occur again.

    A run is a stretch of such lines without another line between; ``before`` and
    ``after`` are its words before a line and up to its end.
    """
    named = lines.join(ranks_of(lines, ["h1", "h2"]), ["h1", "h2"]).drop("h1", "h2")
    place = Window.partitionBy("doc").orderBy("at")
    runs = named.withColumn("run", F.col("at") - F.row_number().over(place))
    in_run = Window.partitionBy("doc", "run")
    after = F.sum("words").over(in_run.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    return runs.withColumn("after", after).withColumn("before", F.col("after") - F.col("words")).withColumn(
        "total", F.sum("words").over(in_run)
    )


def stretches(rows: DataFrame, min_words: int) -> DataFrame:
    """``doc, at, n``: the shortest stretches with ``min_words`` words from each line, and up to each."""
    run = Window.partitionBy("doc", "run")
    ahead = F.count("*").over(run.orderBy("before").rangeBetween(0, min_words - 1))
    behind = F.count("*").over(run.orderBy("after").rangeBetween(1 - min_words, 0))
    sized = rows.select("doc", "at", "before", "after", "total", ahead.alias("_ahead"), behind.alias("_behind"))
    from_line = F.when(F.col("total") - F.col("before") >= min_words, F.struct(F.col("at").alias("at"), F.col("_ahead").alias("n")))
    to_line = F.when(F.col("after") >= min_words, F.struct((F.col("at") - F.col("_behind") + 1).alias("at"), F.col("_behind").alias("n")))
    both = F.array_distinct(F.array_compact(F.array(from_line, to_line)))
    return sized.select("doc", F.explode(both).alias("_s")).select(
        "doc", F.col("_s.at").cast("int").alias("at"), F.col("_s.n").alias("n")
    ).distinct()


def doubled(level: DataFrame, lines: int) -> DataFrame:
    """``doc, at, rank`` by the first ``2 * lines`` lines, from the ranks by the first ``lines``."""
    further = Window.partitionBy("doc").orderBy("at").rangeBetween(lines, lines)
    pairs = level.select("doc", "at", F.col("rank").alias("_a"), F.max("rank").over(further).alias("_b"))
    pairs = pairs.where("_b is not null")
    return pairs.join(ranks_of(pairs, ["_a", "_b"]), ["_a", "_b"]).select("doc", "at", "rank")


def copies(level: DataFrame, wanted: DataFrame, lines: int) -> DataFrame:
    """``doc, at, n`` of the ``wanted`` stretches (of ``lines`` to 2 * lines - 1) that are later copies."""
    end = wanted.withColumn("_end", (F.col("at") + F.col("n") - lines).cast("int"))
    named = end.join(level.select("doc", "at", F.col("rank").alias("_a")), ["doc", "at"])
    if lines > 1:
        tail = level.select("doc", F.col("at").alias("_end"), F.col("rank").alias("_b"))
        named = named.join(tail, ["doc", "_end"])
    else:
        named = named.withColumn("_b", F.lit(0).cast("long"))
    named = named.select("doc", "at", "n", "_a", "_b")
    first = named.groupBy("n", "_a", "_b").agg(
        F.min(F.struct("doc", "at")).alias("_first"), F.count("*").alias("_members")
    ).where("_members > 1").drop("_members")
    return named.join(first, ["n", "_a", "_b"]).where(F.struct("doc", "at") > F.col("_first")).select("doc", "at", "n")


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc, line, words``: the lines of later copies, by number within their text (from 0)."""
    rows = written(repeated_lines(written(spoken_lines(docs))))
    wanted = written(stretches(rows, min_words))
    longest = wanted.agg(F.max("n")).first()[0] or 0
    level, lines, found = rows.select("doc", "at", "rank"), 1, None
    while True:
        own = copies(level, wanted.where((F.col("n") >= lines) & (F.col("n") < 2 * lines)), lines)
        found = own if found is None else found.unionByName(own)
        if 2 * lines > longest:
            break
        level, lines = written(doubled(level, lines)), 2 * lines
    ends = found.groupBy("doc", "at").agg(F.max(F.col("at") + F.col("n")).alias("_end"))
    up_to = Window.partitionBy("doc", "run").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    reached = rows.select("doc", "at", "run", "line", "words").join(ends, ["doc", "at"], "left").withColumn(
        "_reach", F.max("_end").over(up_to)
    )
    return reached.where("_reach > at").select("doc", "line", "words")


def repeats_by_document(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc, lines, words``: for documents that lose lines, which and with how many words."""
    return deleted_lines(docs, min_words).groupBy("doc").agg(
        F.sort_array(F.collect_list("line")).alias("lines"), F.sum("words").alias("words")
    )


def line_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_lines, n_removed, removed_words, removed_lines``."""
    removed = repeats_by_document(docs, min_words)
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    rows = docs.select("doc_id", doc_key(F.col("doc_id"), F.col("text")).alias("doc"), n_lines.alias("n_lines"))
    return rows.join(removed, "doc", "left").select(
        "doc_id", "n_lines",
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("words", F.lit(0)).cast("long").alias("removed_words"),
        F.coalesce(F.array_join(F.col("lines").cast("array<string>"), ","), F.lit("")).alias("removed_lines"),
    )


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the lines of later copies deleted from ``text``; all columns stay.

    ``n_chars``, where there is such a column, is counted again.  A document that loses
    lines and has no word left is left out.
    """
    removed = repeats_by_document(docs, min_words).select("doc", "lines")
    rows, old = numbered(docs)
    met = rows.withColumn("doc", doc_key(old["doc_id"], old["text"])).join(removed, "doc", "left")
    left = F.filter(F.split(old["text"], "\n"), lambda x, i: ~F.array_contains(F.col("lines"), i))
    loses = F.col("lines").isNotNull()
    found = computed(met, _left=F.when(loses, F.array_join(left, "\n")).otherwise(old["text"]))
    return restored(found.where(~loses | F.col("_left").rlike(HAS_WORD)), docs, F.col("_left"))
