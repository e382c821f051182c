"""Quality rules, line first: bad lines go, then documents that lose too much text.

Every rule looks at one line.  Lines that fail any rule are removed; a document is
rejected when its statistics are out of bounds or when too large a part of its text was
in failing lines.  Built-in expressions only, one pass over the texts, no shuffle.

Defined results: NULL text counts as empty (no words, rejected); blank lines are neither
judged nor counted as duplicates and stay in the cleaned text; rows with equal or NULL
``doc_id`` are judged one by one; an empty table gives no rows; other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from dqgate.llm.common import HAS_WORD, computed, numbered, restored, words

SYMBOLS = r"[#*$%&|<>]"
#: A line that says nothing by itself and ends open: no sentence end, colon or closing mark.
PUNCTUATED = r"[.!?:;,…。！？\"'”’»)\]\x{2013}\x{2014}-][\x20\x09-\x0D]*\z"
NAVIGATION = (
    r"(?i)^[\x20\x09-\x0D]*(home|menu|next|previous|back|top|log ?in|sign (in|up)|register|"
    r"contact( us)?|about( us)?|site ?map|skip to (main )?content|search|share|read more)"
    r"[\x20\x09-\x0D]*([|>»/·•][^\n]*)?\z"
)
BOILERPLATE = (
    r"(?i)(javascript|cookie policy|use of cookies|uses cookies|privacy policy|terms of (use|service)|"
    r"all rights reserved|lorem ipsum|click here|subscribe to our|powered by)"
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules.  Shares are in per cent."""

    min_words: int = 50
    max_repeated_words: int = 50
    max_lost_text: int = 30
    max_line_symbols: int = 5
    open_line_words: int = 5


def line_passes(line: Column, rules: LineRules = LineRules()) -> Column:
    """Whether one line passes all rules; a blank line does.

    - punctuation: a short line (fewer than ``open_line_words`` words) must not end open
    - symbols: at most ``max_line_symbols`` per cent of the characters are markup symbols
    - shouting: a line with several capitals has other letters too, small ones or ones without case
    - navigation and boilerplate: fixed phrases
    """
    few = rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){{1,{rules.open_line_words - 1}}}\z"
    short_and_open = ~line.rlike(PUNCTUATED) & line.rlike(few)
    symbols = F.regexp_count(line, F.lit(SYMBOLS)) * 100 > F.length(line) * rules.max_line_symbols
    shouting = ~line.rlike(r"[\p{Ll}\p{Lo}\p{Lm}]") & line.rlike(r"\p{Lu}[^\n]*\p{Lu}")
    bad = short_and_open | symbols | shouting | line.rlike(NAVIGATION) | line.rlike(BOILERPLATE)
    return ~bad


STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_chars", "base_failed", "kept",
)


def clean_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the cleaned ``text``, and :data:`STATISTICS`."""
    rows = docs.select("doc_id", F.col("text").alias("_text"))
    return _judged(rows, rules).select("doc_id", "text", *STATISTICS)


def cleaned_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, with all columns of ``docs`` and the cleaned ``text``.

    ``n_chars``, where there is such a column, is counted again.
    """
    rows, old = numbered(docs)
    kept = _judged(rows.withColumn("_text", old["text"]), rules).where("kept")
    return restored(kept, docs, F.col("text"))


def _judged(rows: DataFrame, rules: LineRules) -> DataFrame:
    """``rows`` with the cleaned ``text`` of their ``_text``, and the statistics."""
    split = computed(
        rows.withColumn("_text", F.coalesce("_text", F.lit(""))),
        _words=words(F.col("_text")),
        _lines=F.split("_text", "\n"),
    )
    at = computed(
        split,
        _spoken=F.filter("_lines", lambda x: x.rlike(HAS_WORD)),
        _passed=F.filter("_lines", lambda x: line_passes(x, rules)),
        _windows=_windows(F.col("_words")),
    )
    joined = computed(
        at,
        n_words=F.size("_words").cast("long"),
        word_chars=F.length(F.array_join("_words", "")).cast("long"),
        n_symbols=F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"),
        n_dup_lines=(F.size("_spoken") - F.size(F.array_distinct("_spoken"))).cast("long"),
        _sorted=_sorted_repeats(F.col("_windows")),
        _all=F.length(F.array_join("_lines", "")),
        _left=F.length(F.array_join("_passed", "")),
        text=F.array_join("_passed", "\n"),
    )
    starts = computed(joined, _starts=_repeated_starts(F.col("_sorted")))
    failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeated_words
    )
    lost = (F.col("_all") - F.col("_left")).cast("long")
    few_lost = lost * 100 <= F.col("_all") * rules.max_lost_text
    return (
        starts.withColumn("n_repeat_words", _covered(F.col("_starts")).cast("long"))
        .withColumn("n_lost_chars", lost)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & few_lost)
        .select(*[c for c in rows.columns if c != "_text"], "text", *STATISTICS)
    )


def _windows(tokens: Column) -> Column:
    """Hashes of the three-word windows, by their first word."""
    hashed = F.transform(tokens, lambda w, i: F.xxhash64(w, F.get(tokens, i + 1), F.get(tokens, i + 2)))
    return F.slice(hashed, 1, F.greatest(F.size(tokens) - 2, F.lit(0)))


def _sorted_repeats(windows: Column) -> Column:
    """(window, position) sorted, if any window repeats; else empty, without a sort."""
    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(repeats, F.sort_array(pairs)).otherwise(F.slice(pairs, 1, 0))


def _repeated_starts(pairs: Column) -> Column:
    """Sorted positions of windows that have an equal neighbour in sorted order."""

    def repeated(x: Column, i: Column) -> Column:
        before = F.get(pairs, i - 1)["h"].eqNullSafe(x["h"])
        return before | F.get(pairs, i + 1)["h"].eqNullSafe(x["h"])

    return F.sort_array(F.transform(F.filter(pairs, repeated), lambda x: x["i"]))


def _covered(starts: Column) -> Column:
    """Words under windows of three that begin at the sorted ``starts``."""
    each = F.transform(starts, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - p, F.lit(3))))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b)
