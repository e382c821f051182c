"""From a report table to one decision per batch, and the merge with outside review.

Reports hold one row per feed and calendar day, so everything here works on a small
table; nothing touches transaction rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from dqgate.functions.numbers import percent, ratio, round_half_even
from dqgate.schema import DECISIONS, DEFAULTS, EVALUATED, VERDICT, Thresholds

ALLOW, ALLOW_WITH_WARNING, ESCALATE, QUARANTINE = range(len(DECISIONS))

# The reason texts of a decision.
PASSED = "All quality checks passed within thresholds."
INVALID_TEXT = "Invalid rate %s exceeds threshold %s."
WARNING_TEXT = "Warning rate %s exceeds threshold %s."
DUPLICATE_TEXT = (
    "Duplicate row rate %s exceeds threshold %s. Possible replay or upstream dedup issue."
)
ANOMALY_TEXT = "High-amount anomaly rate %s exceeds threshold %s."
DRIFT_TEXT = (
    "Invalid rate increased by %s vs previous run (%s -> %s). Possible upstream schema change."
)
DOMINANT_TEXT = "Dominant failure reason: %s. Investigate upstream source for this field."

# Fixed value: what a reviewer is asked.
REQUEST_TEXT = "Batch date: %s\nDeterministic decision: %s\nReasons: %s\nMetrics: %s"

# The report fields a reviewer gets to see.
REVIEW_FIELDS = (
    "source_date",
    "invalid_rate",
    "warning_rate",
    "duplicate_transactionid_rows_total",
    "anomaly_high_amount_rate",
    "previous_invalid_rate",
    "dominant_invalid_reason",
    "invalid_reason_breakdown",
    "warning_reason_breakdown",
    "raw_count",
    "valid_count",
)


def decision_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in DECISIONS]), rank + 1)


def decision_rank(name: Column) -> Column:
    """0 for the mildest decision to 3 for the most severe, NULL for any other text."""
    found = F.array_position(F.array(*[F.lit(d) for d in DECISIONS]), name)
    return F.when(found > 0, (found - 1).cast("int"))


# -- baseline -----------------------------------------------------------------

def with_baseline(
    reports: DataFrame,
    history: DataFrame | None = None,
    baseline: str = "previous",
    refresh: bool = False,
    feed: str | None = None,
) -> DataFrame:
    """Reports with the rates of the batch before, in date order and per feed.

    ``feed`` is a column of ``reports`` and ``history`` that names the feed; without it all
    reports are of one feed.

    ``history`` holds reports of earlier runs; a date present in both counts with its
    new report.  The batch before is the latest one that exists, however long ago.
    With ``refresh`` the stored report that follows a new one is returned too, since the
    batch before it has changed.  ``baseline="none"`` leaves the previous rates unknown, which switches drift off.
    """
    if baseline == "none":
        unknown = F.lit(None).cast("double")
        return reports.withColumns(
            {"previous_invalid_rate": unknown, "previous_warning_rate": unknown}
        )
    if baseline != "previous":
        raise ValueError(f"unknown baseline: {baseline!r}")

    columns = reports.columns
    of_feed = F.lit("") if feed is None else F.col(feed)
    rows = reports.withColumns({"_feed": of_feed, "_new": F.lit(True)})
    if history is not None:
        old = history.select(*columns).withColumns({"_feed": of_feed, "_new": F.lit(False)})
        # One pass over each side: merging by key instead of anti-joining the new
        # dates keeps the (possibly costly) report plan from running twice.
        rest = [name for name in rows.columns if name not in ("_feed", "source_date")]
        rows = (
            rows.unionByName(old)
            .groupBy("_feed", "source_date")
            .agg(F.max_by(F.struct(*rest), "_new").alias("_row"))
            .select("_feed", "source_date", "_row.*")
        )
    # One group per feed, of one row per calendar day.
    by_feed = Window.partitionBy("_feed").orderBy("source_date")
    return (
        rows.withColumns(
            {
                "previous_invalid_rate": F.lag("invalid_rate").over(by_feed),
                "previous_warning_rate": F.lag("warning_rate").over(by_feed),
                "_after_new": F.coalesce(F.lag("_new").over(by_feed), F.lit(False)),
            }
        )
        .where("_new OR _after_new" if refresh else "_new")
        .select(*columns)
    )


# -- rules --------------------------------------------------------------------

# A metric the report does not have counts as 0.
_INVALID = "coalesce(invalid_rate, 0D)"
_WARNING = "coalesce(warning_rate, 0D)"
_ANOMALY = "coalesce(anomaly_high_amount_rate, 0D)"
# Not rounded for the comparison.
_DUPLICATE = ratio("coalesce(duplicate_transactionid_rows_total, 0)", "coalesce(valid_count, 0)")
# NULL without a batch before, and then the rule does not fire.
_DRIFT = f"({_INVALID} - previous_invalid_rate)"


@dataclass(frozen=True)
class BatchRule:
    """Asks for the decision of ``rank`` when ``value`` is above ``limit``, strictly.

    ``value`` and ``shown`` (the values filled into ``text``) are SQL expressions
    over a report.
    """

    number: int
    rank: int
    value: str
    limit: float
    text: str
    shown: tuple[str, ...]

    @property
    def fired(self) -> str:
        return f"{self.value} > {float(self.limit)!r}D"

    @property
    def sentence(self) -> str:
        filled = ", ".join(percent(value) for value in self.shown)
        return f"format_string('{self.text}', {filled})"

    @property
    def record(self) -> str:
        return f"struct({self.number} AS rule, {self.value} AS value, {float(self.limit)!r}D AS threshold)"


def batch_rules(limits: Thresholds = DEFAULTS) -> list[BatchRule]:
    """The five threshold rules, in the order their reasons are listed."""

    def above(number: int, rank: int, value: str, limit: float, text: str) -> BatchRule:
        return BatchRule(number, rank, value, limit, text, (value, f"{float(limit)!r}D"))

    return [
        above(1, QUARANTINE, _INVALID, limits.max_invalid_rate, INVALID_TEXT),
        above(2, ALLOW_WITH_WARNING, _WARNING, limits.max_warning_rate, WARNING_TEXT),
        above(3, ESCALATE, _DUPLICATE, limits.max_duplicate_rate, DUPLICATE_TEXT),
        above(4, ALLOW_WITH_WARNING, _ANOMALY, limits.max_anomaly_rate, ANOMALY_TEXT),
        BatchRule(
            5,
            ESCALATE,
            _DRIFT,
            limits.max_invalid_drift,
            DRIFT_TEXT,
            (_DRIFT, "previous_invalid_rate", _INVALID),
        ),
    ]


def decide(reports: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Reports plus ``decision``, its rank, its reasons, the fired rules and a summary.

    The decision is the most severe one any rule asks for.  Naming the dominant
    failure adds a reason to a severe decision but never changes it.
    """
    rules = batch_rules(limits)
    rank = f"greatest({', '.join(f'IF({r.fired}, {r.rank}, {ALLOW})' for r in rules)})"
    fired = f"array_compact(array({', '.join(f'IF({r.fired}, {r.record}, NULL)' for r in rules)}))"
    sentences = [f"IF({r.fired}, {r.sentence}, NULL)" for r in rules]
    sentences.append(
        f"IF(decision_rank >= {ESCALATE} AND dominant_invalid_reason <> '',"
        f" format_string('{DOMINANT_TEXT}', dominant_invalid_reason), NULL)"
    )
    found = f"array_compact(array({', '.join(sentences)}))"
    summary = f"""named_struct(
        'invalid_rate', {_INVALID},
        'warning_rate', {_WARNING},
        'duplicate_rate', {round_half_even(_DUPLICATE, 6)},
        'anomaly_amount_rate', {_ANOMALY},
        'raw_count', coalesce(raw_count, 0),
        'valid_count', coalesce(valid_count, 0))"""
    return (
        reports.withColumn("decision_rank", F.expr(rank))
        .withColumns(
            {
                "decision": decision_name(F.col("decision_rank")),
                "_found": F.expr(found),
                "fired_rules": F.expr(fired),
                "metrics_summary": F.expr(summary),
            }
        )
        .withColumn("decision_reasons", F.expr(f"IF(size(_found) = 0, array('{PASSED}'), _found)"))
        .drop("_found")
    )


def fired_rules(decisions: DataFrame) -> DataFrame:
    """Long form: one row per batch and threshold rule that fired."""
    return decisions.select("source_date", F.inline("fired_rules"))


# -- outside review -----------------------------------------------------------


def review_queue(decisions: DataFrame) -> DataFrame:
    """Batches worth a review, with the metrics and the request text to send along."""
    metrics = F.to_json(F.struct(*REVIEW_FIELDS), {"ignoreNullFields": "false"})
    return (
        decisions.where(F.col("decision") != DECISIONS[ALLOW])
        .withColumns({"reasons_text": F.concat_ws("; ", "decision_reasons"), "metrics_json": metrics})
        .withColumn(
            "request_text",
            F.format_string(
                REQUEST_TEXT,
                "source_date",
                "decision",
                "reasons_text",
                "metrics_json",
            ),
        )
        .select(
            "source_date", "decision", "reasons_text", "metrics_json", "request_text", "metrics_summary"
        )
    )


# Fixed value: JSON inside a code fence.
_FENCE = r"```(?:json)?\s*([\s\S]+?)\s*```"


def parse_verdicts(verdicts: DataFrame) -> DataFrame:
    """``dt, verdict_text`` to ``dt, verdict``; NULL unless it names a known decision.

    The text is parsed as the only element of an array, so anything before or after
    the JSON object makes it unreadable instead of being ignored.
    """
    fenced = F.nullif(F.regexp_extract("verdict_text", _FENCE, 1), F.lit(""))
    body = F.coalesce(fenced, F.col("verdict_text"))
    parsed = F.from_json(
        F.concat(F.lit("["), body, F.lit("]")),
        f"array<{VERDICT.simpleString()}>",
        {"allowSingleQuotes": "false"},
    )
    only = F.when(F.size(parsed) == 1, F.element_at(parsed, 1))
    return verdicts.select("dt", only.alias("verdict")).withColumn(
        "verdict",
        F.when(decision_rank(F.col("verdict.final_decision")).isNotNull(), F.col("verdict")),
    )


def merge_verdicts(decisions: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Decisions raised, never lowered, by the verdicts on them.

    A batch that passed is not reviewed.  A missing or unusable verdict leaves the
    rule decision alone.  Of several verdicts on one batch the most severe counts.
    """
    rank = decision_rank(F.col("verdict.final_decision"))
    # max_by skips rows without an ordering value, that is, unusable verdicts.
    severity = F.when(F.col("verdict").isNotNull(), F.struct(rank, F.col("verdict")))
    usable = (
        parse_verdicts(verdicts)
        .groupBy(F.col("dt").alias("source_date"))
        .agg(F.max_by("verdict", severity).alias("verdict"))
    )
    reviewed = F.when(F.col("decision_rank") > ALLOW, F.col("verdict"))
    return (
        decisions.join(usable, "source_date", "left")
        .withColumn("verdict", reviewed)
        .withColumn("final_rank", F.greatest(F.col("decision_rank"), F.coalesce(rank, F.lit(ALLOW))))
        .withColumns(
            {
                "final_decision": decision_name(F.col("final_rank")),
                "agent_reasoning": F.col("verdict.reasoning"),
                "agent_actions": F.col("verdict.recommended_actions"),
            }
        )
        .drop("verdict")
    )


def without_review(decisions: DataFrame) -> DataFrame:
    """The columns ``merge_verdicts`` adds, when there is nobody to review."""
    return decisions.withColumns(
        {
            "final_rank": F.col("decision_rank"),
            "final_decision": F.col("decision"),
            "agent_reasoning": F.lit(None).cast("string"),
            "agent_actions": F.lit(None).cast("array<string>"),
        }
    )


def evaluated(final: DataFrame) -> DataFrame:
    """The report with its decision written into it."""
    return final.withColumn("batch_status", F.col("final_decision")).select(*EVALUATED.names)
