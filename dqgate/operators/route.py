"""What follows from a decision: end state, alert rows, and the publish gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dqgate.functions.lineage import join_small_keys

# End states and alert texts by decision.
ROUTES = {
    "QUARANTINE": (
        "FAILED",
        "Batch Quarantined - Quality Too Poor",
        "Batch for %s has been quarantined. Reasons: %s",
    ),
    "ESCALATE": (
        "ESCALATED",
        "Batch Escalated - Human Review Required",
        "Batch for %s requires human review. Reasons: %s",
    ),
    "ALLOW_WITH_WARNING": (
        "SUCCEEDED",
        "Batch Allowed With Warnings",
        "Batch for %s passed with warnings. Reasons: %s",
    ),
}
DEFAULT_STATE = "SUCCEEDED"
FAILURE_SUBJECT = "Pipeline Failed"
FAILURE_TEXT = "Pipeline failed for date %s. Error: %s"
UNDERSIZED_TEXT = "Row count %d below minimum %d. Aborting."
MISSING_TEXT = "Landing file not found."

PUBLISHABLE = ("ALLOW", "ALLOW_WITH_WARNING")


def _by_decision(choices: dict[str, Column]) -> Column:
    """The value chosen for a row's final decision, NULL without one."""
    decision = F.col("final_decision")
    return F.coalesce(*[F.when(decision == name, value) for name, value in choices.items()])


def route(final: DataFrame) -> DataFrame:
    """Adds the end state of each batch."""
    states = {name: F.lit(state) for name, (state, _, _) in ROUTES.items()}
    state = F.coalesce(_by_decision(states), F.lit(DEFAULT_STATE))
    return final.withColumn("terminal_state", state)


def alerts(final: DataFrame) -> DataFrame:
    """One message per batch that did not simply pass."""
    reasons = F.to_json("decision_reasons")
    subjects = {name: F.lit(subject) for name, (_, subject, _) in ROUTES.items()}
    messages = {
        name: F.format_string(text, F.col("source_date"), reasons)
        for name, (_, _, text) in ROUTES.items()
    }
    return final.where(F.col("final_decision").isin(*ROUTES)).select(
        "source_date",
        _by_decision(subjects).alias("subject"),
        _by_decision(messages).alias("message"),
    )


def failure_alerts(missing: DataFrame, undersized: DataFrame) -> DataFrame:
    """One message per batch that never reached a decision.

    ``missing`` has ``dt``; ``undersized`` has ``dt, raw_count, min_rows``.
    """
    causes = missing.select("dt", F.lit(MISSING_TEXT).alias("cause")).unionByName(
        undersized.select(
            "dt", F.format_string(UNDERSIZED_TEXT, "raw_count", "min_rows").alias("cause")
        )
    )
    return causes.select(
        F.col("dt").alias("source_date"),
        F.lit(FAILURE_SUBJECT).alias("subject"),
        F.format_string(FAILURE_TEXT, "dt", "cause").alias("message"),
    )


def publish_gate(
    rows: DataFrame, final: DataFrame, publishable: Sequence[str] = PUBLISHABLE
) -> DataFrame:
    """Only the rows of batches whose final decision lets them out."""
    allowed = final.where(F.col("final_decision").isin(*publishable))
    return join_small_keys(rows, allowed.select(F.col("source_date").alias("dt")), "dt", "left_semi")
