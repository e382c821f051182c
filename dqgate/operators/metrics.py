"""Batch metrics: counts, duplicates, anomalies, statistics, breakdowns, the report.

Every operator is keyed by batch (``dt``) and returns a DataFrame.  Aggregates
combine on the map side, so a batch that holds most of the rows, or an id that
repeats without end, reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dqgate.functions.numbers import rate
from dqgate.operators.classify import valid
from dqgate.operators.rules import CRITICAL, WARNING, Rule, codes, merged, retail_rules
from dqgate.schema import DEFAULTS, LANDING_FILE, PENDING, REPORT, Thresholds


def _is_valid() -> Column:
    return F.size("_reasons") == 0


def high_amount(limits: Thresholds = DEFAULTS) -> Column:
    """True for a valid row with an unusually large amount; the row is kept."""
    return _is_valid() & (F.col("amount_parsed") > F.lit(limits.amount_anomaly))


def high_quantity(limits: Thresholds = DEFAULTS) -> Column:
    """True for a valid row with an unusually large quantity; the row is kept."""
    return _is_valid() & (F.col("quantity_parsed") > F.lit(limits.quantity_anomaly))


def base_metrics(classified: DataFrame, limits: Thresholds = DEFAULTS, *more: Column) -> DataFrame:
    """Counts, anomaly counts and value statistics per batch, in one aggregation (with ``more``)."""
    valid_row = "size(_reasons) = 0"
    amount, quantity = (f"IF({valid_row}, {name}, NULL)" for name in ("amount_parsed", "quantity_parsed"))
    metrics = {
        "raw_count": "count(*)",
        "valid_count": f"count_if({valid_row})",
        "invalid_count": f"count_if(NOT {valid_row})",
        "warning_count": f"count_if({valid_row} AND size(_warn_reasons) > 0)",
        "anomaly_high_amount_count": f"count_if({valid_row} AND amount_parsed > {float(limits.amount_anomaly)!r}D)",
        "anomaly_high_quantity_count": f"count_if({valid_row} AND quantity_parsed > {int(limits.quantity_anomaly)})",
        "amount_min": f"min({amount})",
        "amount_max": f"max({amount})",
        "amount_avg": f"round(avg({amount}), 2)",
        "quantity_min": f"min({quantity})",
        "quantity_max": f"max({quantity})",
        "quantity_avg": f"round(avg({quantity}), 2)",
    }
    return classified.groupBy("dt").agg(*[F.expr(sql).alias(name) for name, sql in metrics.items()], *more)


def duplicate_ids(rows: DataFrame, *keys: str) -> DataFrame:
    """Key values carried by more than one row, with their row count ``n``."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def duplicate_rows(valid_rows: DataFrame) -> DataFrame:
    """Per batch: valid rows, rows that share their id with another, and their rate.

    All rows of a repeated id count, not only the excess.  Ids are compared as they
    are: untrimmed and case-sensitive.  The second aggregation runs on the hash of
    (batch, id), so no batch is gathered into one task.
    """
    per_id = valid_rows.groupBy("dt", "transactionid").agg(F.count("*").alias("n"))
    return (
        per_id.groupBy("dt")
        .agg(
            F.sum("n").alias("valid_count"),
            F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias(
                "duplicate_transactionid_rows_total"
            ),
        )
        .withColumn(
            "duplicate_rate",
            F.expr(rate("duplicate_transactionid_rows_total", "valid_count")),
        )
    )


def reason_breakdown(rows: DataFrame, column: str) -> DataFrame:
    """Rows per batch and code: ``dt, reason, n``.  Codes nobody breaks are absent."""
    return (
        rows.select("dt", F.explode(column).alias("reason"))
        .groupBy("dt", "reason")
        .agg(F.count("*").alias("n"))
    )


def dominant_reason(breakdown: DataFrame) -> DataFrame:
    """The most frequent code of each batch; the alphabetically first one on a tie."""
    order = F.struct(-F.col("n"), F.col("reason"))
    return breakdown.groupBy("dt").agg(
        F.min_by("reason", order).alias("dominant_invalid_reason")
    )


def code_counts(names: Sequence[str], column: str, counted: str) -> str:
    """Rows per code, of those with ``counted``, as one SQL aggregate: a map without the codes nobody breaks.

    One counter per code combines on the map side like any other count; exploding the
    codes of each row would need a pass of its own.
    """
    if not names:
        return _NO_COUNTS
    each = [f"struct('{c}' AS reason, count_if({counted} AND array_contains({column}, '{c}')) AS n)" for c in names]
    return f"map_from_entries(filter(array({', '.join(each)}), e -> e.n > 0))"


def most_frequent(counts: str) -> str:
    """SQL for the most frequent code of a map of counts, the alphabetically first one on a tie; NULL without any."""
    return f"array_min(transform(map_entries({counts}), e -> struct(-e.value AS n, e.key AS reason))).reason"


def quality_report(
    classified: DataFrame,
    limits: Thresholds = DEFAULTS,
    rules: Sequence[Rule] | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """One report row per batch, put together from the metrics above.

    ``rules`` are those the rows were tagged with, by default the retail rules; their codes
    become counters of the base aggregate.  ``files`` (``dt, s3_key``) names the files of each
    batch; without it the first file is taken from the rows, where they carry one.

    Counts, statistics and breakdowns reach the shuffle as one row per task and batch;
    only the duplicate branch shuffles ids, with nothing else beside them.  So the rows are read
    twice, each time only the columns needed, and should come from a columnar table, as
    they do in the job.  The joins have one row per batch on either side.
    """
    rules = retail_rules(limits) if rules is None else rules
    broken = code_counts(codes(merged(rules), CRITICAL), "_reasons", "size(_reasons) > 0")
    warned_of = code_counts(codes(merged(rules), WARNING), "_warn_reasons", "size(_reasons) = 0")
    more = [F.expr(broken).alias("invalid_reason_breakdown"), F.expr(warned_of).alias("warning_reason_breakdown")]
    if files is None:
        one = F.min(LANDING_FILE) if LANDING_FILE in classified.columns else F.lit(None).cast("string")
        more.append(one.alias("s3_key"))
    per_batch = base_metrics(classified, limits, *more).join(
        duplicate_rows(valid(classified)).drop("valid_count", "duplicate_rate"), "dt", "left"
    )
    if files is not None:
        per_batch = per_batch.join(files.select("dt", "s3_key"), "dt", "left")
    computed = {
        "source_date": "dt",
        "batch_status": f"'{PENDING}'",
        "processed_at": "current_timestamp()",
        "invalid_rate": rate("invalid_count", "raw_count"),
        "warning_rate": rate("warning_count", "raw_count"),
        "previous_invalid_rate": "CAST(NULL AS DOUBLE)",
        "previous_warning_rate": "CAST(NULL AS DOUBLE)",
        "dominant_invalid_reason": most_frequent("invalid_reason_breakdown"),
        "duplicate_transactionid_rows_total": "coalesce(duplicate_transactionid_rows_total, 0)",
        "anomaly_high_amount_rate": rate("anomaly_high_amount_count", "valid_count"),
        "anomaly_high_quantity_rate": rate("anomaly_high_quantity_count", "valid_count"),
        "thresholds": limits.as_sql,
    }
    return per_batch.selectExpr(*[f"{computed.get(name, name)} AS {name}" for name in REPORT.names])


_NO_COUNTS = "CAST(map() AS MAP<STRING, BIGINT>)"
