"""Fixed schemas and tunable limits of the batch quality checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The landing columns, in file order.
RAW_COLUMNS = ("transactionid", "transactionts", "storeid", "productid", "amount", "quantity")

# The file a row was read from, where that is known.
LANDING_FILE = "landing_file"

# Verdict names from the mildest to the most severe.
DECISIONS = ("ALLOW", "ALLOW_WITH_WARNING", "ESCALATE", "QUARANTINE")
PENDING = "PENDING_EVALUATION"

RAW = StructType([StructField(name, StringType()) for name in RAW_COLUMNS])

CURATED = StructType(
    [
        StructField("transactionid", StringType()),
        StructField("transactionts", TimestampType()),
        StructField("storeid", StringType()),
        StructField("productid", StringType()),
        StructField("amount", DoubleType()),
        StructField("quantity", IntegerType()),
        StructField("dt", StringType()),
    ]
)

QUARANTINE = StructType(
    list(RAW.fields)
    + [
        StructField("transactionts_parsed", TimestampType()),
        StructField("amount_parsed", DoubleType()),
        StructField("quantity_parsed", IntegerType()),
        StructField("dt", StringType()),
        StructField("_invalid_reasons", StringType()),
    ]
)

_COUNTS = MapType(StringType(), LongType())

# The report's field names.
REPORT = StructType(
    [
        StructField("source_date", StringType()),
        StructField("s3_key", StringType()),
        StructField("processed_at", TimestampType()),
        StructField("batch_status", StringType()),
        StructField("raw_count", LongType()),
        StructField("valid_count", LongType()),
        StructField("invalid_count", LongType()),
        StructField("warning_count", LongType()),
        StructField("invalid_rate", DoubleType()),
        StructField("warning_rate", DoubleType()),
        StructField("previous_invalid_rate", DoubleType()),
        StructField("previous_warning_rate", DoubleType()),
        StructField("dominant_invalid_reason", StringType()),
        StructField("duplicate_transactionid_rows_total", LongType()),
        StructField("anomaly_high_amount_count", LongType()),
        StructField("anomaly_high_amount_rate", DoubleType()),
        StructField("anomaly_high_quantity_count", LongType()),
        StructField("anomaly_high_quantity_rate", DoubleType()),
        StructField("amount_min", DoubleType()),
        StructField("amount_max", DoubleType()),
        StructField("amount_avg", DoubleType()),
        StructField("quantity_min", IntegerType()),
        StructField("quantity_max", IntegerType()),
        StructField("quantity_avg", DoubleType()),
        StructField("invalid_reason_breakdown", _COUNTS),
        StructField("warning_reason_breakdown", _COUNTS),
        StructField(
            "thresholds",
            StructType(
                [
                    StructField("max_invalid_rate", DoubleType()),
                    StructField("max_warning_rate", DoubleType()),
                    StructField("amount_anomaly_threshold", DoubleType()),
                    StructField("quantity_anomaly_threshold", IntegerType()),
                ]
            ),
        ),
    ]
)

# What the decision step writes back next to the report fields.
EVALUATED = StructType(
    list(REPORT.fields)
    + [
        StructField("decision_reasons", ArrayType(StringType())),
        StructField("agent_reasoning", StringType()),
        StructField("agent_actions", ArrayType(StringType())),
    ]
)

VERDICT = StructType(
    [
        StructField("final_decision", StringType()),
        StructField("reasoning", StringType()),
        StructField("recommended_actions", ArrayType(StringType())),
    ]
)


# One row of a feed's manifest: what counts for a batch.
MANIFEST = StructType(
    [
        StructField("source_date", StringType()),
        StructField("data_id", LongType()),
        StructField("data_run", StringType()),
        StructField("report_run", StringType()),
        StructField("decision_run", StringType()),
        StructField("failure_run", StringType()),
        StructField("valid_count", LongType()),
        StructField("invalid_count", LongType()),
        StructField("decision", StringType()),
        StructField("final_decision", StringType()),
        StructField("gated", BooleanType()),
        StructField("reviewed", BooleanType()),
    ]
)


@dataclass(frozen=True)
class Thresholds:
    """Every limit used by the row rules, the metrics and the batch decision."""

    # The default limits.
    min_rows: int = 50_000
    amount_min: float = 0.01
    quantity_min: int = 1
    amount_anomaly: float = 5000.0
    quantity_anomaly: int = 50
    max_invalid_rate: float = 0.05
    max_warning_rate: float = 0.10
    max_duplicate_rate: float = 0.01
    max_anomaly_rate: float = 0.05
    max_invalid_drift: float = 0.02

    @property
    def as_sql(self) -> str:
        """The limits a report carries along, as an SQL struct."""
        return f"""named_struct(
            'max_invalid_rate', {float(self.max_invalid_rate)!r}D,
            'max_warning_rate', {float(self.max_warning_rate)!r}D,
            'amount_anomaly_threshold', {float(self.amount_anomaly)!r}D,
            'quantity_anomaly_threshold', {int(self.quantity_anomaly)})"""


DEFAULTS = Thresholds()
