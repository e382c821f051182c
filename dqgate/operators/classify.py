"""Typing, reason codes, and the split into curated, quarantine and warned rows.

Everything here is a narrow projection or filter: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from dqgate.functions.casts import parse_double, parse_int, parse_timestamp
from dqgate.operators.rules import CRITICAL, WARNING, Rule, reason_array, retail_rules
from dqgate.schema import CURATED, LANDING_FILE, QUARANTINE, RAW_COLUMNS


def typed(raw: DataFrame) -> DataFrame:
    """Raw text columns plus their parsed values; ``dt`` and the landing file are passed through.

    The parsed values come out of a one-row generator.  The optimizer pushes a filter
    through a projection by writing the projected expressions into the filter, once
    per use, so a split by validity would parse every field several times.  It does
    not push a filter on its output below a generator, and each field is parsed once.
    """
    parsed = F.struct(
        parse_timestamp(F.col("transactionts")).alias("transactionts_parsed"),
        parse_double(F.col("amount")).alias("amount_parsed"),
        parse_int(F.col("quantity")).alias("quantity_parsed"),
    )
    source = [LANDING_FILE] if LANDING_FILE in raw.columns else []
    return raw.select(*RAW_COLUMNS, F.inline(F.array(parsed)), "dt", *source)


def tag(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Any table plus the codes each row breaks: ``_reasons`` and ``_warn_reasons``."""
    return rows.withColumns(
        {
            "_reasons": reason_array(rules, CRITICAL),
            "_warn_reasons": reason_array(rules, WARNING),
        }
    )


def classify(raw: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Landing rows with parsed values and reason codes."""
    return tag(typed(raw), retail_rules() if rules is None else rules)


def invalid(classified: DataFrame) -> DataFrame:
    return classified.where(F.size("_reasons") > 0)


def valid(classified: DataFrame) -> DataFrame:
    return classified.where(F.size("_reasons") == 0)


def warned(classified: DataFrame) -> DataFrame:
    """Valid rows with at least one warning; an invalid row is never a warning row."""
    return valid(classified).where(F.size("_warn_reasons") > 0)


def curated(classified: DataFrame) -> DataFrame:
    """Valid rows with the parsed values under the raw names."""
    return valid(classified).select(
        "transactionid",
        F.col("transactionts_parsed").alias("transactionts"),
        "storeid",
        "productid",
        F.col("amount_parsed").alias("amount"),
        F.col("quantity_parsed").alias("quantity"),
        "dt",
    ).select(*CURATED.names)


def quarantine(classified: DataFrame) -> DataFrame:
    """Invalid rows, raw and parsed, with their codes as comma-separated text."""
    return (
        invalid(classified)
        .withColumn("_invalid_reasons", F.array_join("_reasons", ","))
        .select(*QUARANTINE.names)
    )
