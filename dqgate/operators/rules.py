"""Row rules as data: a code, a severity and an SQL condition per rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from dqgate.schema import DEFAULTS, Thresholds

CRITICAL = "critical"
WARNING = "warning"


@dataclass(frozen=True)
class Rule:
    """``condition`` is true for a row that breaks the rule; NULL counts as not broken."""

    code: str
    severity: str
    condition: str

    def __post_init__(self) -> None:
        if not self.code or set(self.code) & set("'`\\,"):
            raise ValueError(f"a rule code must be plain text without quotes or commas: {self.code!r}")


def merged(rules: Sequence[Rule]) -> list[Rule]:
    """One rule per code and severity, broken when any of its rules is, in first order."""
    conditions: dict[tuple[str, str], list[str]] = {}
    for rule in rules:
        conditions.setdefault((rule.code, rule.severity), []).append(rule.condition)
    return [Rule(code, severity, " OR ".join(f"({c})" for c in found)) for (code, severity), found in conditions.items()]


def codes(rules: Sequence[Rule], severity: str) -> list[str]:
    return [rule.code for rule in rules if rule.severity == severity]


def blank(name: str) -> str:
    """NULL, empty, or spaces only."""
    return f"{name} IS NULL OR trim({name}) = ''"


def retail_rules(limits: Thresholds = DEFAULTS) -> list[Rule]:
    """The rules for typed retail transactions, in the order their codes are listed.

    A comparison with a NULL value is NULL, hence not broken, so a row gets the
    ``missing_`` or the ``invalid_`` code of a field but never both.
    """
    return [
        Rule("missing_transactionid", CRITICAL, blank("transactionid")),
        Rule("invalid_timestamp", CRITICAL, "transactionts_parsed IS NULL"),
        Rule("missing_amount", CRITICAL, "amount_parsed IS NULL"),
        Rule("invalid_amount", CRITICAL, f"amount_parsed < {float(limits.amount_min)!r}D"),
        Rule("missing_quantity", CRITICAL, "quantity_parsed IS NULL"),
        Rule("invalid_quantity", CRITICAL, f"quantity_parsed < {int(limits.quantity_min)}"),
        Rule("missing_storeid", WARNING, blank("storeid")),
        Rule("missing_productid", WARNING, blank("productid")),
    ]


def reason_array(rules: Sequence[Rule], severity: str) -> Column:
    """The codes a row breaks, in rule order, as an array that is empty for a good row.

    One-element arrays are concatenated because that compiles into the generated
    code; filtering an array of optional codes runs an interpreted lambda per row
    and measured about ten times slower.
    """
    none = "CAST(array() AS ARRAY<STRING>)"
    picked = [
        f"IF({rule.condition}, array('{rule.code}'), {none})"
        for rule in merged(rules)
        if rule.severity == severity
    ]
    return F.expr(f"concat({', '.join(picked)})" if picked else none)
