"""SQL expressions for guarded rates, exact half-even rounding and percent text.

They are written as SQL text because a report needs dozens of them: one ``F.expr``
per output column builds much faster than a tree of Column objects.
"""

from __future__ import annotations


def round_half_even(value: str, places: int) -> str:
    """``value`` at ``places`` decimals, ties to even, decided on the exact binary value.

    Spark's ``round`` and ``bround`` look at the shortest decimal text of a double,
    so they see a tie where the stored value lies a little off it.  Here the double
    is split into two halves (by 2**27 + 1) whose products with a small integer are
    exact, and compared with the midpoint without any rounding error.  The lambdas
    only name intermediate values; they are interpreted, which suits per-batch
    values but would be slow on transaction rows.
    """
    scale = f"{10**places}D"
    return f"""
        element_at(transform(transform(transform(array(CAST({value} AS DOUBLE)),
            x -> struct(x AS x,
                        CAST(floor(x * {scale}) AS DOUBLE) AS below,
                        x * 134217729D - (x * 134217729D - x) AS high)),
            s -> struct(s.below AS below,
                        (s.high * (2 * {scale}) - (s.below * 2 + 1))
                        + (s.x - s.high) * (2 * {scale}) AS past)),
            s -> (s.below + IF(s.past > 0 OR (s.past = 0 AND s.below % 2 <> 0), 1D, 0D)) / {scale}), 1)
    """


def ratio(part: str, whole: str) -> str:
    """``part / whole``, 0 when there is nothing to divide by."""
    return f"coalesce(try_divide({part}, {whole}), 0D)"


def rate(part: str, whole: str) -> str:
    """``ratio`` at the six decimals a report stores."""
    return round_half_even(ratio(part, whole), 6)


def percent(value: str) -> str:
    """A rate as text with two decimals, such as ``12.00%``."""
    return f"format_string('%.2f%%', {round_half_even(f'({value}) * 100', 2)})"
