"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyfold.functions.sqltext import ident

# Low bits per partial sum (see avg_2dp).
_SPLIT_BITS = 16


def avg_2dp(c: str | Column) -> Column:
    """``ROUND(AVG(c), 2)`` computed exactly, for values with at most two
    decimals (the outputs of ``scale_round(..., 2)``).

    A floating-point average depends on the order of summation, which changes
    with the partitioning; near a tie (x.xx5) it then rounds either way. Here
    every value becomes whole cents (a ``bigint``) and the cents are summed
    exactly; the quotient is rounded half away from zero in integer
    arithmetic, so the result is the same on any cluster layout.

    The per-row work stays in ``bigint``: the cents are split into a high part
    (``cents >> 16``) and a low part (``cents & 0xFFFF``) summed separately,
    which cannot overflow below about 10^14 rows per group, and the two sums
    are recombined in ``decimal(38,0)`` once per group. (A ``decimal`` sum
    buffer wider than 18 digits would cost an allocation per row.) Nulls are
    skipped, and so are NaN, infinities and values beyond the bigint range of
    cents, which are no measurements; values with more decimals count rounded
    to cents. No value gives null.
    """
    if not isinstance(c, str):
        raise TypeError("avg_2dp takes a column name")
    return _quotient(*(sql for _, sql in _parts(c)))


def _parts(c: str) -> list[tuple[str, str]]:
    """(name, SQL) of the three partial sums an exact average is made of."""
    # x * 100 lies within rounding error of a whole number, so rint (no
    # BigDecimal, unlike round) gives the same integer.
    cents = f"TRY_CAST(rint({ident(c)} * 100.0D) AS BIGINT)"
    return [(f"{c}__high", f"sum(shiftright({cents}, {_SPLIT_BITS}))"),
            (f"{c}__low", f"sum({cents} & {(1 << _SPLIT_BITS) - 1})"), (f"{c}__n", f"count({cents})")]


def _quotient(hi: str, lo: str, n: str) -> Column:
    n = f"CAST({n} AS DECIMAL(38,0))"
    total = f"(CAST({hi} AS DECIMAL(38,0)) * {1 << _SPLIT_BITS} + {lo})"
    num, den = f"(abs({total}) * 2 + {n})", f"({n} * 2)"
    quotient = f"CAST(({num} - {num} % {den}) / {den} AS DOUBLE)"
    return F.expr(f"CASE WHEN {n} > 0 THEN (CASE WHEN {total} < 0 THEN -{quotient} "
                  f"ELSE {quotient} END) / 100.0D END")


def avg_2dp_state(c: str) -> list[Column]:
    """The partial sums of ``avg_2dp`` as columns; sums of them are partial sums again."""
    return [F.expr(sql).alias(name) for name, sql in _parts(c)]


def avg_2dp_state_names(c: str) -> list[str]:
    return [name for name, _ in _parts(c)]


def avg_2dp_of_state(c: str) -> Column:
    """``avg_2dp`` of ``c`` from stored partial sums."""
    return _quotient(*(f"sum({ident(name)})" for name in avg_2dp_state_names(c)))
