"""Labelling expressions: code tables, ordered cases and bands.

All of them compile to one ``CASE WHEN`` inside generated code; a code table
is small and fixed, so no join is needed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyfold.functions.sqltext import ident, literal, string_literal

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_sql(cases: Iterable[tuple[str, str]], default: str | None) -> str:
    """``CASE WHEN cond THEN 'label' ... ELSE 'default' END`` from SQL conditions."""
    whens = " ".join(f"WHEN {cond} THEN {string_literal(label)}" for cond, label in cases)
    tail = "NULL" if default is None else string_literal(default)
    return f"CASE {whens} ELSE {tail} END" if whens else tail


def code_label(c: ColumnOrName, mapping: Mapping[object, str], default: str) -> Column:
    """Map codes to labels; any other value, null included, gives ``default``."""
    if isinstance(c, str):
        name = ident(c)
        return F.expr(case_sql([(f"{name} = {literal(k)}", v) for k, v in mapping.items()], default))
    col = _col(c)
    expr = None
    for code, label in mapping.items():
        cond = col == F.lit(code)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def first_match(cases: Iterable[tuple[Column | str, str]], default: str) -> Column:
    """The label of the first true condition, else ``default``.

    Conditions are Columns or SQL text (all of one kind). A null condition
    counts as false, so it falls through to later cases.
    """
    cases = list(cases)
    if all(isinstance(cond, str) for cond, _ in cases):
        return F.expr(case_sql(cases, default))
    expr = None
    for cond, label in cases:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def bucketize(c: ColumnOrName, bands: Iterable[tuple[float, str]], top_label: str,
              null_label: str | None = None) -> Column:
    """Half-open bands: the first ``(upper, label)`` with ``c < upper`` wins.

    ``bands`` must be sorted by ``upper``. Values at or above the last bound
    get ``top_label``; null gets ``null_label``.
    """
    if isinstance(c, str):
        name = ident(c)
        cases = [(f"{name} IS NULL", null_label)] if null_label is not None else []
        cases += [(f"{name} < {literal(float(upper))}", label) for upper, label in bands]
        return first_match(cases, top_label)
    col = _col(c)
    cases = [(col.isNull(), null_label)] if null_label is not None else []
    cases += [(col < F.lit(float(upper)), label) for upper, label in bands]
    return first_match(cases, top_label)


def equals_label(c: ColumnOrName, value: object, yes: str, no: str) -> Column:
    """``yes`` when ``c = value``, else ``no`` (a null ``c`` gives ``no``)."""
    if isinstance(c, str):
        return first_match([(f"{ident(c)} = {literal(value)}", yes)], no)
    return F.when(_col(c) == F.lit(value), F.lit(yes)).otherwise(F.lit(no))
