"""SQL text helpers.

A column expression written as SQL text is parsed once on the JVM
(``F.expr`` / ``selectExpr``): one call from Python, where building the same
expression from ``Column`` objects costs one call per node. The plan that
Catalyst gets is the same.
"""

from __future__ import annotations


def ident(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def string_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal(value: object) -> str:
    """SQL literal for a Python value (double literals carry the ``D`` suffix)."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    return string_literal(str(value))
