"""Scalar column functions (casts, unit conversion, dates)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyfold.functions.sqltext import ident, literal

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def slot(array: ColumnOrName, position: int, type_name: str = "string") -> Column:
    """Element ``position`` of an array, cast to ``type_name``.

    ``get`` gives null past the end and ``try_cast`` null for text that does
    not parse, as Spark 3.5 did without ANSI mode. An integer slot is read
    through double, so ``'5.0'`` gives 5 as before.
    """
    if isinstance(array, str):
        value = f"get({ident(array)}, {position})"
        if type_name == "string":
            return F.expr(value)
        if type_name in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
            return F.expr(f"try_cast(try_cast({value} AS double) AS {type_name})")
        return F.expr(f"try_cast({value} AS {type_name})")
    value = F.get(_col(array), F.lit(position))
    if type_name == "string":
        return value
    if type_name in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
        return value.try_cast("double").try_cast(type_name)
    return value.try_cast(type_name)


def variant_slot(array: str, position: int, type_name: str = "string") -> Column:
    """``slot`` of an array of variants: null past the end, for a JSON null and for what does not convert."""
    value = f"get({ident(array)}, {position})"
    if type_name in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
        return F.expr(f"try_cast(try_variant_get({value}, '$', 'double') AS {type_name})")
    return F.expr(f"try_variant_get({value}, '$', {literal(type_name)})")


def trim_upper(c: ColumnOrName) -> Column:
    """``upper(trim(c))``; trims spaces only."""
    if isinstance(c, str):
        return F.expr(f"upper(trim({ident(c)}))")
    return F.upper(F.trim(_col(c)))


def scale_round(c: ColumnOrName, factor: float, digits: int = 2) -> Column:
    """Unit conversion: ``round(c * factor, digits)``, half away from zero."""
    if isinstance(c, str):
        return F.expr(f"round({ident(c)} * {literal(float(factor))}, {int(digits)})")
    return F.round(_col(c) * F.lit(float(factor)), digits)


def local_date(ts: ColumnOrName, zone: str) -> Column:
    """Calendar day of a UTC ``timestamp_ntz`` in the named zone."""
    if isinstance(ts, str):
        return F.expr(f"to_date(convert_timezone('UTC', {literal(zone)}, {ident(ts)}))")
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts)))


def utc_day(name: str, type_name: str) -> Column:
    """UTC calendar day of a timestamp column, whatever the session zone:
    an instant (``timestamp``) through its epoch seconds, a wall-clock
    ``timestamp_ntz`` (already UTC wall time) by its own date."""
    if type_name == "timestamp_ntz":
        return F.expr(f"to_date({ident(name)})")
    return F.expr(f"date_from_unix_date(CAST(floor(unix_seconds({ident(name)}) / 86400) AS INT))")


def utc_date_of_epoch(seconds: ColumnOrName) -> Column:
    """UTC day of epoch seconds, independent of the session zone."""
    if isinstance(seconds, str):
        return F.expr(f"date_from_unix_date(CAST(floor({ident(seconds)} / 86400) AS INT))")
    return F.date_from_unix_date(F.floor(_col(seconds) / F.lit(86400)).cast("int"))
