"""Reshaping: nested snapshot documents to flat typed rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions.scalar import slot, variant_slot
from skyfold.schema import STATE_SLOTS


def explode_states(docs: DataFrame, states: str = "states", time: str = "time",
                   vector: str = "flight", time_alias: str = "snapshot_time") -> DataFrame:
    """One row per state vector, next to the snapshot time.

    ``explode`` gives no row for a null or empty list.
    """
    return docs.select(F.explode(F.col(states)).alias(vector), F.col(time).alias(time_alias))


def map_slots(rows: DataFrame, slots: Sequence[tuple[int, str, str]] = STATE_SLOTS,
              vector: str = "flight", keep: Iterable[str] = ("snapshot_time",)) -> DataFrame:
    """Positional array (of text, or of variants) to named, typed columns, driven by a slot table."""
    read = variant_slot if "variant" in rows.schema[vector].dataType.simpleString() else slot
    return rows.select(*keep, *[read(vector, pos, typ).alias(name) for pos, name, typ in slots])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns in place (their position is kept)."""
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)

