"""Deduplication by key.

The ordered form is an aggregate (``min_by``) rather than a window: the
aggregate is combined map-side before the shuffle, so a key that holds a large
share of all rows is reduced to one row per task first and never lands whole in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def dedup_by(df: DataFrame, keys: str | Sequence[str],
             order: str | Column | Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key.

    Without ``order`` any row of the key may survive (``dropDuplicates``).
    With ``order`` (column names or expressions, e.g. ``-F.col("t")`` for the
    largest ``t``) the row with the smallest order value is kept; give a
    unique tie-break column for a repeatable result. Null keys form one group,
    as in ``dropDuplicates``.
    """
    keys = _names(keys)
    if order is None:
        return df.dropDuplicates(keys)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    ranked = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    kept = (df.groupBy(*keys)
              .agg(F.min_by(F.struct(*[F.col(c) for c in others]), ranked).alias("_kept")))
    return kept.select(*keys, "_kept.*").select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null keys that occur more than once, with their count."""
    present = None
    for k in keys:
        term = F.col(k).isNotNull()
        present = term if present is None else present & term
    return (df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
              .filter(F.col("copies") > 1))
