"""Row filters. Each is a plain predicate, so Catalyst can push it into a
Parquet scan when the columns come straight from one."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.functions.sqltext import ident


def all_present(columns: Iterable[str]) -> Column:
    """True when none of ``columns`` is null."""
    terms = [f"{ident(c)} IS NOT NULL" for c in columns]
    return F.expr(" AND ".join(terms)) if terms else F.lit(True)


def require_non_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows where every listed column is non-null."""
    return df.filter(all_present(list(columns)))


def in_box(lat: str, lon: str, box: tuple[float, float, float, float]) -> Column:
    """Inclusive bounding box ``(min_lat, max_lat, min_lon, max_lon)``."""
    min_lat, max_lat, min_lon, max_lon = box
    return (F.col(lat).between(F.lit(float(min_lat)), F.lit(float(max_lat)))
            & F.col(lon).between(F.lit(float(min_lon)), F.lit(float(max_lon))))


def within_box(df: DataFrame, box: tuple[float, float, float, float],
               lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.filter(in_box(lat, lon, box))

