"""Data-quality profiles. Each is one aggregate over the data (partial
aggregation map-side, one small shuffle), returned as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.functions.sqltext import ident


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the number of nulls in each column."""
    columns = df.columns if columns is None else list(columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def value_counts(df: DataFrame, column: str, count_name: str = "count") -> DataFrame:
    """Rows per value, most frequent first; ties by value, ascending."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name))
              .orderBy(F.desc(count_name), F.asc_nulls_last(column)))


def top_k(df: DataFrame, column: str, k: int = 10, count_name: str = "count") -> DataFrame:
    """The ``k`` most frequent values (sort + limit plans as a top-k)."""
    return value_counts(df, column, count_name).limit(k)


class Profile:
    """Row count, null profile and value distributions of one scan.

    The rows are grouped once by all the distribution columns; that table of
    counts (a row per combination that occurs) is kept in the checkpoint folder and every report
    sums over it. The reports equal those of the functions above.
    """

    def __init__(self, df: DataFrame, distributions: Sequence[str]):
        self.columns, self.distributions = df.columns, list(distributions)
        nulls = [F.count_if(F.col(ident(c)).isNull()).alias(f"_null_{i}") for i, c in enumerate(self.columns)]
        keys = [F.col(ident(c)).alias(f"_key_{i}") for i, c in enumerate(self.distributions)]
        self.counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *nulls).checkpoint(eager=True)

    def row_count(self, name: str = "row_count") -> DataFrame:
        return self.counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias(name))

    def null_profile(self) -> DataFrame:
        return self.counts.agg(*(F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).cast("long").alias(c)
                                 for i, c in enumerate(self.columns)))

    def value_counts(self, column: str, count_name: str = "count") -> DataFrame:
        key = f"_key_{self.distributions.index(column)}"
        return (self.counts.groupBy(F.col(key).alias(column)).agg(F.sum("_n").alias(count_name))
                .orderBy(F.desc(count_name), F.asc_nulls_last(ident(column))))

    def top_k(self, column: str, k: int = 10, count_name: str = "count") -> DataFrame:
        return self.value_counts(column, count_name).limit(k)


def loss_report(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before a filter, after it and lost, in one pass."""
    return (df.agg(F.count(F.lit(1)).alias("rows_before"),
                   F.count_if(keep).alias("rows_after"))
              .withColumn("rows_lost", F.col("rows_before") - F.col("rows_after")))
