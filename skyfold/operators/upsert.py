"""Keyed upsert (MERGE) of a source batch into a target, as DataFrames.

Semantics, per target row and source row on equal, non-null keys:

* matched: the ``update`` columns come from the source (a source null
  overwrites), every other column keeps the target value;
* source row without a match (null keys included): inserted whole;
* target row without a match: kept.

Two plans give the same rows, and each reads the target's rows once:

* ``full_outer``: one shuffle join of target and source with presence flags.
  General; the target is shuffled once, or not at all if it is bucketed on the
  keys. A row with a null key never matches; a hash of its columns as a further
  join key spreads such rows over all tasks.
* ``small_source``: used only when the source is checked to have at most
  ``broadcast_max_rows`` rows and ``broadcast_max_bytes`` of data. The source
  is broadcast, so the target takes its new values where it lies and is never
  shuffled; what to insert is found by a second look at the target's key
  columns only, or from ``matched_keys`` if the caller has looked already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.operators.dedup import dedup_by, duplicate_keys
from skyfold.functions.sqltext import ident
from skyfold.operators.filters import all_present


# Upper bound on the data of the source that the broadcast plan ships.
BROADCAST_MAX_BYTES = 256 << 20


class DuplicateSourceKeyError(ValueError):
    """Two source rows share one key; a MERGE would be ambiguous."""


def _any_null(keys: Sequence[str]) -> Column:
    return F.expr(" OR ".join(f"{ident(k)} IS NULL" for k in keys))


def unique_source(source: DataFrame, keys: Sequence[str],
                  dedup_order: str | Sequence[str] | None = None,
                  check_unique: bool = True) -> DataFrame:
    """Make the source unique on its non-null keys.

    With ``dedup_order`` the first row per key wins. Without it a duplicate
    key raises, as the warehouse MERGE does. Rows with a null key never match
    and are all kept.
    """
    keys = list(keys)
    if dedup_order is not None:
        keyed = dedup_by(source.filter(all_present(keys)), keys, dedup_order)
        return keyed.unionByName(source.filter(_any_null(keys)))
    if check_unique:
        dup = duplicate_keys(source, keys).limit(1).collect()
        if dup:
            raise DuplicateSourceKeyError(
                f"source has more than one row for key {dup[0].asDict()}")
    return source


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row: 16 bytes per column, and the text of those without a fixed width."""
    fixed = ("Boolean", "Byte", "Short", "Integer", "Long", "Float", "Double", "Date", "Timestamp", "TimestampNTZ", "Decimal")
    wide = [f.name for f in df.schema.fields if type(f.dataType).__name__.removesuffix("Type") not in fixed]
    terms = [f"coalesce(octet_length(CAST({ident(c)} AS STRING)), 0)" for c in wide]
    return F.expr(" + ".join([f"CAST({16 * len(df.columns)} AS BIGINT)", *terms]))


def source_stats(source: DataFrame, keys: Sequence[str], partition_col: str | None = None) -> dict:
    """One job over the source: row count, the largest number of rows sharing
    one non-null key, the size of its data (what the broadcast plan ships),
    and (optionally) the distinct values of a partition column that is a
    function of the key."""
    keys = list(keys)
    group = keys + ([partition_col] if partition_col and partition_col not in keys else [])
    per_key = source.groupBy(*group).agg(F.count(F.lit(1)).alias("_c"), F.sum(_row_bytes(source)).alias("_b"),
                                         all_present(keys).alias("_keyed"))
    aggs = [F.sum("_c").alias("rows"),
            F.max(F.when(F.col("_keyed"), F.col("_c"))).alias("max_copies"),
            F.sum("_b").alias("bytes")]
    if partition_col:
        # one value per partition (days): a short list
        aggs += [F.collect_set(partition_col).alias("touched"),
                 F.max(F.col(partition_col).isNull()).alias("null_partition")]
    row = per_key.agg(*aggs).first()
    out = {"rows": int(row["rows"] or 0), "max_copies": int(row["max_copies"] or 0),
           "bytes": int(row["bytes"] or 0)}
    if partition_col:
        out["touched"] = list(row["touched"]) + ([None] if row["null_partition"] else [])
    return out


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update: Sequence[str] | None = None, *,
           dedup_order: str | Sequence[str] | None = None,
           check_unique: bool = True,
           broadcast_max_rows: int = 0,
           broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
           source_rows: int | None = None,
           source_bytes: int | None = None,
           matched_keys: DataFrame | None = None,
           spread_nulls: bool = True) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``; see the module notes.

    ``update`` defaults to every non-key column. The result has the target's
    columns in the target's order. ``source_rows`` and ``source_bytes``, when the
    caller already measured the source, save the job that decides the plan;
    ``matched_keys`` are the distinct keys of the source that the target holds.
    ``spread_nulls=False`` joins on the keys alone, as a bucketed target needs.
    """
    keys = list(keys)
    columns = target.columns
    missing = [c for c in columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    update = [c for c in columns if c not in keys] if update is None else list(update)
    keep = [c for c in columns if c not in keys and c not in update]
    source = source.select(*columns)
    if dedup_order is not None:
        source = unique_source(source, keys, dedup_order)
    need_check = dedup_order is None and check_unique
    need_size = broadcast_max_rows > 0 and (source_rows is None or source_bytes is None)
    if need_check or need_size:
        # One job answers both questions: duplicate keys and source size.
        stats = source_stats(source, keys)
        if need_check and stats["max_copies"] > 1:
            raise DuplicateSourceKeyError(
                f"source has {stats['max_copies']} rows for one key of {keys}")
        source_rows = stats["rows"] if source_rows is None else source_rows
        source_bytes = stats["bytes"] if source_bytes is None else source_bytes
    if (broadcast_max_rows > 0 and source_rows <= broadcast_max_rows
            and source_bytes <= broadcast_max_bytes):
        return _merge_small_source(target, source, keys, update, columns, matched_keys)
    return _merge_full_outer(target, source, keys, update, columns, spread_nulls)


def _merge_full_outer(target: DataFrame, source: DataFrame, keys: list[str],
                      update: list[str], columns: list[str], spread_nulls: bool) -> DataFrame:
    spread = []
    if spread_nulls:
        # Rows without a key match nothing wherever they go; by their hash they go everywhere.
        hashable = [f.name for f in target.schema.fields if "map<" not in f.dataType.simpleString()]
        own = F.expr(f"CASE WHEN {' OR '.join(f'{ident(k)} IS NULL' for k in keys)} "
                     f"THEN xxhash64({', '.join(map(ident, hashable))}) ELSE 0L END")
        target, source = target.withColumn("_spread", own), source.withColumn("_spread", own)
        spread = ["_spread"]
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    cond = [F.col(f"t.{ident(k)}") == F.col(f"s.{ident(k)}") for k in [*keys, *spread]]
    joined = t.join(s, on=cond, how="full_outer")
    in_s = F.col("s._in_s").isNotNull()
    in_t = F.col("t._in_t").isNotNull()
    out = []
    for c in columns:
        of_t, of_s = F.col(f"t.{ident(c)}"), F.col(f"s.{ident(c)}")
        if c in keys or c in update:
            out.append(F.when(in_s, of_s).otherwise(of_t).alias(c))
        else:
            out.append(F.when(in_t, of_t).otherwise(of_s).alias(c))
    return joined.select(*out)


def find_matched_keys(target: DataFrame, source: DataFrame, keys: Sequence[str],
                      carry: Sequence[str] = (), broadcast_source: bool = True) -> DataFrame:
    """The distinct keys (and ``carry`` columns, functions of them) of ``source`` that
    ``target`` holds; reads those columns of the target only. ``broadcast_source``: the
    source's keys are known to be few."""
    wanted = source.select(*keys).filter(all_present(keys))
    if broadcast_source:
        wanted = F.broadcast(wanted)
    return (target.select(*dict.fromkeys([*keys, *carry])).join(wanted, on=list(keys), how="left_semi").distinct())


def _merge_small_source(target: DataFrame, source: DataFrame, keys: list[str], update: list[str],
                        columns: list[str], matched_keys: DataFrame | None) -> DataFrame:
    t = target.alias("t")
    s = F.broadcast(source.filter(all_present(keys)).withColumn("_in_s", F.lit(True))).alias("s")
    cond = [F.col(f"t.{ident(k)}") == F.col(f"s.{ident(k)}") for k in keys]
    in_s = F.col("s._in_s").isNotNull()
    merged = t.join(s, on=cond, how="left").select(*(
        F.when(in_s, F.col(f"s.{ident(c)}")).otherwise(F.col(f"t.{ident(c)}")).alias(c) if c in update
        else F.col(f"t.{ident(c)}").alias(c) for c in columns))
    if matched_keys is None:
        matched_keys = find_matched_keys(target, source, keys)
    # No more keys than the measured source has.
    new = source.join(F.broadcast(matched_keys.select(*keys)), on=keys, how="left_anti").select(*columns)
    return merged.unionByName(new)
