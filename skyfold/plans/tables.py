"""Tables on a shared file system or in the catalog: first-run create, keyed
merge, replace, retention.

A table is named by its folder (a path, which holds a slash) or by its catalog
name (see ``skyfold.plans.named``); anything else is an error. Merges by name are
published at once, merges into a folder partition by partition.

The history table is Parquet partitioned by ``snapshot_date``, a function of
the key ``snapshot_time``, so every key lives in exactly one partition. A
merge lists and reads only the partitions its batch touches. Of these it
rewrites those that hold a key of the batch (dynamic partition overwrite); to
the others the batch's rows are appended, so a batch of new snapshots costs
its own size, not that of the day it falls on.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyfold.functions.scalar import utc_date_of_epoch
from skyfold.operators.upsert import (
    BROADCAST_MAX_BYTES, DuplicateSourceKeyError, find_matched_keys, source_stats, unique_source, upsert,
)
from skyfold.plans import named
from skyfold.schema import HISTORY_KEYS, HISTORY_UPDATE_COLUMNS
from skyfold.session import ensure_checkpoint_dir
from skyfold.sources.parquet import (
    folder_exists, hadoop_fs, partition_folder, path_exists, rebalance, write_partitions,
)

HISTORY_PARTITION = "snapshot_date"
# Upper bound on source rows for the broadcast merge plan (see
# skyfold.operators.upsert).
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
# A day that so many writes have added to is rewritten by the next merge.
MAX_WRITES_PER_PARTITION = 50


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """A catalog table or view of that name, or a path holding a Parquet dataset."""
    if named.is_path(name_or_path):
        return path_exists(spark, name_or_path)
    return spark.catalog.tableExists(name_or_path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    return spark.read.parquet(name_or_path) if named.is_path(name_or_path) else spark.table(name_or_path)


def _partition_filter(column: str, values: list) -> Column:
    present = [v for v in values if v is not None]
    cond = F.col(column).isin(present) if present else F.lit(False)
    if len(present) != len(values):
        cond = cond | F.col(column).isNull()
    return cond


def touched_partitions(spark: SparkSession, path: str, partition_col: str, values: list) -> DataFrame | None:
    """The table restricted to some partition values (``None`` for the null
    partition), or None if it has none of them. Only their folders are listed."""
    base = path.rstrip("/")
    folders = [f"{base}/{partition_folder(partition_col, v)}" for v in values]
    there = [f for f in folders if folder_exists(spark, f)]
    if not there:
        return None
    return (spark.read.option("basePath", base).parquet(*there)
            .filter(_partition_filter(partition_col, values)))


def partitions_of(spark: SparkSession, table: str, partition_col: str, values: list) -> DataFrame | None:
    """The rows of a table (a path or a name) in some partitions; None if a folder has none of them."""
    if named.is_path(table):
        return touched_partitions(spark, table, partition_col, values)
    return spark.table(table).filter(_partition_filter(partition_col, values)) if values else None


def put_partitions(df: DataFrame, table: str, partition_col: str, values: list) -> int:
    """Replace the partitions of ``values``, which ``df`` covers, in a table that exists."""
    if named.is_path(table):
        return write_partitions(df, table, partition_col)
    spark = df.sparkSession
    return named.change_partitions(spark, named.find(spark, table), df, values, None)


def with_history_partition(df: DataFrame) -> DataFrame:
    return df.withColumn(HISTORY_PARTITION, utc_date_of_epoch("snapshot_time"))


def read_history(spark: SparkSession, table: str) -> DataFrame:
    """The stored history without its partition column."""
    return read_table(spark, table).drop(HISTORY_PARTITION)


@dataclass
class _Changes:
    """What a merge does: the partitions ``matched`` become ``rewritten``, ``added`` is appended."""

    rewritten: DataFrame | None
    matched: list
    added: DataFrame | None
    touched: list


def _changes(source: DataFrame, keys: list[str], update: Sequence[str], partition_col: str, unique: bool,
             broadcast_max_rows: int, target_of: Callable[[list], DataFrame | None],
             rewrite_too: Callable[[list], list], bucketed: bool) -> _Changes:
    """Plan a merge of a stored ``source``.

    One job measures the source (rows, bytes, repeated keys, touched partitions),
    one finds the keys that the touched partitions hold, reading key columns
    only. ``target_of`` gives the target's rows in some partitions;
    ``rewrite_too``: touched partitions to rewrite even where no key matches.
    """
    stats = source_stats(source, keys, partition_col)
    if not unique and stats["max_copies"] > 1:
        raise DuplicateSourceKeyError(f"source has {stats['max_copies']} rows for one key of {keys}")
    touched = stats["touched"]
    small = stats["rows"] <= broadcast_max_rows and stats["bytes"] <= BROADCAST_MAX_BYTES
    target = target_of(touched)
    matched, found = [], None
    if target is not None:
        found = find_matched_keys(target, source, keys, [partition_col], broadcast_source=small)
        if small:       # no more keys than the source has: kept for the merge
            found = found.checkpoint(eager=True)
        matched = [r[0] for r in found.select(partition_col).distinct().collect()]   # at most the touched partitions
        matched += [v for v in rewrite_too(touched) if v not in matched]
    in_matched = F.coalesce(_partition_filter(partition_col, matched), F.lit(False))
    rewritten = None
    if matched:
        target = target_of(matched)
        rewritten = upsert(target, source.filter(in_matched).select(*target.columns), keys, update,
                           check_unique=False, broadcast_max_rows=broadcast_max_rows, source_rows=stats["rows"],
                           source_bytes=stats["bytes"], matched_keys=found if small else None, spread_nulls=not bucketed)
    added = source.filter(~in_matched) if len(matched) < len(touched) else None
    return _Changes(rewritten, matched, added, touched)


def merge_into(spark: SparkSession, table: str, source: DataFrame, *,
               keys: Sequence[str] = HISTORY_KEYS,
               update: Sequence[str] = HISTORY_UPDATE_COLUMNS,
               partition_col: str = HISTORY_PARTITION,
               dedup_order: str | Sequence[str] | None = None,
               broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
               stored: bool = False, buckets: int | None = None, note: dict[str, str] | None = None) -> dict:
    """Create ``table`` (a path or a name) from ``source`` on first use, else merge into it.

    ``source`` must carry ``partition_col`` (see ``with_history_partition``).
    It is written once to the checkpoint folder, so that every job sees the
    same rows and nothing above it runs again; ``stored=True`` says that it
    reads files as it is.

    The partitions that hold a key of the source are replaced whole, the other
    source rows, which match nothing, are appended. By name both become
    visible in one step. In a folder, dynamic partition overwrite
    stages the output and swaps each partition after every task
    has read its input, so a lost executor recomputes from files that are still
    there; a run that stops between the two writes is completed by running it
    again: keyed rows already there match themselves.

    ``dedup_order`` picks one row of each source key (smallest first), on the
    first run too; without it a first batch is copied as it is, and repeated
    keys in a later one raise. ``buckets``: a table created by name is bucketed
    and sorted on the keys, and merged without a shuffle of its rows. ``note``: names and
    values published with the new version of a table by name (``named.find(...).notes``), in the same step.

    Returns ``{"created": bool, "rows_written": n, "partitions": k,
    "rewritten": r, "touched": [...]}``: rows written, number of partitions
    touched and of those rewritten, values of the touched ones (None: all).
    """
    keys = list(keys)
    ensure_checkpoint_dir(spark)
    if dedup_order is not None:
        source = unique_source(source, keys, dedup_order)
    if dedup_order is not None or not stored:
        source = source.checkpoint(eager=True)
    by_path = named.is_path(table)
    if not by_path:
        return _merge_by_name(spark, table, source, keys, update, partition_col, dedup_order is not None,
                              broadcast_max_rows, buckets, note)
    if buckets is not None:
        raise named.TableNameError("only a table by name can be bucketed")
    if not table_exists(spark, table):
        return _created(write_partitions(source, table, partition_col))
    plan = _changes(source, keys, update, partition_col, dedup_order is not None, broadcast_max_rows,
                    lambda values: touched_partitions(spark, table, partition_col, values), lambda _: [], False)
    written = write_partitions(plan.rewritten, table, partition_col) if plan.rewritten is not None else 0
    if plan.added is not None:
        written += write_partitions(plan.added, table, partition_col, append=True)
    return _merged(written, plan)


def _created(rows: int) -> dict:
    return {"created": True, "rows_written": rows, "partitions": None, "rewritten": 0, "touched": None}


def _merged(rows: int, plan: _Changes) -> dict:
    return {"created": False, "rows_written": rows, "partitions": len(plan.touched), "rewritten": len(plan.matched),
            "touched": plan.touched}


def _merge_by_name(spark: SparkSession, name: str, source: DataFrame, keys: list[str], update: Sequence[str],
                   partition_col: str, unique: bool, broadcast_max_rows: int, buckets: int | None,
                   note: dict[str, str] | None) -> dict:
    table = named.find(spark, name)
    if table is None:
        return _created(named.replace(source, name, partition_col, buckets, keys if buckets else (), note))
    lacking = [c for c in table.columns if c not in source.columns]
    if lacking:
        raise ValueError(f"source lacks columns {lacking} of {name}")
    if table.partition_by != partition_col:
        # A plain table kept in one piece is merged and replaced whole.
        rows = named.rows_of(spark, table)
        merged = upsert(rows, source.select(*rows.columns), keys, update, check_unique=not unique,
                        broadcast_max_rows=broadcast_max_rows)
        return _merged(named.replace(merged, name, table.partition_by, note=note), _Changes(None, [], None, [None]))
    counts: dict = {}
    if table.version is not None:
        for spec in named.specs_of(spark, table):
            counts[spec[partition_col]] = counts.get(spec[partition_col], 0) + 1

    def target_of(values: list) -> DataFrame | None:
        return named.rows_of(spark, table).filter(_partition_filter(partition_col, values)) if values else None

    def crowded(touched: list) -> list:
        return [v for v in touched if counts.get(None if v is None else str(v), 0) >= MAX_WRITES_PER_PARTITION]

    bucketed = list(table.bucket_by) == keys
    plan = _changes(source, keys, update, partition_col, unique, broadcast_max_rows, target_of, crowded, bucketed)
    return _merged(named.change_partitions(spark, table, plan.rewritten, plan.matched, plan.added, note), plan)


def upsert_table(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str],
                 update: Sequence[str] | None = None,
                 broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> dict:
    """Keyed upsert into an unpartitioned table (one row per key; a path or a name), created
    on first use."""
    if not table_exists(spark, table):
        rows = replace_table(source, table)
        return {"created": True, "rows_written": rows}
    target = read_table(spark, table)
    # The source (an aggregate, one row per key) is read by the check job and by
    # the merge: materialised once in the shared checkpoint folder.
    source = source.select(*target.columns).checkpoint(eager=True)
    merged = upsert(target, source, keys, update, broadcast_max_rows=broadcast_max_rows)
    return {"created": False, "rows_written": replace_table(merged, table)}


def replace_table(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Create or replace a whole table (a path or a name) from a query; returns its row count.

    By name the new version is published in one step. A folder is written
    beside the old one and takes its place by two renames
    once it is complete: a write that fails leaves the old table as it was, and
    for the moment between the renames there is none.
    """
    spark = df.sparkSession
    if not named.is_path(path):
        return named.replace(df, path, partition_by)
    seen = Observation("replaced")
    path = path.rstrip("/")
    new, old = (f"{path}__{kind}_{uuid.uuid4().hex[:8]}" for kind in ("new", "old"))
    fs, target = hadoop_fs(spark, path)
    staged, former = hadoop_fs(spark, new)[1], hadoop_fs(spark, old)[1]
    try:
        if partition_by:
            df = rebalance(df, [partition_by])
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(new)
    except Exception:
        fs.delete(staged, True)
        raise
    had = fs.exists(target)
    if had and not fs.rename(target, former):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(staged, target):
        if had:
            fs.rename(former, target)
        raise OSError(f"cannot move the new table to {path}")
    if had:
        fs.delete(former, True)
    spark.catalog.refreshByPath(path)
    return int(seen.get["rows"])


def retention_cutoff(as_of: dt.date | str, days: int) -> dt.date:
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return as_of - dt.timedelta(days=days)


def retain_recent(df: DataFrame, column: str, days: int, as_of: dt.date | str) -> DataFrame:
    """Rows whose ``column`` is on or after ``as_of - days``.

    The cut-off is a literal of the column's own type, so the comparison is
    pushed to the Parquet scan (or prunes partitions on a partition column).
    """
    cutoff = retention_cutoff(as_of, days)
    col_type = df.schema[column].dataType.simpleString()
    return df.filter(F.col(column) >= F.lit(cutoff.isoformat()).cast(col_type))


def expire_partitions(spark: SparkSession, path: str, partition_col: str, days: int,
                      as_of: dt.date | str) -> list[str]:
    """Delete date partitions older than ``as_of - days`` from a table (a path or a name).

    Only metadata is touched (like an object-store age rule); no data
    file is read or rewritten. By name, a version without the old days is published and
    their files go with ``named.vacuum``. Returns the deleted partition folders.
    """
    cutoff = retention_cutoff(as_of, days)
    if not named.is_path(path):
        return _expire_by_name(spark, path, partition_col, cutoff)
    fs, root = hadoop_fs(spark, path)
    removed = []
    prefix = f"{partition_col}="
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not (status.isDirectory() and name.startswith(prefix)):
            continue
        try:
            day = dt.date.fromisoformat(name[len(prefix):])
        except ValueError:
            continue
        if day < cutoff:
            fs.delete(status.getPath(), True)
            removed.append(name)
    return sorted(removed)


def expire_files(spark: SparkSession, path: str, days: int, as_of: dt.datetime) -> int:
    """Delete the data files below ``path`` that were last modified more than ``days`` before ``as_of``;
    returns how many.

    The age rule of an object store, for landings without date folders. Names beginning with ``_`` or ``.`` stay.
    ``as_of`` without a zone is UTC.
    """
    as_of = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
    cutoff = int((as_of - dt.timedelta(days=days)).timestamp() * 1000)
    fs, root = hadoop_fs(spark, path)
    top = fs.resolvePath(root).toString()
    files, removed = fs.listFiles(root, True), 0
    while files.hasNext():      # lazily: any number of files
        status = files.next()
        below = status.getPath().toString()[len(top):]
        if status.getModificationTime() < cutoff and not any(p.startswith(("_", ".")) for p in below.split("/")):
            fs.delete(status.getPath(), False)
            removed += 1
    return removed


def _expire_by_name(spark: SparkSession, name: str, partition_col: str, cutoff: dt.date) -> list[str]:
    table = named.find(spark, name)
    if table is None:
        raise named.TableNameError(f"no table {name!r}")
    if table.partition_by != partition_col:
        raise named.TableNameError(f"{name!r} is not partitioned by {partition_col!r}")
    old = []
    for value in named.partition_values(spark, table):
        try:
            if value is not None and dt.date.fromisoformat(value) < cutoff:
                old.append(value)
        except ValueError:
            continue
    named.drop_partitions(spark, table, old)
    return sorted(partition_folder(partition_col, v) for v in old)
