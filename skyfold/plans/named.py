"""Tables by catalog name, replaced by one metadata operation.

A name such as ``history`` or ``marts.dim_countries`` is a view over its
current version, an external Parquet table ``<name>__v<number>``. A write

1. creates the next version table,
2. enters in it the partitions it keeps (their folders stay where they are),
3. inserts the new rows, into folders of their own, and
4. points the view at it (``CREATE OR REPLACE VIEW``).

Only step 4 changes what readers see, and it changes all partitions at once: a
writer stopped before it leaves the old table, after it the new one. Nothing
is overwritten; a query that resolved the old version goes on reading it until
``vacuum`` removes versions older than those kept.

Version tables are partitioned by the table's partition column and by
``_write``, which names the write a folder came from, so rows can be added to
a day without touching its files. They may be bucketed and sorted on the key:
a merge then joins bucket with bucket and only the batch is shuffled.

A plain catalog table that was not made here can be merged into and replaced
too, through ``insertInto``; it has no versions, so its partitions change one
by one. One writer at a time is assumed; a second one is noticed where it can be.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace as changed

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyfold.functions.sqltext import ident, literal
from skyfold.session import ensure_checkpoint_dir
from skyfold.sources.parquet import hadoop_fs, rebalance

WRITE_COLUMN = "_write"
VERSION_PROPERTY = "skyfold.version"
NOTE_PREFIX = "skyfold.note."
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}")
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_PARTITIONS_PER_STATEMENT = 500


class TableNameError(ValueError):
    """Neither a path nor a name of a table that can be written."""


class ConcurrentWriteError(RuntimeError):
    """Another writer published a version in the meantime."""


def is_path(target: str) -> bool:
    """A path holds a slash; anything else must be a catalog name."""
    if "/" in target:
        return True
    if not _NAME.fullmatch(target):
        raise TableNameError(f"{target!r} is neither a path (which holds a '/') nor a table name")
    return False


def _split(spark: SparkSession, name: str) -> tuple[str, str]:
    """(database, table) of a name; the database must exist."""
    parts = name.split(".")
    if len(parts) == 3 and parts[0] != "spark_catalog":
        raise TableNameError(f"{name!r}: only the session catalog is supported")
    database = parts[-2] if len(parts) > 1 else spark.catalog.currentDatabase()
    if not spark.catalog.databaseExists(database):
        raise TableNameError(f"{name!r}: no database {database!r}")
    return database, parts[-1]


@dataclass(frozen=True)
class NamedTable:
    """A table that exists: ``version`` is None for a plain catalog table."""

    database: str
    name: str
    version: int | None
    columns: tuple[str, ...]
    partition_by: str | None
    buckets: int | None
    bucket_by: tuple[str, ...]
    #: What writers noted with the version they published (see ``note`` of ``merge_into``).
    notes: dict[str, str] = field(default_factory=dict)

    @property
    def full_name(self) -> str:
        return f"{ident(self.database)}.{ident(self.name)}"

    @property
    def stored(self) -> str:
        """What holds the rows."""
        return self.full_name if self.version is None else version_name(self.database, self.name, self.version)


def version_name(database: str, name: str, version: int) -> str:
    return f"{ident(database)}.{ident(f'{name}__v{version}')}"


def _layout(spark: SparkSession, stored: str) -> tuple[list[str], int | None, list[str]]:
    """(partition columns, number of buckets, bucket columns) of a catalog table."""
    partitions = [c.name for c in spark.catalog.listColumns(stored) if c.isPartition]
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {stored}").collect()}
    buckets = told.get("Num Buckets")
    by = re.findall(r"`([^`]+)`", told.get("Bucket Columns") or "")
    return partitions, int(buckets) if buckets else None, by


def find(spark: SparkSession, name: str) -> NamedTable | None:
    """The table of that name, or None. A temporary view, or a view made elsewhere, is an error."""
    database, table = _split(spark, name)
    full = f"{ident(database)}.{ident(table)}"
    if not spark.catalog.tableExists(full):
        if "." not in name and spark.catalog.tableExists(name):
            raise TableNameError(f"{name!r} is a temporary view")
        return None
    kind = spark.catalog.getTable(full).tableType
    version, notes = None, {}
    stored = full
    if kind == "VIEW":
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}
        if VERSION_PROPERTY not in properties:
            raise TableNameError(f"{name!r} is a view, not a table")
        version = int(properties[VERSION_PROPERTY])
        notes = {k.removeprefix(NOTE_PREFIX): v for k, v in properties.items() if k.startswith(NOTE_PREFIX)}
        stored = version_name(database, table, version)
    partitions, buckets, by = _layout(spark, stored)
    partitions = [p for p in partitions if p != WRITE_COLUMN]
    if len(partitions) > 1:
        raise TableNameError(f"{name!r} has several partition columns: {partitions}")
    columns = tuple(c for c in spark.table(full).columns)
    return NamedTable(database, table, version, columns, partitions[0] if partitions else None, buckets, tuple(by),
                      notes)


def rows_of(spark: SparkSession, table: NamedTable) -> DataFrame:
    """The rows of exactly this version, whatever is published later."""
    return spark.table(table.stored).select(*table.columns)


def _root(spark: SparkSession, database: str, name: str) -> str:
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}__data"


def _versions(spark: SparkSession, database: str, name: str) -> list[int]:
    prefix = f"{name}__v".lower()
    found = [t.name for t in spark.catalog.listTables(database, f"{name}__v*")]
    return sorted(int(t[len(prefix):]) for t in found if t.lower().startswith(prefix) and t[len(prefix):].isdigit())


# -- the four steps of a write -------------------------------------------------

def _create_version(spark: SparkSession, table: NamedTable, schema: DataFrame) -> None:
    fields = ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in
                       sorted(schema.schema.fields, key=lambda f: f.name == table.partition_by))
    partitions = ", ".join(ident(c) for c in (table.partition_by, WRITE_COLUMN) if c)
    clustered = ""
    if table.buckets:
        keys = ", ".join(map(ident, table.bucket_by))
        clustered = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {table.buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {table.stored} ({fields}, {ident(WRITE_COLUMN)} STRING) USING parquet "
              f"PARTITIONED BY ({partitions}) {clustered} LOCATION {literal(_root(spark, table.database, table.name))}")


def _folder_specs(spark: SparkSession, stored: str) -> list[dict[str, str | None]]:
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    out = []
    for row in spark.sql(f"SHOW PARTITIONS {stored}").collect():
        pairs = (kv.split("=", 1) for kv in row["partition"].split("/"))
        out.append({k: None if v == _NULL_FOLDER else unescape(v) for k, v in pairs})
    return out


def specs_of(spark: SparkSession, table: NamedTable) -> list[dict[str, str | None]]:
    """Partition values of a table, one entry per folder; metadata only."""
    return _folder_specs(spark, table.stored)


def _enter_partitions(spark: SparkSession, table: NamedTable, specs: list[dict[str, str | None]]) -> None:
    """Register folders that other versions wrote; no file is listed or moved."""
    for at in range(0, len(specs), _PARTITIONS_PER_STATEMENT):
        parts = []
        for spec in specs[at:at + _PARTITIONS_PER_STATEMENT]:
            values = ", ".join(f"{ident(k)} = {'NULL' if v is None else literal(v)}" for k, v in spec.items())
            parts.append(f"PARTITION ({values})")
        spark.sql(f"ALTER TABLE {table.stored} ADD {' '.join(parts)}")


def _insert(table: NamedTable, rows: DataFrame, write: str) -> int:
    seen = Observation("inserted")
    last = [c for c in (table.partition_by,) if c]
    ordered = [c for c in table.columns if c not in last] + last
    rows = rows.select(*map(ident, ordered), F.lit(write).alias(WRITE_COLUMN))
    if table.buckets is None and table.partition_by:
        rows = rebalance(rows, [table.partition_by])
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(table.stored)
    return int(seen.get["rows"])


def _switch(spark: SparkSession, table: NamedTable) -> None:
    columns = ", ".join(map(ident, table.columns))
    properties = {VERSION_PROPERTY: str(table.version)} | {NOTE_PREFIX + k: v for k, v in table.notes.items()}
    spark.sql(f"CREATE OR REPLACE VIEW {table.full_name} TBLPROPERTIES ("
              + ", ".join(f"{literal(k)} = {literal(v)}" for k, v in properties.items())
              + f") AS SELECT {columns} FROM {table.stored}")


def _publish(spark: SparkSession, new: NamedTable, rows: DataFrame | None, kept: list[dict],
             base: NamedTable | None) -> int:
    """Write the next version: ``kept`` folders of ``base`` and ``rows``; returns the rows written."""
    write = uuid.uuid4().hex[:12]
    new = changed(new, notes=(base.notes if base else {}) | new.notes)
    made = False
    schema = rows if rows is not None else rows_of(spark, base)
    try:
        _create_version(spark, new, schema.select(*map(ident, new.columns)))
        made = True
        _enter_partitions(spark, new, kept)
        written = _insert(new, rows, write) if rows is not None else 0
        now = find(spark, f"{new.database}.{new.name}")
        if (now and now.version) != (base and base.version):
            raise ConcurrentWriteError(f"{new.full_name} was published by another writer")
        _switch(spark, new)
    except Exception:
        # A version that readers never saw goes. What a killed writer leaves, vacuum removes.
        now = find(spark, f"{new.database}.{new.name}") if made else None
        if made and (now is None or now.version != new.version):
            spark.sql(f"DROP TABLE IF EXISTS {new.stored}")
            _delete_writes(spark, new, {write})
        raise
    return written


def _next(spark: SparkSession, database: str, name: str, columns: Sequence[str], partition_by: str | None,
          buckets: int | None, bucket_by: Sequence[str], note: dict[str, str] | None = None) -> NamedTable:
    version = max(_versions(spark, database, name), default=0) + 1
    return NamedTable(database, name, version, tuple(columns), partition_by, buckets, tuple(bucket_by), note or {})


def replace(df: DataFrame, name: str, partition_by: str | None = None, buckets: int | None = None,
            bucket_by: Sequence[str] = (), note: dict[str, str] | None = None) -> int:
    """Create or replace a whole table; returns its row count.

    ``df`` may read the table itself. ``note`` is published with the version. A plain catalog table keeps its layout and is
    overwritten by ``insertInto`` (its columns must match by name).
    """
    spark = df.sparkSession
    base = find(spark, name)
    if base is not None and base.version is None:
        return _overwrite_plain(spark, base, df)
    database, table = _split(spark, name)
    if WRITE_COLUMN in df.columns:
        raise TableNameError(f"column {WRITE_COLUMN!r} is used by the versions")
    if base is not None and buckets is None:
        same = set(base.bucket_by) <= set(df.columns)
        buckets, bucket_by = (base.buckets, base.bucket_by) if same else (None, ())
    new = _next(spark, database, table, df.columns, partition_by, buckets, bucket_by, note)
    return _publish(spark, new, _by_bucket(df, new), [], base)


def _by_bucket(df: DataFrame, table: NamedTable) -> DataFrame:
    """Rows dealt as the buckets are, so that a task writes one bucket."""
    return df.repartition(table.buckets, *map(ident, table.bucket_by)) if table.buckets else df


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    """``insertInto`` takes its overwrite mode from the session."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _overwrite_plain(spark: SparkSession, table: NamedTable, df: DataFrame) -> int:
    ensure_checkpoint_dir(spark)
    stored = df.select(*map(ident, table.columns)).checkpoint(eager=True)   # it may read the table it replaces
    with _overwrite_mode(spark, "static"):
        stored.write.insertInto(table.stored, overwrite=True)
    return stored.count()


def change_partitions(spark: SparkSession, table: NamedTable, rewritten: DataFrame | None, matched: list,
                      added: DataFrame | None, note: dict[str, str] | None = None) -> int:
    """Replace the partitions of the values ``matched`` by ``rewritten`` and add ``added``; one publication.

    A plain table takes the two parts one after the other: dynamic partition overwrite, then append.
    """
    if table.version is None:
        return _change_plain(spark, table, rewritten, added)
    gone = {None if v is None else str(v) for v in matched}
    kept = [s for s in specs_of(spark, table) if table.partition_by and s[table.partition_by] not in gone]
    new = _next(spark, table.database, table.name, table.columns, table.partition_by, table.buckets, table.bucket_by, note)
    parts = [p.select(*map(ident, table.columns)) for p in (rewritten, None if added is None else _by_bucket(added, new))
             if p is not None]
    rows = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else None
    return _publish(spark, new, rows, kept, table)


def _change_plain(spark: SparkSession, table: NamedTable, rewritten: DataFrame | None, added: DataFrame | None) -> int:
    last = [c for c in (table.partition_by,) if c]
    ordered = [ident(c) for c in table.columns if c not in last] + [ident(c) for c in last]
    written = 0
    if rewritten is not None:
        ensure_checkpoint_dir(spark)
        rewritten = rewritten.checkpoint(eager=True)    # Spark refuses to overwrite a table that is being read
    for rows, overwrite in ((rewritten, True), (added, False)):
        if rows is not None:
            seen = Observation("inserted")
            counted = rebalance(rows.select(*ordered), last).observe(seen, F.count(F.lit(1)).alias("rows"))
            with _overwrite_mode(spark, "dynamic"):
                counted.write.insertInto(table.stored, overwrite=overwrite)
            written += int(seen.get["rows"])
    return written


def drop_partitions(spark: SparkSession, table: NamedTable, values: list) -> None:
    """Publish a version without the partitions of some values."""
    if table.version is None:
        for v in values:
            spark.sql(f"ALTER TABLE {table.stored} DROP IF EXISTS PARTITION "
                      f"({ident(table.partition_by)} = {'NULL' if v is None else literal(str(v))})")
    elif values:
        change_partitions(spark, table, None, values, None)


def partition_values(spark: SparkSession, table: NamedTable) -> list[str | None]:
    """The values of the partition column, as text; metadata only."""
    return list({s[table.partition_by]: None for s in specs_of(spark, table)})


# -- housekeeping ---------------------------------------------------------------

def _delete_writes(spark: SparkSession, table: NamedTable, writes: set[str]) -> None:
    fs, root = hadoop_fs(spark, _root(spark, table.database, table.name))
    if not fs.exists(root):
        return
    names = {f"{WRITE_COLUMN}={w}" for w in writes}
    for status in fs.listStatus(root):
        if status.getPath().getName() in names:
            fs.delete(status.getPath(), True)
        elif table.partition_by and status.isDirectory():
            for inner in fs.listStatus(status.getPath()):
                if inner.getPath().getName() in names:
                    fs.delete(inner.getPath(), True)


def _stored_writes(spark: SparkSession, table: NamedTable) -> dict[str, set[str]]:
    """Folders below the table's root by their partition folder ('' without one)."""
    fs, root = hadoop_fs(spark, _root(spark, table.database, table.name))
    out: dict[str, set[str]] = {}
    if fs.exists(root):
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith(f"{WRITE_COLUMN}="):
                out.setdefault("", set()).add(name)
            elif status.isDirectory() and not name.startswith(("_", ".")):
                out[name] = {i.getPath().getName() for i in fs.listStatus(status.getPath())
                             if i.getPath().getName().startswith(f"{WRITE_COLUMN}=")}
    return out


def vacuum(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Drop all but the newest ``keep`` published versions and the folders none of them
    holds, those of writers that never finished included. Returns the folders removed.

    Run it when no write is under way: an unpublished version counts as left over.
    """
    table = find(spark, name)
    if table is None or table.version is None:
        raise TableNameError(f"{name!r} has no versions")
    published = [v for v in _versions(spark, table.database, table.name) if v <= table.version]
    stay = published[-max(1, keep):]
    for version in _versions(spark, table.database, table.name):
        if version not in stay:
            spark.sql(f"DROP TABLE IF EXISTS {version_name(table.database, table.name, version)}")
    held = set()
    for version in stay:
        for row in spark.sql(f"SHOW PARTITIONS {version_name(table.database, table.name, version)}").collect():
            folder, _, write = row["partition"].rpartition("/")
            held.add((folder, write))
    fs, root = hadoop_fs(spark, _root(spark, table.database, table.name))
    removed = []
    for folder, writes in _stored_writes(spark, table).items():
        for write in writes:
            if (folder, write) not in held:
                path = "/".join(p for p in (folder, write) if p)
                fs.delete(hadoop_fs(spark, f"{root.toString()}/{path}")[1], True)
                removed.append(path)
    return sorted(removed)


def drop(spark: SparkSession, name: str) -> bool:
    """Drop a table with its versions and files; a missing one is not an error."""
    table = find(spark, name)
    if table is None:
        return False
    if table.version is None:
        spark.sql(f"DROP TABLE IF EXISTS {table.full_name}")
        return True
    spark.sql(f"DROP VIEW IF EXISTS {table.full_name}")
    for version in _versions(spark, table.database, table.name):
        spark.sql(f"DROP TABLE IF EXISTS {version_name(table.database, table.name, version)}")
    fs, root = hadoop_fs(spark, _root(spark, table.database, table.name))
    fs.delete(root, True)
    return True
