"""Snapshot documents: landing, reading and day selection.

A landing folder holds JSON documents under ``ingest_date=<yyyy-MM-dd>/``
sub-folders, so a day is chosen by partition pruning, not by building a path.
Our own landing writes JSON lines (splittable); reference-style folders with
one pretty-printed document per file are read with ``multi_line=True``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from time import time_ns

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyfold.functions.sqltext import ident, literal
from skyfold.schema import RAW_DDL, RAW_VARIANT_DDL

DATE_PARTITION = "ingest_date"


def read_snapshots(spark: SparkSession, path: str, *, multi_line: bool = False,
                   day: str | None = None, dated_folders: bool = False, variant: bool = False) -> DataFrame:
    """Every document under ``path`` as one row ``(time, part, copy, states[, ingest_date])``.

    A document that is no valid JSON for the schema (a broken file, or a
    pretty-printed one read without ``multi_line``) fails the read, and so does
    a file of several documents read with ``multi_line``.

    The schema is explicit, so no inference pass reads the files first. With
    ``day`` only that day's folder is listed and read: an ``ingest_date=``
    partition (our landing), or, with ``dated_folders``, a plain
    ``<path>/<yyyy-MM-dd>/`` folder as other landings write it. ``variant`` keeps the
    mixed types of a vector's elements (``map_slots`` reads either form).
    """
    if dated_folders:
        if day is None:
            raise ValueError("dated_folders needs a day")
        return (read_documents(spark.read, f"{path.rstrip('/')}/{day}", multi_line, variant)
                .withColumn(DATE_PARTITION, F.lit(day).cast("date")))
    docs = read_documents(spark.read, path, multi_line, variant)
    if day is not None:
        docs = select_day(docs, day)
    return docs


def read_documents(reader, path: str, multi_line: bool, variant: bool = False) -> DataFrame:
    """Documents of a batch or stream reader, with their copy: one per line, or
    with ``multi_line`` one per file."""
    schema = RAW_VARIANT_DDL if variant else RAW_DDL
    if not multi_line:
        return with_copy(reader.schema(schema).option("mode", "FAILFAST").json(path))
    files = reader.text(path, wholetext=True)
    # A parser stops at the end of the first document. No object follows an
    # object within a snapshot, so a second document shows in the text once what strings hold is taken out.
    bare = F.regexp_replace("value", r'"(?:[^"\\]++|\\.)*+"', '""')
    several = F.raise_error(F.concat(F.lit("several documents in one file: "), F.col("_metadata.file_path")))
    text = F.when(bare.rlike(r"\}\s*\{"), several).otherwise(F.col("value"))
    parsed = files.withColumn("_doc", F.from_json(text, schema, {"mode": "FAILFAST"}))
    rest = [c for c in files.columns if c != "value"]   # partition columns
    return with_copy(parsed.filter("trim(value) != ''").select("_doc.*", "_metadata", *rest)).drop("_metadata")


def with_copy(docs: DataFrame) -> DataFrame:
    """Names the copy each document belongs to: its landing run or, for a
    document other tools landed (a whole snapshot), its file and content.
    ``docs`` comes straight from a file source."""
    variant = "variant" in docs.schema["states"].dataType.simpleString()
    content = F.xxhash64(F.to_json("states") if variant else F.col("states"))     # a variant has no hash
    own = F.concat_ws(":", F.lit("file"), F.col("_metadata.file_path"), content.cast("string"))
    return docs.withColumn("copy", F.coalesce("copy", own))


def one_copy(docs: DataFrame) -> DataFrame:
    """One whole copy of each snapshot ``time``: that landed first.

    Copies may differ in size and so in their number of parts; parts of two
    copies are never mixed. The choice aggregates (time, copy) only, without
    ``states``. A null time is a snapshot of its own.
    """
    first = docs.groupBy(F.col("time").alias("_t")).agg(F.min("copy").alias("_c"))
    kept = docs.join(first, docs["time"].eqNullSafe(first["_t"]) & (docs["copy"] == first["_c"]), "left_semi")
    # A foreign file may hold the very same document twice.
    return kept.dropDuplicates(["time", "part"])


def select_day(df: DataFrame, day: str, column: str = DATE_PARTITION) -> DataFrame:
    """Rows of one day; on a partitioned source this is a partition filter."""
    return df.filter(F.col(column) == F.lit(day).cast("date"))


def non_empty(docs: DataFrame, states: str = "states") -> DataFrame:
    """Drop documents whose ``states`` is null or empty."""
    return docs.filter(F.coalesce(F.size(F.col(states)) > 0, F.lit(False)))


def snapshot_day(time: str, zone: str) -> Column:
    """Local calendar day, in ``zone``, of epoch seconds, whatever the session
    zone (the UTC wall time is built by arithmetic, not by a zone cast)."""
    utc_wall = f"timestampadd(SECOND, {ident(time)}, TIMESTAMP_NTZ '1970-01-01 00:00:00')"
    return F.expr(f"to_date(convert_timezone('UTC', {literal(zone)}, {utc_wall}))")


def pack_snapshots(rows: DataFrame, time: str, vector: Sequence[Column], spread: str,
                   max_per_doc: int = 5000) -> DataFrame:
    """Group rows into snapshot documents ``(time, part, states)``.

    Each row becomes a positional vector of strings (null stays null). A
    snapshot with more than ``max_per_doc`` rows is split into parts by a hash
    of ``spread`` (a unique row id), so the list built for one document stays
    near that bound however large one snapshot grows. The per-snapshot counts
    are an aggregate joined back (AQE broadcasts it when small at run time,
    else splits a skewed key).
    """
    vec = F.array(*[c.cast("string") for c in vector])
    sized = rows.groupBy(F.col(time).alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(max_per_doc))).cast("int")
    # null-safe: rows without a time form one document of their own, none is lost
    tagged = (rows.join(sized, on=rows[time].eqNullSafe(sized["_t"]), how="inner")
                  .select(F.col(time).alias("time"),
                          F.pmod(F.xxhash64(F.col(spread)), parts).cast("int").alias("part"),
                          vec.alias("_v")))
    return tagged.groupBy("time", "part").agg(F.collect_list("_v").alias("states"))


def land_snapshots(docs: DataFrame, path: str, zone: str, *, mode: str = "append") -> int:
    """Append documents to a landing folder partitioned by local day.

    Empty or null ``states`` are not landed. Returns the number of documents
    written (counted during the write, not by a second pass).
    """
    seen = Observation("landed")
    run = f"{time_ns():020d}-{uuid.uuid4().hex[:8]}"   # sorts by landing time
    out = (non_empty(docs)
           .withColumn("copy", F.lit(run))
           .withColumn(DATE_PARTITION, snapshot_day("time", zone))
           .hint("rebalance", DATE_PARTITION)
           .observe(seen, F.count(F.lit(1)).alias("docs")))
    out.write.mode(mode).partitionBy(DATE_PARTITION).json(path)
    return int(seen.get["docs"])
