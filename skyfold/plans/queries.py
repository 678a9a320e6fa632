"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver tables of ``sf_dir`` in full (the aircraft rows are
derived from ``events`` row by row) and returns a DataFrame. Queries that
exercise sinks write to a fresh folder under the shared checkpoint folder and
return what they read back.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.functions.scalar import local_date
from skyfold.functions.sqltext import literal
from skyfold.operators.dedup import dedup_by
from skyfold.operators.filters import require_non_null, within_box
from skyfold.operators.profile import (
    loss_report, null_profile, row_count, top_k, value_counts,
)
from skyfold.operators.shape import explode_states, map_slots
from skyfold.operators.upsert import upsert
from skyfold.plans import fixture as fx
from skyfold.plans.marts import (
    daily_summary, dim_countries, dim_flight_phases, fact_flights, mart_row_counts,
)
from skyfold.plans.preset import (
    BOUNDING_BOX, LOCAL_ZONE, REQUIRED_COLUMNS, RETENTION_DAYS, category_label, clean,
    flight_phase, flight_type, required_present, speed_category,
)
from skyfold.plans.tables import (
    expire_partitions, merge_into, read_history, replace_table, retain_recent, table_exists, upsert_table,
    with_history_partition,
)
from skyfold.schema import (
    DAILY_KEYS, DAILY_MEASURES, HISTORY_COLUMNS, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS,
)
from skyfold.plans.steps import build_mart_tables, load_history, process_day, quality_report, read_mart
from skyfold.session import ensure_checkpoint_dir, work_path
from skyfold.sources.parquet import drop_staging, load_staging, write_partitions
from skyfold.sources.snapshots import (
    DATE_PARTITION, land_snapshots, one_copy, pack_snapshots, read_snapshots, select_day,
)
from skyfold.streaming.incremental import accumulate

# Fixed parameters of the checks.
SELECTED_DAY = "2024-01-15"
RETENTION_AS_OF = "2001-08-01"
PROCESSING_TIME = "2024-02-01 00:00:00"
MAX_VECTORS_PER_DOC = 5000
EXPIRE_AS_OF, EXPIRE_DAYS = "2024-02-01", 20
# A quarter of the second batch's aircraft report another country.
MOVED_COUNTRY = "CASE WHEN pmod(snapshot_time / 3600, 4) = 0 THEN 'MOVED' ELSE origin_country END"
# Narrower than the preset's box, so that rows fall outside.
NARROW_BOX = (10.0, 30.0, 70.0, 90.0)


def prepare(spark: SparkSession) -> None:
    """Results depend on UTC as the session zone; the shared checkpoint
    folder must be known before any job that writes."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return fx.read_table(spark, sf_dir, "events")


def _fixture(spark, sf_dir) -> DataFrame:
    return fx.flight_fixture(_events(spark, sf_dir))


def _history(spark, sf_dir) -> DataFrame:
    return fx.fixture_history(_events(spark, sf_dir))


def _processing_time():
    return F.lit(PROCESSING_TIME).cast("timestamp_ntz")


def _docs(fixture: DataFrame, max_per_doc: int = MAX_VECTORS_PER_DOC) -> DataFrame:
    return pack_snapshots(fixture, "snapshot_time", fx.state_vector(fixture),
                          spread="event_id", max_per_doc=max_per_doc)


def _events_by_day(spark, sf_dir) -> str:
    path = work_path(spark, "events_by_day")
    ev = _events(spark, sf_dir).select(
        "event_id", "ts", "user_id", "event_type", "value",
        local_date("ts", LOCAL_ZONE).alias(DATE_PARTITION))
    write_partitions(ev, path, DATE_PARTITION)
    return path


# -- marts ------------------------------------------------------------------

def flagship_country_mart(spark, sf_dir):
    return dim_countries(_history(spark, sf_dir))


def phase_mart(spark, sf_dir):
    return dim_flight_phases(_history(spark, sf_dir))


def fact_projection(spark, sf_dir):
    return fact_flights(_history(spark, sf_dir))


def daily_mart(spark, sf_dir):
    return daily_summary(fact_flights(_history(spark, sf_dir)))


def mart_registry(spark, sf_dir):
    return mart_row_counts(_history(spark, sf_dir))


# -- filters and expressions -------------------------------------------------

def required_columns_filter(spark, sf_dir):
    return require_non_null(_fixture(spark, sf_dir), REQUIRED_COLUMNS)


def bbox_filter(spark, sf_dir):
    return within_box(_fixture(spark, sf_dir), BOUNDING_BOX)


def clean_units(spark, sf_dir):
    return _history(spark, sf_dir)


def processing_time_default(spark, sf_dir):
    """The processing time stamped by default: present, one for the whole run,
    and later than every event."""
    now = F.current_timestamp()
    rows = clean(_fixture(spark, sf_dir).withColumnRenamed("ingested_at", "event_time"), carry=("event_id", "event_time"))
    return rows.select(
        "event_id", F.col("ingested_at").isNotNull().alias("stamped"), (F.col("ingested_at") == now).alias("one_time"),
        (F.col("ingested_at") > F.col("event_time")).alias("after_event"))


def category_label_query(spark, sf_dir):
    return _fixture(spark, sf_dir).select(
        "event_id", "category", category_label("category").alias("flight_category"))


def flight_phase_query(spark, sf_dir):
    return _fixture(spark, sf_dir).select(
        "event_id", "on_ground", "baro_altitude", flight_phase().alias("flight_phase"))


def flight_type_query(spark, sf_dir):
    return _fixture(spark, sf_dir).select(
        "event_id", "origin_country", flight_type().alias("flight_type"))


def speed_band(spark, sf_dir):
    return _history(spark, sf_dir).select(
        "event_id", "speed_kmh", speed_category().alias("speed_category"))


# -- profiles ----------------------------------------------------------------

def row_count_query(spark, sf_dir):
    prepare(spark)
    return row_count(fx.read_table(spark, sf_dir, "lineitem"))


def null_profile_query(spark, sf_dir):
    return null_profile(_history(spark, sf_dir), HISTORY_COLUMNS)


def phase_distribution(spark, sf_dir):
    return value_counts(_history(spark, sf_dir), "flight_phase")


def category_distribution(spark, sf_dir):
    return value_counts(_history(spark, sf_dir), "flight_category")


def top10_countries(spark, sf_dir):
    return top_k(_history(spark, sf_dir), "origin_country", 10)


def filter_loss(spark, sf_dir):
    return loss_report(_fixture(spark, sf_dir), required_present())


# -- snapshots: landing, reading, dedup ---------------------------------------

def snapshot_json_roundtrip(spark, sf_dir):
    fixture = _fixture(spark, sf_dir)
    landing = work_path(spark, "landing")
    land_snapshots(_docs(fixture), landing, LOCAL_ZONE)
    docs = read_snapshots(spark, landing)
    return map_slots(explode_states(docs))


def snapshot_variant_roundtrip(spark, sf_dir):
    """The same landing read with the elements of a vector as variants."""
    landing = work_path(spark, "landing")
    land_snapshots(_docs(_fixture(spark, sf_dir)), landing, LOCAL_ZONE)
    docs = one_copy(read_snapshots(spark, landing, variant=True).drop(DATE_PARTITION))
    return map_slots(explode_states(docs))


def landed_vectors(spark, sf_dir):
    """Vectors per landed snapshot: rows without a time are landed as a
    snapshot of their own, documents without vectors are not landed."""
    fixture = _fixture(spark, sf_dir).withColumn(
        "snapshot_time", F.expr("CASE WHEN event_id % 53 = 0 THEN NULL ELSE snapshot_time END"))
    docs = _docs(fixture)
    states = docs.schema["states"].dataType.simpleString()
    times = fixture.filter("snapshot_time IS NOT NULL").select("snapshot_time").distinct()
    for later, none in ((1, "NULL"), (2, "array()")):
        docs = docs.unionByName(times.selectExpr(
            f"snapshot_time + {later} AS time", "0 AS part", f"CAST({none} AS {states}) AS states"))
    landing = work_path(spark, "landing")
    land_snapshots(docs, landing, LOCAL_ZONE)
    kept = one_copy(read_snapshots(spark, landing).drop(DATE_PARTITION))
    return kept.groupBy("time").agg(F.sum(F.size("states")).alias("vectors"))


def snapshot_dedup(spark, sf_dir):
    """Every snapshot landed, then landed again with other vectors: some
    copies have grown (a marked vector more per vector) and some have shrunk.
    Documents are small enough to be split into parts; the first copy of each
    snapshot comes back whole."""
    fixture = _fixture(spark, sf_dir)
    landing = work_path(spark, "landing")
    land_snapshots(_docs(fixture, 7), landing, LOCAL_ZONE)
    odd = F.col("snapshot_time") / 3600 % 2 >= 1
    again = fixture.withColumn("callsign", F.lit("AGAIN"))
    grown = again.filter(odd).withColumn("copies", F.explode(F.sequence(F.lit(1), F.lit(2)))).drop("copies")
    shrunk = again.filter(~odd).filter(F.col("event_id") % 2 == 0)
    land_snapshots(_docs(grown.unionByName(shrunk), 7), landing, LOCAL_ZONE)
    kept = one_copy(read_snapshots(spark, landing).drop(DATE_PARTITION))
    return map_slots(explode_states(kept))


def key_dedup(spark, sf_dir):
    return fx.keyed_history(_events(spark, sf_dir))


def date_partition_select(spark, sf_dir):
    path = _events_by_day(spark, sf_dir)
    return select_day(spark.read.parquet(path), SELECTED_DAY)


def parquet_day_overwrite(spark, sf_dir):
    """Write every day, then replace one day with re-processed rows; only that
    partition changes."""
    path = _events_by_day(spark, sf_dir)
    day = select_day(spark.read.parquet(path), SELECTED_DAY)
    redo = day.withColumn("value", F.col("value") * F.lit(2.0)).checkpoint(eager=True)
    write_partitions(redo, path, DATE_PARTITION)
    return spark.read.parquet(path)


def retention_90d(spark, sf_dir):
    prepare(spark)
    orders = fx.read_table(spark, sf_dir, "orders")
    return retain_recent(orders, "o_orderdate", RETENTION_DAYS, dt.date.fromisoformat(RETENTION_AS_OF))


# -- upserts -----------------------------------------------------------------

def _batches(spark, sf_dir, materialize: bool = False):
    """Batches A and B of the keyed rows. Flows that run several jobs over
    them materialise the keyed rows once (shared checkpoint folder) instead of
    repeating the dedup over all events in every job."""
    keyed = fx.keyed_history(_events(spark, sf_dir)).drop("event_id")
    if materialize:
        keyed = keyed.checkpoint(eager=True)
    return fx.batch_a(keyed), fx.batch_b(keyed)


def upsert_composite_key(spark, sf_dir):
    a, b = _batches(spark, sf_dir)
    return upsert(a, b, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS)


def upsert_small_source(spark, sf_dir):
    """The same merge through the broadcast plan (source size checked)."""
    a, b = _batches(spark, sf_dir)
    return upsert(a, b, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS, broadcast_max_rows=10_000_000)


def table_merge_by_shuffle(spark, sf_dir):
    """The same table flow with no source small enough to broadcast: the plan
    of a large merge, and the one every size can take."""
    return table_first_run_then_upsert(spark, sf_dir, broadcast_max_rows=0)


def table_first_run_then_upsert(spark, sf_dir, **merge_settings):
    """Batch A creates the table (it does not exist yet), batch B is loaded
    through a staging view and merged into the touched partitions only."""
    a, b = _batches(spark, sf_dir, materialize=True)
    history = work_path(spark, "history")
    staged = work_path(spark, "staging")
    assert not table_exists(spark, history)
    merge_into(spark, history, with_history_partition(a))
    write_partitions(with_history_partition(b), staged, "snapshot_date")
    view = f"history_staging_{uuid.uuid4().hex[:12]}"
    staging = load_staging(spark, staged, view)
    merge_into(spark, history, spark.table(view).select(*staging.columns), **merge_settings)
    drop_staging(spark, view)
    return read_history(spark, history)


def _work_database(spark) -> str:
    """A database of this run whose tables lie below the checkpoint folder."""
    name = f"skyfold_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION {literal(work_path(spark, name))}")
    return name


def _merged_by_name(spark, sf_dir, **settings) -> str:
    a, b = _batches(spark, sf_dir, materialize=True)
    name = f"{_work_database(spark)}.history"
    assert not table_exists(spark, name)
    merge_into(spark, name, with_history_partition(a), **settings)
    merge_into(spark, name, with_history_partition(b), **settings)
    return name


def table_by_name_first_run_then_upsert(spark, sf_dir):
    """The same two batches into a table by its catalog name: the first creates
    it, the second is published as its next version in one step."""
    return read_history(spark, _merged_by_name(spark, sf_dir)).select(*HISTORY_COLUMNS)


def bucketed_merge(spark, sf_dir):
    """The same by name with buckets on the key and no source small enough to
    broadcast: bucket joins bucket, only the batch is shuffled."""
    name = _merged_by_name(spark, sf_dir, buckets=8, broadcast_max_rows=0)
    return read_history(spark, name).select(*HISTORY_COLUMNS)


def replace_by_name(spark, sf_dir):
    """A table by name replaced whole, the second time from a query on itself."""
    name = f"{_work_database(spark)}.countries"
    replace_table(_history(spark, sf_dir).select("origin_country", "icao24"), name)
    replace_table(spark.table(name).groupBy("origin_country").agg(
        F.countDistinct("icao24").alias("unique_aircraft")), name)
    return spark.table(name)


def expire_by_name(spark, sf_dir):
    """Old days leave a table by name as a version without their partitions."""
    name = f"{_work_database(spark)}.events_by_day"
    replace_table(spark.read.parquet(_events_by_day(spark, sf_dir)), name, DATE_PARTITION)
    expire_partitions(spark, name, DATE_PARTITION, EXPIRE_DAYS, EXPIRE_AS_OF)
    return spark.table(name)


def upsert_daily(spark, sf_dir):
    a, b = _batches(spark, sf_dir, materialize=True)
    path = work_path(spark, "agg_flights_daily")
    upsert_table(spark, path, daily_summary(fact_flights(a)), DAILY_KEYS)
    upsert_table(spark, path, daily_summary(fact_flights(b)), DAILY_KEYS, DAILY_MEASURES)
    return spark.read.parquet(path)


# -- end to end and incremental ------------------------------------------------

def end_to_end_country_mart(spark, sf_dir):
    """Land snapshots, process them (dedup, clean, write), load the history
    through staging, build the marts; return the country mart as stored."""
    fixture = _fixture(spark, sf_dir)
    landing = work_path(spark, "landing")
    land_snapshots(_docs(fixture), landing, LOCAL_ZONE)
    processed, history, marts = (work_path(spark, p) for p in ("processed", "history", "marts"))
    process_day(spark, landing, processed, ingested_at=_processing_time())
    load_history(spark, processed, history)
    build_mart_tables(spark, history, marts)
    return read_mart(spark, marts, "dim_countries")


def fact_from_touched_partitions(spark, sf_dir):
    """Two cycles of merge and marts; the second rewrites the fact table only
    in the partitions its batch touched. The fact table as stored."""
    history, marts = work_path(spark, "history"), work_path(spark, "marts")
    for batch in _batches(spark, sf_dir, materialize=True):
        touched = merge_into(spark, history, with_history_partition(batch))["touched"]
        build_mart_tables(spark, history, marts, touched)
    return read_mart(spark, marts, "fct_flights")


def _marts_of_two_cycles(spark, sf_dir, mart: str):
    """Two cycles of merge and marts by name; rows of the second batch change country, and
    the marts read the history's touched partitions only."""
    a, b = _batches(spark, sf_dir, materialize=True)
    b = b.withColumn("origin_country", F.expr(MOVED_COUNTRY))
    database = _work_database(spark)
    for batch in (a, b):
        touched = merge_into(spark, f"{database}.history", with_history_partition(batch))["touched"]
        build_mart_tables(spark, f"{database}.history", database, touched)
    return read_mart(spark, database, mart)


def country_mart_from_touched_partitions(spark, sf_dir):
    return _marts_of_two_cycles(spark, sf_dir, "dim_countries")


def phase_mart_from_touched_partitions(spark, sf_dir):
    return _marts_of_two_cycles(spark, sf_dir, "dim_flight_phases")


def quality_report_one_scan(spark, sf_dir):
    """All parts of the quality report, which share one scan, as (part, value, n)."""
    report = quality_report(_history(spark, sf_dir).select(*HISTORY_COLUMNS))
    nulls = report["null_profile"]
    parts = [report["row_count"].select(F.lit("rows").alias("part"), F.lit(None).cast("string").alias("value"),
                                        F.col("row_count").alias("n")),
             nulls.unpivot([], nulls.columns, "value", "n").select(F.lit("nulls").alias("part"), "value", "n")]
    parts += [df.select(F.lit(name).alias("part"), F.col(df.columns[0]).alias("value"), F.col("count").alias("n"))
              for name, df in report.items() if name not in ("row_count", "null_profile")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def boxed_incremental(spark, sf_dir):
    """One incremental run that keeps the vectors of a bounding box only."""
    fixture = dedup_by(_fixture(spark, sf_dir), HISTORY_KEYS, "event_id")
    landing, history, checkpoint = (work_path(spark, p) for p in ("landing", "history", "stream-checkpoint"))
    land_snapshots(_docs(fixture), landing, LOCAL_ZONE)
    accumulate(spark, landing, history, checkpoint, ingested_at=_processing_time(), box=NARROW_BOX)
    return read_history(spark, history)


def process_one_day(spark, sf_dir):
    """Land every snapshot, then process and load one local day only: the day
    is chosen by partition pruning on the landing and on the processed output."""
    fixture = _fixture(spark, sf_dir)
    landing = work_path(spark, "landing")
    land_snapshots(_docs(fixture), landing, LOCAL_ZONE)
    processed, history = work_path(spark, "processed"), work_path(spark, "history")
    process_day(spark, landing, processed, SELECTED_DAY, ingested_at=_processing_time())
    load_history(spark, processed, history, SELECTED_DAY)
    return read_history(spark, history)


def incremental_accumulate(spark, sf_dir):
    """Three landings (days 1-10, 11-20 plus a re-fetch of day 10, 21-30), each
    followed by an incremental run; the end state equals one full load."""
    keyed = fx.flight_fixture(_events(spark, sf_dir))
    keyed = dedup_by(keyed, HISTORY_KEYS, "event_id")
    docs = _docs(keyed).checkpoint(eager=True)
    landing = work_path(spark, "landing")
    history = work_path(spark, "history")
    checkpoint = work_path(spark, "stream-checkpoint")
    day = lambda d: F.lit(1704067200 + (d - 1) * 86400)  # noqa: E731 - start of day d
    t = F.col("time")
    waves = [docs.filter(t < day(11)),
             docs.filter((t >= day(10)) & (t < day(21))),
             docs.filter(t >= day(21))]
    for wave in waves:
        land_snapshots(wave, landing, LOCAL_ZONE)
        accumulate(spark, landing, history, checkpoint, ingested_at=_processing_time())
    return read_history(spark, history)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flagship_country_mart": flagship_country_mart,
    "snapshot_json_roundtrip": snapshot_json_roundtrip,
    "snapshot_variant_roundtrip": snapshot_variant_roundtrip,
    "date_partition_select": date_partition_select,
    "parquet_day_overwrite": parquet_day_overwrite,
    "table_first_run_then_upsert": table_first_run_then_upsert,
    "table_merge_by_shuffle": table_merge_by_shuffle,
    "retention_90d": retention_90d,
    "required_columns_filter": required_columns_filter,
    "bbox_filter": bbox_filter,
    "clean_units": clean_units,
    "processing_time_default": processing_time_default,
    "category_label": category_label_query,
    "flight_phase": flight_phase_query,
    "flight_type": flight_type_query,
    "speed_band": speed_band,
    "fact_projection": fact_projection,
    "snapshot_dedup": snapshot_dedup,
    "landed_vectors": landed_vectors,
    "key_dedup": key_dedup,
    "upsert_composite_key": upsert_composite_key,
    "upsert_small_source": upsert_small_source,
    "table_by_name_first_run_then_upsert": table_by_name_first_run_then_upsert,
    "bucketed_merge": bucketed_merge,
    "replace_by_name": replace_by_name,
    "expire_by_name": expire_by_name,
    "upsert_daily": upsert_daily,
    "row_count": row_count_query,
    "null_profile": null_profile_query,
    "phase_distribution": phase_distribution,
    "category_distribution": category_distribution,
    "top10_countries": top10_countries,
    "filter_loss": filter_loss,
    "phase_mart": phase_mart,
    "daily_mart": daily_mart,
    "mart_registry": mart_registry,
    "end_to_end_country_mart": end_to_end_country_mart,
    "fact_from_touched_partitions": fact_from_touched_partitions,
    "country_mart_from_touched_partitions": country_mart_from_touched_partitions,
    "phase_mart_from_touched_partitions": phase_mart_from_touched_partitions,
    "quality_report_one_scan": quality_report_one_scan,
    "boxed_incremental": boxed_incremental,
    "process_one_day": process_one_day,
    "incremental_accumulate": incremental_accumulate,
}
