"""The three batch steps of the snapshot flow, as functions over folders.

1. ``process_day``: landed snapshot documents of one day → cleaned rows,
   written as Parquet (the day's partitions replaced), then profiled from the
   written files.
2. ``load_history``: the processed day → the history table (created on first
   use, else merged by key into the touched partitions only).
3. ``build_mart_tables``: history → fact table (whole, or the touched
   partitions), dimension tables (from a state per partition) and the daily
   summary (merged by day).

State passes between steps only through folders or tables, so each step can be
re-run on its own. The history and the marts may be paths or names.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyfold.functions.scalar import utc_day
from skyfold.operators.profile import Profile
from skyfold.operators.shape import explode_states, map_slots
from skyfold.plans import named
from skyfold.plans.marts import MART_BUILDERS, STATE_MARTS, fact_flights
from skyfold.plans.preset import LOCAL_ZONE, clean
from skyfold.plans.tables import (
    HISTORY_PARTITION, merge_into, partitions_of, put_partitions, read_history, read_table, replace_table,
    table_exists, upsert_table, with_history_partition,
)
from skyfold.schema import DAILY_KEYS, DAILY_MEASURES, HISTORY_COLUMNS
from skyfold.session import ensure_checkpoint_dir
from skyfold.sources.parquet import drop_partition, drop_staging, load_staging, rebalance, write_partitions
from skyfold.sources.snapshots import DATE_PARTITION, one_copy, read_snapshots, select_day, snapshot_day

STAGING_VIEW = "history_staging"
# The daily summary is merged by day; every other mart is replaced whole.
MERGED_MART = "agg_flights_daily"
FACT_MART = "fct_flights"


def quality_report(rows: DataFrame) -> dict[str, DataFrame]:
    """Row count, nulls per column, phase and category distribution, top 10
    countries, all from one scan of ``rows``."""
    ensure_checkpoint_dir(rows.sparkSession)
    profile = Profile(rows, ["flight_phase", "flight_category", "origin_country"])
    return {
        "row_count": profile.row_count(),
        "null_profile": profile.null_profile(),
        "phase_distribution": profile.value_counts("flight_phase"),
        "category_distribution": profile.value_counts("flight_category"),
        "top10_countries": profile.top_k("origin_country", 10),
    }


def process_day(spark: SparkSession, landing: str, processed: str, day: str | None = None, *,
                zone: str = LOCAL_ZONE, ingested_at: Column | None = None,
                multi_line: bool = False, dated_folders: bool = False,
                box: tuple[float, float, float, float] | None = None) -> dict:
    """Read one local day's documents (every day when ``day`` is None), keep
    one per snapshot, clean the vectors and replace that day's output.

    The output of a ``day`` is that ``ingest_date`` partition whatever zone
    the landing's days follow, replaced even when no row is left; without a
    day, rows go to their local day in ``zone``. ``box`` (min and max latitude,
    min and max longitude) keeps the vectors within it only. The report is
    computed from the written Parquet, so the lineage runs once.
    """
    docs = read_snapshots(spark, landing, multi_line=multi_line, day=day,
                          dated_folders=dated_folders)
    kept, mapped_seen = Observation("documents"), Observation("vectors")
    # The documents are grouped by output day before they are exploded, so that all that is counted
    # happens in the tasks that write: Spark counts each of those once, also when
    # an earlier stage runs again. One day in, the same day out: the landing's day is not computed again.
    docs = one_copy(docs.drop(DATE_PARTITION))
    if day is None:
        docs = rebalance(docs.withColumn(DATE_PARTITION, snapshot_day("time", zone)), [DATE_PARTITION]).drop(DATE_PARTITION)
    else:
        docs = docs.hint("rebalance")
    docs = docs.observe(kept, F.count(F.lit(1)).alias("documents"))
    mapped = (map_slots(explode_states(docs))
              .observe(mapped_seen, F.count(F.lit(1)).alias("vectors")))
    out_day = F.lit(day).cast("date") if day is not None else snapshot_day("snapshot_time", zone)
    rows = clean(mapped, ingested_at, box=box).withColumn(DATE_PARTITION, out_day)
    written = write_partitions(rows, processed, DATE_PARTITION, dealt=True)
    if day is not None and written == 0:
        drop_partition(spark, processed, DATE_PARTITION, day)   # a day that yields nothing is empty
    stored = spark.read.schema(rows.schema).parquet(processed)
    if day is not None:
        stored = select_day(stored, day)
    vectors = int(mapped_seen.get["vectors"])
    # Counted during the write, no extra pass: documents kept after the dedup
    # (one per snapshot, or per part when a snapshot was split at landing),
    # vectors before the required-columns filter and the box, and the rows they dropped.
    return {"rows_written": written, "documents": int(kept.get["documents"]),
            "vectors": vectors, "rows_lost": vectors - written,
            "report": quality_report(stored.select(*HISTORY_COLUMNS))}


def load_history(spark: SparkSession, processed: str, history: str, day: str | None = None,
                 *, count_total: bool = False,
                 dedup_order: str | Sequence[str] | None = None) -> dict:
    """Processed rows of one day (all days when ``day`` is None) → staging
    view → history (create or merge) → drop the view.

    ``dedup_order`` names the expressions that pick one row where a key repeats
    (smallest first); without it repeated keys stop a merge.

    ``count_total`` adds the history's total row count (answered from the
    Parquet footers, but it lists every file of the table)."""
    view = f"{STAGING_VIEW}_{uuid.uuid4().hex[:12]}"   # one per load: loads may run side by side
    load_staging(spark, processed, view, day=day, columns=HISTORY_COLUMNS)
    try:
        result = merge_into(spark, history, with_history_partition(spark.table(view)),
                            dedup_order=dedup_order, stored=True)
    finally:
        drop_staging(spark, view)
    if count_total:
        result["total_rows"] = read_table(spark, history).count()
    return result


def _write_fact(spark: SparkSession, history: str, path: str, touched: list | None) -> tuple[int, list | None]:
    """Write the fact table, partitioned as the history, or its touched
    partitions only. Returns the rows written and the days whose summary may
    differ now (None: all)."""
    if touched is None or not table_exists(spark, path):
        fact = with_history_partition(fact_flights(read_history(spark, history)))
        return replace_table(fact, path, HISTORY_PARTITION), None
    new = partitions_of(spark, history, HISTORY_PARTITION, touched)
    if new is None:
        return 0, []
    fact = fact_flights(new)
    # A merged row leaves its old day, so the old rows' days count too.
    old = partitions_of(spark, path, HISTORY_PARTITION, touched)
    parts = [fact] if old is None else [fact, old]
    days = set()
    for part in parts:
        day = utc_day("ingested_at", part.schema["ingested_at"].dataType.simpleString())
        days |= {r[0] for r in part.select(day.alias("d")).distinct().collect()}   # days: a short list
    written = put_partitions(with_history_partition(fact), path, HISTORY_PARTITION, touched)
    return written, sorted(days - {None})


def _on_days(fact: DataFrame, days: list) -> DataFrame:
    """Rows of some days of ``ingested_at``; the range around them is pushed to the scan."""
    stamp = fact.schema["ingested_at"].dataType.simpleString()
    first, last = days[0] - dt.timedelta(days=1), days[-1] + dt.timedelta(days=2)   # any session zone
    return fact.filter((F.col("ingested_at") >= F.lit(first.isoformat()).cast(stamp))
                       & (F.col("ingested_at") < F.lit(last.isoformat()).cast(stamp))
                       & utc_day("ingested_at", stamp).isin(days))


def _write_state(spark: SparkSession, history: str, path: str, touched: list | None, state) -> None:
    """Write the state of a mart for the touched partitions, or for all."""
    if touched is None or not table_exists(spark, path):
        replace_table(state(with_history_partition(read_history(spark, history)), HISTORY_PARTITION), path,
                      HISTORY_PARTITION)
        return
    new = partitions_of(spark, history, HISTORY_PARTITION, touched)
    if new is not None:
        put_partitions(state(with_history_partition(new), HISTORY_PARTITION), path, HISTORY_PARTITION, touched)


def mart_table(marts: str, name: str) -> str:
    """Where a mart is: a folder below ``marts`` if that is a path, else a table of the database ``marts``."""
    return f"{marts.rstrip('/')}/{name}" if named.is_path(marts) else f"{marts}.{name}"


def build_mart_tables(spark: SparkSession, history: str, marts: str, touched: list | None = None) -> dict[str, int]:
    """Run the mart builders in order; returns rows written per mart.

    ``history`` is a path or a table name, ``marts`` a folder or a database.
    ``touched`` lists the history partitions changed since the last run (as
    ``merge_into``, ``load_history`` and ``accumulate`` report them; None: all, also after a
    run that stopped between the load and this step). With it the history is
    read in those partitions only: the fact table is rewritten there, the daily
    summary computed for the days they hold, and the dimensions are summed from
    a state per partition (``<mart>__days``) of which the same partitions are renewed.
    """
    written: dict[str, int] = {}
    days = None
    for name, build in MART_BUILDERS.items():
        path = mart_table(marts, name)
        if name == FACT_MART:
            written[name], days = _write_fact(spark, history, path, touched)
        elif name == MERGED_MART:
            if days == []:
                written[name] = 0
                continue
            fact = read_mart(spark, marts, FACT_MART)
            fact = fact if days is None else _on_days(fact, days)
            written[name] = upsert_table(spark, path, build({FACT_MART: fact}), DAILY_KEYS, DAILY_MEASURES)["rows_written"]
        else:
            state, mart = STATE_MARTS[name]
            kept = mart_table(marts, f"{name}__days")
            _write_state(spark, history, kept, touched, state)
            written[name] = replace_table(mart(read_table(spark, kept)), path)
    return written


def read_mart(spark: SparkSession, marts: str, name: str) -> DataFrame:
    return read_table(spark, mart_table(marts, name)).drop(HISTORY_PARTITION)
