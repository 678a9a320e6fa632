"""Physical plans: pruning, pushdown, top-k, broadcast only where sized,
partition-limited merge, whole-stage code generation."""

import datetime as dt
import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from skyfold.operators.upsert import find_matched_keys, upsert
from skyfold.plans.fixture import batch_a, batch_b, keyed_history
from skyfold.plans.tables import merge_into, touched_partitions, with_history_partition
from skyfold.schema import HISTORY_KEYS, HISTORY_UPDATE_COLUMNS
from tests_support import SF_SMALL, events_small


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_used_columns(spark):
    p = plan(entry.queries()["flagship_country_mart"](spark, SF_SMALL))
    read = [line for line in p.splitlines() if "ReadSchema" in line or "FileScan" in line][0]
    assert "props" not in read and "ts:" not in read
    assert "event_id" in read and "value" in read


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["top10_countries"](spark, SF_SMALL))


def test_day_select_is_partition_filter(spark):
    p = plan(entry.queries()["date_partition_select"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(ingest_date" in p


def test_retention_pushed_to_scan(spark):
    p = plan(entry.queries()["retention_90d"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p


def _stored_pair(spark, tmp_dir):
    """Batches A and B as files, so that a plan shows what it reads of each."""
    keyed = keyed_history(events_small(spark)).drop("event_id")
    paths = [os.path.join(tmp_dir, n) for n in ("target", "source")]
    for batch, path in zip((batch_a(keyed), batch_b(keyed)), paths):
        batch.write.parquet(path)
    return [spark.read.parquet(p) for p in paths], paths


def _scans(p: str, path: str) -> list[str]:
    return [line for line in p.splitlines() if "FileScan" in line and path in line]


def test_small_source_merge_never_shuffles_the_target(spark, tmp_dir):
    (a, b), (target, _) = _stored_pair(spark, tmp_dir)
    p = plan(upsert(a, b, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS, broadcast_max_rows=10_000_000))
    joins = [line for line in p.splitlines() if "Join" in line]
    # the target takes its new values in a broadcast join; a second look reads its keys only
    assert any("BroadcastHashJoin" in j and "LeftOuter, BuildRight" in j for j in joins)
    assert not any("FullOuter" in j or "SortMerge" in j for j in joins)
    rows, keys = sorted(_scans(p, target), key=len, reverse=True)
    assert "callsign" in rows and "callsign" not in keys
    # with the keys known from before, the target is read once
    known = find_matched_keys(a, b, HISTORY_KEYS).checkpoint()
    p = plan(upsert(a, b, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS, broadcast_max_rows=10_000_000, matched_keys=known))
    assert len(_scans(p, target)) == 1


def test_general_merge_reads_each_input_once(spark, tmp_dir):
    (a, b), paths = _stored_pair(spark, tmp_dir)
    p = plan(upsert(a, b, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS))
    assert [len(_scans(p, path)) for path in paths] == [1, 1]


def test_general_merge_is_one_join(spark):
    p = plan(entry.queries()["upsert_composite_key"](spark, SF_SMALL))
    assert p.count("SortMergeJoin") + p.count("ShuffledHashJoin") == 1


def test_merge_reads_touched_partitions_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "history")
    keyed = keyed_history(events_small(spark)).drop("event_id")
    merge_into(spark, path, with_history_partition(batch_a(keyed)))
    part = touched_partitions(spark, path, "snapshot_date", [dt.date(2024, 1, 3), None])
    p = plan(part)
    assert "PartitionFilters: [" in p and "snapshot_date" in p.split("PartitionFilters")[1].split("]")[0]
    assert {r.snapshot_date for r in part.select(
        F.date_from_unix_date(F.floor(F.col("snapshot_time") / 86400).cast("int")).alias("snapshot_date")
    ).distinct().collect()} == {dt.date(2024, 1, 3)}


def test_transform_is_whole_stage_codegen(spark):
    p = plan(entry.queries()["clean_units"](spark, SF_SMALL))
    assert "*(" in p and "PythonUDF" not in p and "BatchEvalPython" not in p


def test_counts_of_a_day_are_taken_in_the_writing_stage(spark, tmp_dir, monkeypatch):
    """No shuffle lies between the counters and the write, so a stage that runs again counts nothing twice."""
    from skyfold.plans import steps
    from skyfold.plans.fixture import flight_fixture, state_vector
    from skyfold.sources import land_snapshots, pack_snapshots

    fx = flight_fixture(events_small(spark))
    land_snapshots(pack_snapshots(fx, "snapshot_time", state_vector(fx), "event_id"), os.path.join(tmp_dir, "l"), "UTC")
    seen = []
    real = steps.write_partitions
    monkeypatch.setattr(steps, "write_partitions", lambda df, *a, **k: (seen.append(plan(df)), real(df, *a, **k))[1])
    for day in (None, "2024-01-05"):
        out = steps.process_day(spark, os.path.join(tmp_dir, "l"), os.path.join(tmp_dir, "p"), day)
        assert out["vectors"] - out["rows_lost"] == out["rows_written"] > 0 and out["documents"] > 0
    for p in seen:
        assert p.count("CollectMetrics") == 2
        assert "Exchange" not in p[:p.rindex("CollectMetrics")]
