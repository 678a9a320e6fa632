"""Tables by catalog name: merge, replace, atomic publication, versions, retention."""

import os

import pytest
from pyspark.sql import functions as F

from skyfold.operators import upsert
from skyfold.plans import named
from skyfold.plans.fixture import batch_a, batch_b, keyed_history
from skyfold.plans.steps import build_mart_tables, load_history, read_mart
from skyfold.plans.tables import (
    expire_partitions, merge_into, read_history, replace_table, table_exists, upsert_table, with_history_partition,
)
from skyfold.schema import HISTORY_KEYS, HISTORY_UPDATE_COLUMNS
from skyfold.sources.parquet import write_partitions
from tests_support import events_small

SCHEMA = "snapshot_time bigint, icao24 string, callsign string"
DAY = 86400


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def _batch(spark, *rows):
    return with_history_partition(spark.createDataFrame(list(rows), SCHEMA))


@pytest.fixture()
def db(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE named_db LOCATION '{tmp_dir}/named.db'")
    yield "named_db"
    spark.sql("DROP DATABASE named_db CASCADE")


@pytest.fixture(scope="module")
def batches(spark):
    keyed = keyed_history(events_small(spark)).drop("event_id").checkpoint()
    return batch_a(keyed), batch_b(keyed)


@pytest.mark.parametrize("settings", [{}, {"broadcast_max_rows": 0}, {"buckets": 4, "broadcast_max_rows": 0}])
def test_merge_by_name_equals_upsert(spark, db, batches, settings):
    a, b = batches
    name = f"{db}.history"
    assert not table_exists(spark, name)
    first = merge_into(spark, name, with_history_partition(a), **settings)
    assert first["created"] and table_exists(spark, name) and first["rows_written"] == a.count()
    second = merge_into(spark, name, with_history_partition(b), **settings)
    assert not second["created"] and 0 < second["rewritten"] < second["partitions"]
    expected = _rows(upsert(a, b, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS))
    assert _rows(read_history(spark, name).select(*a.columns)) == expected
    merge_into(spark, name, with_history_partition(b), **settings)      # again: no change
    assert _rows(read_history(spark, name).select(*a.columns)) == expected
    assert not os.path.exists("named_db.history") and not os.path.exists("history")


def test_names_without_a_database_and_null_partitions(spark):
    rows = [(0, "a", "x"), (DAY, "a", "x"), (None, "n", "x")]
    try:
        merge_into(spark, "plain_history", _batch(spark, *rows), update=["callsign"])
        out = merge_into(spark, "plain_history", _batch(spark, (3600, "b", "y"), (DAY, "a", "y"), (None, "n", "y")),
                         update=["callsign"])
        assert (out["rows_written"], out["partitions"], out["rewritten"]) == (3, 3, 1)
        assert _rows(read_history(spark, "plain_history")) == _rows(spark.createDataFrame(
            [(0, "a", "x"), (3600, "b", "y"), (DAY, "a", "y"), (None, "n", "x"), (None, "n", "y")], SCHEMA))
        assert spark.table("plain_history").filter("snapshot_date IS NULL").count() == 2
    finally:
        assert named.drop(spark, "plain_history") and not table_exists(spark, "plain_history")
        assert named.drop(spark, "plain_history") is False


def test_merge_changes_a_table_made_elsewhere(spark, db, batches):
    """Plain catalog tables: in one piece, and partitioned by the history's partition."""
    a, b = batches
    expected = _rows(upsert(a, b, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS))
    a.write.saveAsTable(f"{db}.whole")
    with_history_partition(a).write.partitionBy("snapshot_date").saveAsTable(f"{db}.by_day")
    for name in (f"{db}.whole", f"{db}.by_day"):
        merge_into(spark, name, with_history_partition(b))
        assert _rows(spark.table(name).select(*a.columns)) == expected, name
    assert replace_table(spark.table(f"{db}.whole").limit(3), f"{db}.whole") == 3
    assert spark.table(f"{db}.whole").count() == 3


def test_what_is_no_table_is_refused(spark, db):
    batch = _batch(spark, (0, "a", "x"))
    for bad in ("no_such_db.history", "not a name", "a.b.c.d", "other_catalog.db.t", ""):
        with pytest.raises(named.TableNameError):
            merge_into(spark, bad, batch, update=["callsign"])
        with pytest.raises(named.TableNameError):
            replace_table(batch, bad)
    batch.createOrReplaceTempView("some_batch")
    spark.sql(f"CREATE VIEW {db}.foreign_view AS SELECT 1 AS x")
    for view in ("some_batch", f"{db}.foreign_view"):
        with pytest.raises(named.TableNameError):
            merge_into(spark, view, batch, update=["callsign"])
    spark.catalog.dropTempView("some_batch")
    with pytest.raises(named.TableNameError):
        expire_partitions(spark, f"{db}.nothing", "snapshot_date", 1, "2024-01-01")
    with pytest.raises(named.TableNameError):
        merge_into(spark, "/some/folder", batch, update=["callsign"], buckets=4)


STEPS = ["_create_version", "_enter_partitions", "_insert", "_switch"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("killed", [False, True])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_writer_stopped_at_any_step_leaves_the_old_or_the_new_table(spark, db, monkeypatch, step, killed, when):
    """``killed``: the writer dies without cleaning up. Merges touch two days; both change or neither."""
    name = f"{db}.history"
    merge_into(spark, name, _batch(spark, (0, "a", "x"), (DAY, "a", "x"), (2 * DAY, "a", "x")), update=["callsign"])
    replace_table(spark.range(5), f"{db}.numbers")
    change = _batch(spark, (0, "a", "y"), (DAY, "a", "y"), (3 * DAY, "a", "y"))
    old = _rows(read_history(spark, name))
    new = _rows(spark.createDataFrame([(0, "a", "y"), (DAY, "a", "y"), (2 * DAY, "a", "x"), (3 * DAY, "a", "y")], SCHEMA))

    class Stopped(BaseException if killed else Exception):
        pass

    real = getattr(named, step)

    def stopping(*args):
        if when == "after":
            real(*args)
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(named, step, stopping)
        with pytest.raises(Stopped):
            merge_into(spark, name, change, update=["callsign"])
        with pytest.raises(Stopped):
            replace_table(spark.range(2), f"{db}.numbers")
    published = step == "_switch" and when == "after"
    assert _rows(read_history(spark, name)) == (new if published else old)
    assert spark.table(f"{db}.numbers").count() == (2 if published else 5)
    # The run is repeated, and what the stopped one left goes with the next vacuum.
    merge_into(spark, name, change, update=["callsign"])
    assert _rows(read_history(spark, name)) == new
    named.vacuum(spark, name, keep=1)
    assert _rows(read_history(spark, name)) == new
    assert len(named._versions(spark, db, "history")) == 1


def test_readers_of_an_old_version_finish_and_vacuum_removes_it(spark, db):
    name = f"{db}.history"
    merge_into(spark, name, _batch(spark, (0, "a", "x"), (DAY, "a", "x")), update=["callsign"])
    reader = read_history(spark, name)
    merge_into(spark, name, _batch(spark, (0, "a", "y")), update=["callsign"])
    assert {r.callsign for r in reader.collect()} == {"x"}
    merge_into(spark, name, _batch(spark, (0, "b", "z")), update=["callsign"])    # added, nothing rewritten
    assert len(named.specs_of(spark, named.find(spark, name))) == 3
    removed = named.vacuum(spark, name, keep=1)
    assert [r.split("/")[0] for r in removed] == ["snapshot_date=1970-01-01"]
    assert _rows(read_history(spark, name)) == [(0, "a", "y"), (0, "b", "z"), (DAY, "a", "x")]
    with pytest.raises(named.TableNameError):
        named.vacuum(spark, f"{db}.missing")


def test_a_failing_query_leaves_the_old_table_and_nothing_behind(spark, db):
    name = f"{db}.t"
    replace_table(spark.range(5), name)
    bad = spark.range(3).select(F.expr("raise_error('no')").cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        replace_table(bad, name)
    assert spark.table(name).count() == 5 and named._versions(spark, db, "t") == [1]
    assert replace_table(spark.table(name).filter("id < 2"), name) == 2      # may read itself
    assert spark.table(name).count() == 2 and replace_table(spark.range(0), name) == 0
    assert spark.table(name).count() == 0


def test_second_writer_is_noticed(spark, db, monkeypatch):
    name = f"{db}.t"
    replace_table(spark.range(5), name)
    real = named._insert

    def overtaken(table, rows, write):
        with monkeypatch.context() as m:
            m.setattr(named, "_insert", real)
            replace_table(spark.range(7), name)
        return real(table, rows, write)

    with monkeypatch.context() as m:
        m.setattr(named, "_insert", overtaken)
        with pytest.raises(named.ConcurrentWriteError):
            replace_table(spark.range(9), name)
    assert spark.table(name).count() == 7


def test_crowded_days_are_rewritten(spark, db, monkeypatch):
    from skyfold.plans import tables

    monkeypatch.setattr(tables, "MAX_WRITES_PER_PARTITION", 3)
    name = f"{db}.history"
    for i in range(6):
        merge_into(spark, name, _batch(spark, (i, "a", "x")), update=["callsign"])
        assert len(named.specs_of(spark, named.find(spark, name))) <= 3
    assert spark.table(name).count() == 6


def test_bucketed_merge_shuffles_the_batch_only(spark, db, batches):
    a, b = batches
    name = f"{db}.history"
    merge_into(spark, name, with_history_partition(a), buckets=4)
    table = named.find(spark, name)
    assert table.buckets == 4 and list(table.bucket_by) == HISTORY_KEYS
    target = named.rows_of(spark, table)
    source = with_history_partition(b).select(*target.columns).checkpoint()
    merged = upsert(target, source, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS, check_unique=False, spread_nulls=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    above_target, above_source = plan[plan.index("SortMergeJoin"):].split("FileScan")[0], plan.split("FileScan")[-1]
    assert plan.count("Exchange") == 1 and "Exchange" not in above_target and "Exchange" in above_source
    assert "SelectedBucketsCount: 4 out of 4" in plan


def test_expire_by_name(spark, db):
    name = f"{db}.history"
    merge_into(spark, name, _batch(spark, (0, "a", "x"), (100 * DAY, "a", "x"), (None, "n", "x")), update=["callsign"])
    assert expire_partitions(spark, name, "snapshot_date", 30, "1970-04-11") == ["snapshot_date=1970-01-01"]
    assert _rows(read_history(spark, name)) == [(100 * DAY, "a", "x"), (None, "n", "x")]
    assert expire_partitions(spark, name, "snapshot_date", 30, "1970-04-11") == []


def test_load_and_marts_by_name_equal_those_in_folders(spark, db, tmp_dir, batches):
    for i, batch in enumerate(batches):
        staged = os.path.join(tmp_dir, f"processed{i}")
        write_partitions(batch.withColumn("ingest_date", F.lit("2024-01-01").cast("date")), staged, "ingest_date")
        for history, marts in ((f"{db}.history", db), (f"{tmp_dir}/history", f"{tmp_dir}/marts")):
            out = load_history(spark, staged, history, count_total=True)
            build_mart_tables(spark, history, marts, out["touched"])
    assert out["total_rows"] == read_history(spark, f"{db}.history").count()
    for mart in ("fct_flights", "dim_countries", "dim_flight_phases", "agg_flights_daily"):
        by_path = read_mart(spark, f"{tmp_dir}/marts", mart)
        assert _rows(read_mart(spark, db, mart).select(*by_path.columns)) == _rows(by_path), mart
    assert upsert_table(spark, f"{db}.agg_flights_daily", read_mart(spark, db, "agg_flights_daily"), ["flight_date"])["rows_written"]
