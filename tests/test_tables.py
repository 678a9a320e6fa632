"""Table operations on a folder: first-run create, partition-limited merge,
replace, retention."""

import os

import pytest
from pyspark.sql import functions as F

from skyfold.plans.fixture import batch_a, batch_b, keyed_history
from skyfold.plans.tables import (
    HISTORY_PARTITION, expire_partitions, merge_into, read_history, replace_table, retain_recent,
    table_exists, touched_partitions, upsert_table, with_history_partition,
)
from skyfold.operators import upsert
from skyfold.schema import HISTORY_KEYS, HISTORY_UPDATE_COLUMNS
from tests_support import events_small


def _mtimes(root):
    out = {}
    for d in os.listdir(root):
        if d.startswith(HISTORY_PARTITION):
            files = [f for f in os.listdir(os.path.join(root, d)) if f.endswith(".parquet")]
            out[d] = sorted((f, os.path.getmtime(os.path.join(root, d, f))) for f in files)
    return out


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_merge_rewrites_touched_partitions_only(spark, tmp_dir):
    keyed = keyed_history(events_small(spark)).drop("event_id")
    a, b = batch_a(keyed), batch_b(keyed)
    path = os.path.join(tmp_dir, "history")
    assert not table_exists(spark, path)
    first = merge_into(spark, path, with_history_partition(a))
    assert first["created"] and table_exists(spark, path)
    before = _mtimes(path)
    second = merge_into(spark, path, with_history_partition(b))
    after = _mtimes(path)
    assert not second["created"]
    untouched = [d for d in before if d < f"{HISTORY_PARTITION}=2024-01-11"]
    assert untouched and all(before[d] == after[d] for d in untouched)
    expected = upsert(a, b, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS)
    assert _rows(read_history(spark, path)) == _rows(expected)
    # a second merge of the same batch changes nothing
    merge_into(spark, path, with_history_partition(b))
    assert _rows(read_history(spark, path)) == _rows(expected)


def test_upsert_table_created_on_first_use(spark, tmp_dir):
    path = os.path.join(tmp_dir, "daily")
    s1 = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "d string, n int")
    s2 = spark.createDataFrame([("2024-01-02", 5), ("2024-01-03", 6)], "d string, n int")
    assert upsert_table(spark, path, s1, ["d"])["created"]
    assert not upsert_table(spark, path, s2, ["d"])["created"]
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [
        ("2024-01-01", 1), ("2024-01-02", 5), ("2024-01-03", 6)]


def test_retention(spark, tmp_dir):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    kept = retain_recent(orders, "o_orderdate", 90, "2001-08-01")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert kept.filter(F.col("o_orderdate") < F.lit("2001-05-03").cast("timestamp_ntz")).count() == 0
    path = os.path.join(tmp_dir, "by_day")
    (orders.withColumn("d", F.to_date("o_orderdate")).write.partitionBy("d").parquet(path))
    removed = expire_partitions(spark, path, "d", 90, "2001-08-01")
    assert removed and all(r < "d=2001-05-03" for r in removed)
    left = spark.read.parquet(path)
    assert left.count() == kept.count()


def test_exists_and_drop_staging(spark, tmp_dir):
    from skyfold.sources import drop_staging, load_staging

    assert drop_staging(spark, "no_such_view") is False          # missing: not an error
    path = os.path.join(tmp_dir, "t")
    spark.range(3).write.parquet(path)
    assert table_exists(spark, path) and not table_exists(spark, os.path.join(tmp_dir, "missing"))
    load_staging(spark, path, "stage_x")
    assert table_exists(spark, "stage_x")
    assert drop_staging(spark, "stage_x") is True and not table_exists(spark, "stage_x")


def test_failed_replace_keeps_the_old_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    replace_table(spark.range(5), path)
    bad = spark.range(3).select(F.expr("raise_error('no') ").cast("bigint").alias("id"))
    with pytest.raises(Exception):
        replace_table(bad, path)
    assert spark.read.parquet(path).count() == 5
    assert replace_table(spark.read.parquet(path).limit(2), path) == 2
    assert spark.read.parquet(path).count() == 2
    assert sorted(os.listdir(tmp_dir)) == ["t"]


def test_order_picks_one_row_per_key_on_every_run(spark, tmp_dir):
    path = os.path.join(tmp_dir, "h")
    rows = spark.createDataFrame([(7200, "a", 1.0, "x"), (7200, "a", 2.0, "y"), (7200, None, 1.0, "z"), (7200, None, 1.0, "z")],
                                 "snapshot_time bigint, icao24 string, last_contact double, callsign string")
    rows = with_history_partition(rows)
    for _ in range(2):
        merge_into(spark, path, rows, update=["callsign"], dedup_order=[-F.col("last_contact")])
        keyed = read_history(spark, path).filter("icao24 IS NOT NULL").collect()
        assert [r.callsign for r in keyed] == ["y"]
    assert read_history(spark, path).filter("icao24 IS NULL").count() == 4   # null keys never match


def test_merge_appends_where_nothing_matches(spark, tmp_dir):
    """A batch of new keys adds files to its day and leaves the day's own as they are."""
    path = os.path.join(tmp_dir, "h")
    schema = "snapshot_time bigint, icao24 string, callsign string"
    batch = lambda *rows: with_history_partition(spark.createDataFrame(list(rows), schema))
    day = 86400
    merge_into(spark, path, batch((0, "a", "x"), (day, "a", "x"), (None, "n", "x")), update=["callsign"])
    before = _mtimes(path)
    out = merge_into(spark, path, batch((3600, "a", "y"), (day, "a", "y"), (2 * day, "a", "y"), (None, "n", "y")),
                     update=["callsign"])
    assert (out["rows_written"], out["partitions"], out["rewritten"]) == (4, 4, 1)
    after = _mtimes(path)
    first = f"{HISTORY_PARTITION}=1970-01-01"
    assert set(before[first]) < set(after[first])
    assert not set(before[f"{HISTORY_PARTITION}=1970-01-02"]) & set(after[f"{HISTORY_PARTITION}=1970-01-02"])
    assert _rows(read_history(spark, path)) == sorted(
        [(0, "a", "x"), (3600, "a", "y"), (day, "a", "y"), (2 * day, "a", "y"), (None, "n", "x"), (None, "n", "y")],
        key=lambda t: tuple((x is None, str(x)) for x in t))
    # by the shuffle plan too, and again without a change
    again = batch((3600, "a", "y"), (day, "a", "y"), (2 * day, "a", "y"))
    assert merge_into(spark, path, again, update=["callsign"], broadcast_max_rows=0)["rewritten"] == 3
    assert read_history(spark, path).count() == 6


def test_only_touched_folders_are_listed(spark, tmp_dir):
    path = os.path.join(tmp_dir, "h")
    rows = spark.createDataFrame([(0, "a"), (86400, "a"), (None, "a")], "snapshot_time bigint, icao24 string")
    merge_into(spark, path, with_history_partition(rows), update=[])
    import datetime as dt

    part = touched_partitions(spark, path, HISTORY_PARTITION, [dt.date(1970, 1, 2), dt.date(1999, 1, 1), None])
    assert {os.path.basename(os.path.dirname(f)) for f in part.inputFiles()} == {
        f"{HISTORY_PARTITION}=1970-01-02", f"{HISTORY_PARTITION}=__HIVE_DEFAULT_PARTITION__"}
    assert part.count() == 2
    assert touched_partitions(spark, path, HISTORY_PARTITION, [dt.date(1999, 1, 1)]) is None


@pytest.mark.parametrize("time", [3600, 0])
def test_failed_merge_keeps_the_old_table(spark, tmp_dir, time):
    """Whether the failing row would be appended or merged."""
    path = os.path.join(tmp_dir, "h")
    schema = "snapshot_time bigint, icao24 string, callsign string"
    merge_into(spark, path, with_history_partition(spark.createDataFrame([(0, "a", "x")], schema)), update=["callsign"])
    bad = with_history_partition(spark.createDataFrame([(time, "a", "y")], schema)).withColumn(
        "callsign", F.expr("raise_error('no')").cast("string"))
    with pytest.raises(Exception, match="no"):
        merge_into(spark, path, bad, update=["callsign"])
    assert [tuple(r) for r in read_history(spark, path).collect()] == [(0, "a", "x")]


def test_unfinished_output_is_no_table(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "t", "_temporary", "0"))
    open(os.path.join(tmp_dir, "t", "_temporary", "0", "part-0.parquet"), "w").close()
    assert not table_exists(spark, os.path.join(tmp_dir, "t"))
