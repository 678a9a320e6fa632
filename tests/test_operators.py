"""Dedup, upsert and profiles: hand-made rows and properties."""

import pytest
from pyspark.sql import functions as F

from skyfold.operators import (
    DuplicateSourceKeyError, dedup_by, loss_report, null_profile, top_k, upsert, value_counts,
)

DDL = "k1 bigint, k2 string, a string, b double, keep double"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def _both(target, source, **kw):
    """Result of both merge plans; they must agree."""
    full = _rows(upsert(target, source, ["k1", "k2"], ["a", "b"], **kw))
    small = _rows(upsert(target, source, ["k1", "k2"], ["a", "b"], broadcast_max_rows=1000, **kw))
    assert full == small
    return full


def test_upsert_semantics(spark):
    target = spark.createDataFrame([
        (1, "x", "old", 1.0, 10.0),
        (2, "x", "old", 2.0, 20.0),
        (None, "x", "nullkey", 3.0, 30.0),
    ], DDL)
    source = spark.createDataFrame([
        (1, "x", "new", None, 99.0),      # matched: b becomes null, keep stays 10
        (3, "x", "ins", 4.0, 40.0),       # inserted whole
        (None, "x", "nullkey", 5.0, 50.0),  # null key: never matches, inserted
    ], DDL)
    got = _both(target, source)
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert got == sorted([
        (1, "x", "new", None, 10.0),
        (2, "x", "old", 2.0, 20.0),
        (3, "x", "ins", 4.0, 40.0),
        (None, "x", "nullkey", 3.0, 30.0),
        (None, "x", "nullkey", 5.0, 50.0),
    ], key=key)


def test_upsert_duplicate_source_key(spark):
    target = spark.createDataFrame([(1, "x", "t", 1.0, 1.0)], DDL)
    source = spark.createDataFrame([(1, "x", "s1", 1.0, 1.0), (1, "x", "s2", 2.0, 2.0)], DDL)
    with pytest.raises(DuplicateSourceKeyError):
        upsert(target, source, ["k1", "k2"], ["a", "b"])
    got = _both(target, source, dedup_order="b")
    assert got == [(1, "x", "s1", 1.0, 1.0)]


def test_upsert_properties(spark):
    from tests_support import events_small
    from skyfold.plans.fixture import batch_a, batch_b, keyed_history
    from skyfold.schema import HISTORY_KEYS, HISTORY_UPDATE_COLUMNS

    keyed = keyed_history(events_small(spark)).drop("event_id")
    a, b = batch_a(keyed), batch_b(keyed)
    once = upsert(a, b, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS)
    twice = upsert(once, b, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS)
    assert _rows(once) == _rows(twice)
    unmatched = b.join(a, HISTORY_KEYS, "left_anti").count()
    assert once.count() == a.count() + unmatched


def test_dedup_ordered_and_skewed_key(spark):
    rows = [(1 if i % 3 else 2, i, f"v{i}") for i in range(3000)]  # key 1 holds two thirds
    df = spark.createDataFrame(rows, "k int, o int, v string").repartition(6)
    got = sorted(tuple(r) for r in dedup_by(df, ["k"], "o").collect())
    assert got == [(1, 1, "v1"), (2, 0, "v0")]
    assert dedup_by(df, ["k"]).count() == 2


def test_profiles(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("b", None), (None, 2.0), ("a", 3.0), ("c", 4.0)],
                               "c string, x double")
    prof = null_profile(df).first()
    assert (prof.c, prof.x) == (1, 2)
    # ties broken by value, ascending
    assert [tuple(r) for r in top_k(df, "c", 2).collect()] == [("a", 2), ("b", 2)]
    assert sum(r["count"] for r in value_counts(df, "c").collect()) == df.count()
    loss = loss_report(df, F.col("c").isNotNull() & F.col("x").isNotNull()).first()
    assert (loss.rows_before, loss.rows_after, loss.rows_lost) == (6, 3, 3)


def test_null_plus_present_equals_rows(spark):
    from tests_support import events_small
    from skyfold.plans.fixture import fixture_history

    hist = fixture_history(events_small(spark))
    n = hist.count()
    prof = null_profile(hist).first().asDict()
    present = hist.agg(*[F.count(c).alias(c) for c in hist.columns]).first().asDict()
    assert all(prof[c] + present[c] == n for c in hist.columns)


def test_many_null_keys_spread_and_kept(spark):
    rows = [(None if i % 3 == 0 else i, "x", f"t{i}", float(i), 0.0) for i in range(300)]
    target = spark.createDataFrame(rows, DDL)
    source = spark.createDataFrame(
        [(None, "x", f"s{i}", 1.0, 1.0) for i in range(200)] + [(1, "x", "upd", 9.0, 9.0)], DDL)
    merged = upsert(target, source, ["k1", "k2"], ["a", "b"])
    assert merged.count() == 300 + 200
    assert merged.filter(F.col("k1").isNull()).count() == 100 + 200
    assert merged.filter(F.col("k1") == 1).first().a == "upd"
    # one scan of each input; a hash of the row deals null keys over the tasks
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 2 and "Union" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        at = merged.filter(F.col("k1").isNull()).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(at) > 4 and max(r["count"] for r in at) < 150


def test_broadcast_plan_needs_both_bounds(spark):
    target = spark.createDataFrame([(1, "x", "t", 1.0, 1.0)], DDL)
    source = spark.createDataFrame([(1, "x", "s", 2.0, 2.0), (2, "y" * 100, "i", 3.0, 3.0)], DDL)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    small = upsert(target, source, ["k1", "k2"], ["a", "b"], broadcast_max_rows=10)
    assert "LeftOuter, BuildRight" in plan(small) and "FullOuter" not in plan(small)
    wide = upsert(target, source, ["k1", "k2"], ["a", "b"], broadcast_max_rows=10, broadcast_max_bytes=50)
    assert "FullOuter" in plan(wide) and "LeftOuter" not in plan(wide)
    assert _rows(small) == _rows(wide)
