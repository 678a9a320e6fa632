"""The three batch steps: day by day equals all at once; re-runs change nothing."""

import os

from pyspark.sql import functions as F

from skyfold.plans.fixture import flight_fixture, state_vector
from skyfold.plans.steps import build_mart_tables, load_history, process_day, read_mart
from skyfold.plans.tables import read_history
from skyfold.operators import dedup_by
from skyfold.schema import HISTORY_KEYS
from skyfold.sources import land_snapshots, pack_snapshots
from tests_support import events_small


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_day_by_day_equals_one_load(spark, tmp_dir):
    fx = dedup_by(flight_fixture(events_small(spark)), HISTORY_KEYS, "event_id")
    fx = fx.filter(F.col("snapshot_time") < 1704067200 + 2 * 86400 - 19800)  # two local days
    docs = pack_snapshots(fx, "snapshot_time", state_vector(fx), "event_id")
    landing = os.path.join(tmp_dir, "landing")
    land_snapshots(docs, landing, "Asia/Kolkata")
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    p = {k: os.path.join(tmp_dir, k) for k in ("proc1", "hist1", "marts1", "proc2", "hist2", "marts2")}

    per_day = 0
    for day in ("2024-01-01", "2024-01-02"):
        out = process_day(spark, landing, p["proc1"], day, ingested_at=stamp)
        report = out["report"]
        assert report["row_count"].first()[0] == out["rows_written"] > 0
        assert 0 < out["documents"] <= 24      # one document per hourly snapshot
        assert out["vectors"] - out["rows_lost"] == out["rows_written"] and out["rows_lost"] > 0
        per_day += out["rows_written"]
        # processing a day again replaces that day only
        assert process_day(spark, landing, p["proc1"], day, ingested_at=stamp)["rows_written"] == out["rows_written"]
        load_history(spark, p["proc1"], p["hist1"], day)
        load_history(spark, p["proc1"], p["hist1"], day)     # a re-run changes nothing
        build_mart_tables(spark, p["hist1"], p["marts1"])
    # both days' outputs are still whole after the second day was written
    assert spark.read.parquet(p["proc1"]).count() == per_day

    process_day(spark, landing, p["proc2"], ingested_at=stamp)
    first = load_history(spark, p["proc2"], p["hist2"])
    assert first["created"]
    build_mart_tables(spark, p["hist2"], p["marts2"])

    assert _rows(read_history(spark, p["hist1"])) == _rows(read_history(spark, p["hist2"]))
    for mart in ("dim_countries", "dim_flight_phases", "agg_flights_daily"):
        assert _rows(read_mart(spark, p["marts1"], mart)) == _rows(read_mart(spark, p["marts2"], mart)), mart
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("history_staging")]


def test_day_of_the_landing_is_the_day_of_the_output(spark, tmp_dir):
    """Landed by UTC day, processed day by day: every row is kept, and a day that yields nothing empties."""
    from skyfold.plans.fixture import flight_fixture, state_vector
    fx = dedup_by(flight_fixture(events_small(spark)), HISTORY_KEYS, "event_id")
    fx = fx.filter(F.col("snapshot_time") < 1704067200 + 2 * 86400)
    landing, proc = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "proc")
    land_snapshots(pack_snapshots(fx, "snapshot_time", state_vector(fx), "event_id"), landing, "UTC")
    written = [process_day(spark, landing, proc, d)["rows_written"] for d in ("2024-01-01", "2024-01-02")]
    assert spark.read.parquet(proc).count() == sum(written) and min(written) > 0
    empty = os.path.join(tmp_dir, "empty")
    land_snapshots(spark.createDataFrame([(1704067200, 0, [[None] * 17])], "time bigint, part int, states array<array<string>>"),
                   empty, "UTC")
    assert process_day(spark, empty, proc, "2024-01-01")["rows_written"] == 0
    assert spark.read.parquet(proc).count() == written[1]
    assert process_day(spark, empty, os.path.join(tmp_dir, "fresh"), "2024-01-01")["rows_written"] == 0


def test_marts_of_touched_partitions_equal_a_full_build(spark, tmp_dir):
    from skyfold.plans.fixture import batch_a, batch_b, keyed_history
    from skyfold.plans.tables import merge_into, with_history_partition

    keyed = keyed_history(events_small(spark)).drop("event_id").checkpoint()
    history, grown, full = (os.path.join(tmp_dir, d) for d in ("history", "grown", "full"))
    for batch in (batch_a(keyed), batch_b(keyed)):
        touched = merge_into(spark, history, with_history_partition(batch))["touched"]
        written = build_mart_tables(spark, history, grown, touched)
        build_mart_tables(spark, history, full)
    for mart in ("fct_flights", "dim_countries", "dim_flight_phases", "agg_flights_daily"):
        assert _rows(read_mart(spark, grown, mart)) == _rows(read_mart(spark, full, mart)), mart
    assert 0 < written["fct_flights"] < read_history(spark, history).count()
    assert build_mart_tables(spark, history, grown, [])["fct_flights"] == 0   # nothing touched: nothing written
    assert _rows(read_mart(spark, grown, "fct_flights")) == _rows(read_mart(spark, full, "fct_flights"))
