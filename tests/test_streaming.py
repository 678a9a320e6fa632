"""Incremental accumulation: catch-up after a missed run gives the same table."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from skyfold.operators import dedup_by
from skyfold.plans.fixture import flight_fixture, state_vector
from skyfold.plans.tables import expire_files, read_history
from skyfold.schema import HISTORY_KEYS
from skyfold.sources import land_snapshots, pack_snapshots
from skyfold.streaming import accumulate
from tests_support import events_small

def stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


def _docs(spark):
    fx = dedup_by(flight_fixture(events_small(spark)), HISTORY_KEYS, "event_id")
    return pack_snapshots(fx, "snapshot_time", state_vector(fx), "event_id").cache()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_catch_up_equals_full_load(spark, tmp_dir):
    docs = _docs(spark)
    day = 1704067200 + 15 * 86400
    early, late = docs.filter(F.col("time") < day), docs.filter(F.col("time") >= day)

    # one run per landing
    land1, hist1, ck1 = (os.path.join(tmp_dir, p) for p in ("l1", "h1", "c1"))
    land_snapshots(early, land1, "Asia/Kolkata")
    r1 = accumulate(spark, land1, hist1, ck1, ingested_at=stamp())
    land_snapshots(late, land1, "Asia/Kolkata")
    r2 = accumulate(spark, land1, hist1, ck1, ingested_at=stamp())
    assert r1["batches"] >= 1 and r2["batches"] >= 1
    # nothing new: no batch
    assert accumulate(spark, land1, hist1, ck1, ingested_at=stamp())["batches"] == 0

    # a missed run: both landings processed by the next run, plus a re-fetch
    land2, hist2, ck2 = (os.path.join(tmp_dir, p) for p in ("l2", "h2", "c2"))
    land_snapshots(early, land2, "Asia/Kolkata")
    land_snapshots(late, land2, "Asia/Kolkata")
    land_snapshots(late, land2, "Asia/Kolkata")
    accumulate(spark, land2, hist2, ck2, ingested_at=stamp())

    a, b = _rows(read_history(spark, hist1)), _rows(read_history(spark, hist2))
    assert a == b and len(a) > 0


def test_duplicate_keys_in_a_batch(spark, tmp_dir):
    import pytest
    from pyspark.errors import StreamingQueryException

    vec = ["a1", "OLDER", "India", "1.0", "2.0", "77.0", "20.0", "100.0", "false", "10.0", "0.0", "0.0",
           None, "100.0", "0001", None, "1"]
    newer = list(vec)
    newer[1], newer[3], newer[4] = "NEWER", "5.0", "3.0"   # a later report of the same aircraft
    docs = spark.createDataFrame([(7200, 0, [vec]), (7200, 1, [newer])],
                                 "time bigint, part int, states array<array<string>>")
    first, both = os.path.join(tmp_dir, "l0"), os.path.join(tmp_dir, "l1")
    land_snapshots(docs.filter("part = 0"), first, "Asia/Kolkata")
    land_snapshots(docs, both, "Asia/Kolkata")
    hist = os.path.join(tmp_dir, "h")
    accumulate(spark, first, hist, os.path.join(tmp_dir, "c0"), ingested_at=stamp())
    with pytest.raises(StreamingQueryException):       # two rows for one key: a MERGE error
        accumulate(spark, both, hist, os.path.join(tmp_dir, "c1"), ingested_at=stamp())
    accumulate(spark, both, hist, os.path.join(tmp_dir, "c2"), ingested_at=stamp(),
               key_order=[-F.col("last_contact")])      # the newest report wins
    rows = read_history(spark, hist).collect()
    assert len(rows) == 1 and rows[0].callsign == "NEWER"
    assert (rows[0].time_position, rows[0].last_contact) == (1.0, 2.0)   # kept from the stored row


def test_a_backlog_in_bounded_batches(spark, tmp_dir):
    vec = ["a1", "CALL", "India", "1.0", "2.0", "77.0", "20.0", "100.0", "false", "10.0", "0.0", "0.0",
           None, "100.0", "0001", None, "1"]
    landing = os.path.join(tmp_dir, "l")
    for hour in range(3):
        docs = spark.createDataFrame([(7200 + 3600 * hour, 0, [vec])], "time bigint, part int, states array<array<string>>")
        land_snapshots(docs, landing, "Asia/Kolkata")
    one, whole = os.path.join(tmp_dir, "h1"), os.path.join(tmp_dir, "h2")
    done = accumulate(spark, landing, one, os.path.join(tmp_dir, "c1"), ingested_at=stamp(), max_files_per_trigger=1)
    accumulate(spark, landing, whole, os.path.join(tmp_dir, "c2"), ingested_at=stamp())
    assert done["batches"] == 3 and _rows(read_history(spark, one)) == _rows(read_history(spark, whole))


@pytest.mark.parametrize("by_name", [False, True])
def test_a_replayed_batch_adds_no_row_without_a_key(spark, tmp_dir, by_name):
    """The run stops after the merge and before the stream notes the batch as done."""
    landing, checkpoint = (os.path.join(tmp_dir, p) for p in ("landing", "checkpoint"))
    history = os.path.join(tmp_dir, "history")
    if by_name:
        spark.sql(f"CREATE DATABASE replay_db LOCATION '{tmp_dir}/replay.db'")
        history = "replay_db.history"
    try:
        vector = ["a1", "C1 ", "Norway", 1.0, 2.0, 77.0, 21.0, 9000.0, False, 200.0, 145.0, 0, None, 9400.0, "2107", False, 0]
        for i, time in enumerate([None, 1704067200, None]):
            os.makedirs(landing, exist_ok=True)
            with open(os.path.join(landing, f"d{i}.json"), "w") as f:
                f.write(json.dumps({"time": time, "states": [vector, [f"b{i}", *vector[1:]]]}))
            accumulate(spark, landing, history, checkpoint, ingested_at=stamp())
            rows = _rows(read_history(spark, history))
            assert len(rows) == 2 * (i + 1)
            last = max(int(n) for n in os.listdir(os.path.join(checkpoint, "commits")) if n.isdigit())
            for name in (str(last), f".{last}.crc"):
                os.remove(os.path.join(checkpoint, "commits", name))
            again = accumulate(spark, landing, history, checkpoint, ingested_at=stamp())
            assert again["rows_merged"] == 0 and _rows(read_history(spark, history)) == rows
    finally:
        if by_name:
            spark.sql("DROP DATABASE replay_db CASCADE")


def test_read_files_are_archived(spark, tmp_dir):
    docs = _docs(spark)
    landing, archive, history, checkpoint = (os.path.join(tmp_dir, p) for p in ("landing", "archive", "h", "c"))
    files = lambda root: {f for _, _, names in os.walk(root) for f in names if f.endswith(".json")}
    day = 1704067200 + 10 * 86400
    landed = []
    for i in range(3):
        land_snapshots(docs.filter((F.col("time") >= day + i * 86400) & (F.col("time") < day + (i + 1) * 86400)), landing, "UTC")
        landed.append(files(landing) | files(archive))
        accumulate(spark, landing, history, checkpoint, ingested_at=stamp(), archive=archive)
    assert landed[0] <= files(archive) and files(landing) | files(archive) == landed[2]
    assert not landed[0] & files(landing)


def test_old_files_expire_by_their_own_age(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    land_snapshots(_docs(spark), landing, "UTC")
    names = sorted(os.path.join(d, f) for d, _, fs in os.walk(landing) for f in fs if f.endswith(".json"))
    now = dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc)
    for i, name in enumerate(names):
        os.utime(name, (now.timestamp() - i * 86400 - 60,) * 2)
    old = len(names) - 5
    assert expire_files(spark, landing, 5, now) == old > 0
    assert sorted(os.path.join(d, f) for d, _, fs in os.walk(landing) for f in fs if f.endswith(".json")) == sorted(names[:5])
    assert expire_files(spark, landing, 5, now.replace(tzinfo=None)) == 0
