"""Scalar and labelling expressions on hand-worked edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from skyfold.functions import bucketize, local_date, slot, trim_upper
from skyfold.plans.fixture import flight_fixture
from skyfold.plans.preset import speed_category, transform_states

# Edge rows A-G: inputs and the expected results worked out by hand.
EDGE = [
    # row, baro_altitude, velocity, vertical_rate, on_ground, category,
    # altitude_feet, speed_kmh, vertical_rate_ftpm, flight_phase, flight_category, speed_category
    ("A", 11582.4, 219.46, 0.0, False, 0, 37994.9, 790.06, 0.0, "Cruising", "No Info", "Fast (600-900 km/h)"),
    ("B", 999.99, 250.0, -3.25, False, 4, 3280.37, 900.0, -639.76, "Takeoff / Landing", "Large Aircraft",
     "Very Fast (>900 km/h)"),
    ("C", 1000.0, 83.33, None, False, 13, 3280.4, 299.99, None, "Climbing / Descending", "Unknown",
     "Slow (<300 km/h)"),
    ("D", 6000.0, 166.67, None, False, 10, 19682.4, 600.01, None, "Climbing / Descending", "lighter Than Air",
     "Fast (600-900 km/h)"),
    ("E", 6000.01, 249.99, None, None, 17, 19682.43, 899.96, None, "Cruising", "Surface Vehicle - Service",
     "Fast (600-900 km/h)"),
    ("F", None, None, None, None, None, None, None, None, "Cruising", "Unknown", "Unknown"),
    ("G", 9000.0, 0.0, None, True, 1, 29523.6, 0.0, None, "On Ground", "No ADS-B Emitter", "Slow (<300 km/h)"),
]

MAPPED_DDL = ("row string, snapshot_time bigint, icao24 string, callsign string, origin_country string, "
              "time_position double, last_contact double, longitude double, latitude double, "
              "baro_altitude double, on_ground boolean, velocity double, true_track double, "
              "vertical_rate double, geo_altitude double, squawk string, category int")


def _mapped(spark):
    rows = [(r[0], 1772138472, "4b1c2d", "XYZ42  ", "Norway", 1.0, 2.0, 77.125, 21.5, r[1], r[4],
             r[2], 145.25, r[3], 9450.5, "2107", r[5]) for r in EDGE]
    return spark.createDataFrame(rows, MAPPED_DDL)


def test_edge_rows(spark):
    out = transform_states(_mapped(spark), F.lit(None).cast("timestamp_ntz"), carry=("row",))
    rows = out.withColumn("speed_category", speed_category()).collect()
    assert len(rows) == len(EDGE)
    by_row = {r.row: r for r in rows}
    for e in EDGE:
        r = by_row[e[0]]
        assert (r.altitude_feet, r.speed_kmh, r.vertical_rate_ftpm) == (e[6], e[7], e[8]), e[0]
        assert (r.flight_phase, r.flight_category, r.speed_category) == (e[9], e[10], e[11]), e[0]
        assert r.geo_altitude_feet == 31001.42
        assert r.callsign == "XYZ42"


def test_slot_casts(spark):
    df = spark.createDataFrame([(["a", "1.5", None, "true", "5.0", "abc"],)], "v array<string>")
    r = df.select(slot("v", 9).alias("oob"), slot("v", 1, "double").alias("d"),
                  slot("v", 3, "boolean").alias("b"), slot("v", 4, "int").alias("i"),
                  slot("v", 5, "double").alias("bad"), slot("v", 2, "double").alias("null")).first()
    assert r.oob is None and r.d == 1.5 and r.b is True and r.i == 5
    assert r.bad is None and r.null is None


def test_trim_spaces_only(spark):
    r = spark.createDataFrame([("   ",), (" cal7  ",)], "c string").select(trim_upper("c").alias("t")).collect()
    assert [x.t for x in r] == ["", "CAL7"]


def test_local_day_boundary(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 8, 20, 0),), (dt.datetime(2026, 3, 8, 18, 29),)],
                               "ts timestamp_ntz")
    days = [r.d for r in df.select(local_date("ts", "Asia/Kolkata").alias("d")).collect()]
    assert days == [dt.date(2026, 3, 9), dt.date(2026, 3, 8)]


def test_local_day_independent_of_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 8, 20, 0),)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        d = df.select(local_date("ts", "Asia/Kolkata").alias("d")).first().d
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert d == dt.date(2026, 3, 9)


def test_bucketize_half_open(spark):
    df = spark.createDataFrame([(None,), (299.99,), (300.0,), (899.99,), (900.0,)], "s double")
    labels = [r.b for r in df.select(bucketize("s", [(300, "lo"), (900, "mid")], "hi", "none").alias("b")).collect()]
    assert labels == ["none", "lo", "mid", "mid", "hi"]


def test_fixture_snapshot_time_zone_independent(spark):
    from tests_support import events_small

    ev = events_small(spark)
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        la = sorted(r.snapshot_time for r in flight_fixture(ev).select("snapshot_time").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    utc = sorted(r.snapshot_time for r in flight_fixture(ev).select("snapshot_time").collect())
    assert la == utc and all(t % 3600 == 0 for t in utc)


def test_avg_2dp_exact_ties(spark):
    from skyfold.functions import avg_2dp

    df = spark.createDataFrame(
        [("tie", 163.01), ("tie", 163.02), ("neg", -0.01), ("neg", -0.02), ("none", None),
         ("big", 4745.17), ("big", 4745.18), ("big", 4745.18), ("big", 4745.17),
         ("negbig", -1000.05), ("negbig", -1000.06), ("mixed", -700.01), ("mixed", 1400.04)],
        "g string, x double")
    got = {r.g: r.a for r in df.repartition(3).groupBy("g").agg(avg_2dp("x").alias("a")).collect()}
    assert got == {"tie": 163.02, "neg": -0.02, "none": None, "big": 4745.18,
                   "negbig": -1000.06, "mixed": 350.02}


def test_daily_key_independent_of_session_zone(spark):
    from skyfold.plans.marts import daily_summary

    fact = spark.createDataFrame(
        [(dt.datetime(2026, 3, 8, 20, 0), "a", "India", True, "Domestic", 100.0, 1000.0)],
        "ingested_at timestamp_ntz, icao24 string, origin_country string, on_ground boolean, "
        "flight_type string, speed_kmh double, altitude_feet double")
    # the same moment as an instant: 2026-03-08 20:00 UTC, already 9 March in Kolkata
    ltz = fact.withColumn("ingested_at", F.timestamp_seconds(F.lit(1773000000)))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        days = {daily_summary(df).first().flight_date for df in (fact, ltz)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert days == {dt.date(2026, 3, 8)}


def test_average_skips_what_is_no_number(spark):
    from skyfold.functions.aggregates import avg_2dp
    df = spark.sql("SELECT CAST(x AS double) x FROM VALUES ('NaN'), ('Infinity'), ('1.00'), ('2.01'), (NULL) t(x)")
    assert df.agg(avg_2dp("x")).first()[0] == 1.51
