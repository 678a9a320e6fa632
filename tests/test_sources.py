"""Snapshot documents: reference-style files, landing and reading."""

import json
import os

import pytest
from pyspark.sql import functions as F

from skyfold.operators import explode_states, map_slots
from skyfold.plans.preset import snapshot_rows
from skyfold.sources import land_snapshots, non_empty, one_copy, pack_snapshots, read_snapshots, select_day

# An invented vector: 17 mixed JSON values.
SAMPLE = ["4b1c2d", "XYZ42   ", "Norway", 1772138460, 1772138461, 77.125, 21.5, 9144.0,
          False, 201.5, 145.25, 0, None, 9450.5, "2107", False, 0]


def _write_docs(folder, docs):
    os.makedirs(folder, exist_ok=True)
    for i, doc in enumerate(docs):
        with open(os.path.join(folder, f"flights_{i:02d}.json"), "w") as fh:
            json.dump(doc, fh, indent=2)  # one pretty-printed document per file


def test_reference_style_files(spark, tmp_dir):
    day = os.path.join(tmp_dir, "raw", "ingest_date=2026-03-08")
    short = SAMPLE[:16]                       # no category slot
    bad = list(SAMPLE)
    bad[0], bad[5] = "abcdef", "abc"          # text in a numeric slot
    _write_docs(day, [
        {"time": 1772138472, "states": [SAMPLE, short, bad]},
        {"time": 1772138472, "states": [SAMPLE, short, bad]},   # re-fetched copy
        {"time": 1772138482, "states": None},
        {"time": 1772138492, "states": []},
    ])
    docs = read_snapshots(spark, os.path.join(tmp_dir, "raw"), multi_line=True, day="2026-03-08")
    assert docs.count() == 4
    kept = one_copy(docs.drop("ingest_date"))
    mapped = map_slots(explode_states(kept)).collect()
    assert len(mapped) == 3
    full = [r for r in mapped if r.icao24 == "4b1c2d" and r.category is not None][0]
    assert (full.snapshot_time, full.longitude, full.latitude, full.on_ground) == (1772138472, 77.125, 21.5, False)
    assert (full.time_position, full.vertical_rate, full.squawk, full.category) == (1772138460.0, 0.0, "2107", 0)
    assert [r.category for r in mapped if r.icao24 == "4b1c2d" and r.category is None] == [None]
    assert [r.longitude for r in mapped if r.icao24 == "abcdef"] == [None]
    rows = snapshot_rows(kept, F.lit(None).cast("timestamp_ntz")).collect()
    sample = [r for r in rows if r.icao24 == "4b1c2d" and r.flight_category == "No Info"][0]
    assert (sample.callsign, sample.altitude_feet, sample.geo_altitude_feet) == ("XYZ42", 29995.98, 31001.42)
    assert {r.flight_category for r in rows if r.icao24 == "4b1c2d"} == {"No Info", "Unknown"}


def test_non_empty_guard(spark):
    docs = spark.createDataFrame([(1, None, None), (2, None, []), (3, None, [["a"]])],
                                 "time bigint, part int, states array<array<string>>")
    assert [r.time for r in non_empty(docs).collect()] == [3]


def test_pack_splits_large_snapshots(spark, tmp_dir):
    rows = spark.range(0, 2500).select(
        (F.col("id") % 2 * 3600).alias("t"), F.col("id").alias("rid"),
        F.concat(F.lit("a"), F.col("id").cast("string")).alias("icao"))
    docs = pack_snapshots(rows, "t", [F.col("icao"), F.col("rid")], spread="rid", max_per_doc=300)
    sizes = docs.select("time", "part", F.size("states").alias("n")).collect()
    assert sum(r.n for r in sizes) == 2500
    assert {r.time for r in sizes} == {0, 3600}
    assert len(sizes) >= 2 * 5 and max(r.n for r in sizes) < 600
    path = os.path.join(tmp_dir, "landing")
    assert land_snapshots(docs, path, "Asia/Kolkata") == len(sizes)
    back = read_snapshots(spark, path)
    assert sorted(back.select("ingest_date").distinct().collect()) == [(__import__("datetime").date(1970, 1, 1),)]
    assert explode_states(back).count() == 2500


def test_day_selection_prunes_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "landing")
    docs = spark.createDataFrame([(1772998200, 0, [["a"]]), (1773000000, 0, [["b"]])],
                                 "time bigint, part int, states array<array<string>>")
    land_snapshots(docs, path, "Asia/Kolkata")   # 2026-03-08 19:30 UTC and 20:00 UTC
    days = sorted(str(r.ingest_date) for r in read_snapshots(spark, path).collect())
    assert days == ["2026-03-09", "2026-03-09"]
    picked = read_snapshots(spark, path, day="2026-03-09")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ingest_date" in plan
    assert select_day(read_snapshots(spark, path), "2026-03-08").count() == 0


def test_dated_folder_layout(spark, tmp_dir):
    _write_docs(os.path.join(tmp_dir, "raw", "2026-03-08"), [{"time": 1772938472, "states": [SAMPLE]}])
    _write_docs(os.path.join(tmp_dir, "raw", "2026-03-09"), [{"time": 1773038472, "states": [SAMPLE, SAMPLE]}])
    docs = read_snapshots(spark, os.path.join(tmp_dir, "raw"), multi_line=True, day="2026-03-09",
                          dated_folders=True)
    rows = docs.collect()
    assert [(r.time, len(r.states), str(r.ingest_date)) for r in rows] == [(1773038472, 2, "2026-03-09")]


def test_pack_keeps_rows_without_time(spark):
    rows = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (3600, 3, "c")], "t bigint, rid bigint, v string")
    docs = pack_snapshots(rows, "t", [F.col("v")], spread="rid").collect()
    assert sorted((d.time is None, len(d.states)) for d in docs) == [(False, 1), (True, 2)]


def test_snapshot_day_independent_of_session_zone(spark):
    from skyfold.sources import snapshot_day

    df = spark.createDataFrame([(1772998200,), (1773000000,), (1772937000,)], "t bigint")
    expect = ["2026-03-09", "2026-03-09", "2026-03-08"]   # 19:30 and 20:00 UTC; 02:30 UTC
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert [str(r.d) for r in df.select(snapshot_day("t", "Asia/Kolkata").alias("d")).collect()] == expect
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_whole_copies_win(spark, tmp_dir):
    """Copies of one snapshot with different numbers of parts are never mixed."""
    def copy(n, mark):
        return spark.range(n).select(
            F.lit(7200).alias("t"), F.col("id").alias("rid"), F.concat(F.lit(mark), F.col("id").cast("string")).alias("icao"))

    for sizes in ((25, 18), (18, 35), (35, 18, 25)):
        path = os.path.join(tmp_dir, "_".join(map(str, sizes)))
        for i, n in enumerate(sizes):
            docs = pack_snapshots(copy(n, "abc"[i]), "t", [F.col("icao")], spread="rid", max_per_doc=10)
            land_snapshots(docs, path, "UTC")
        got = [r[0][0] for r in one_copy(read_snapshots(spark, path)).select(F.explode("states")).collect()]
        assert sorted(got) == sorted(f"a{i}" for i in range(sizes[0]))


def test_foreign_document_beside_a_landed_one(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    docs = spark.createDataFrame([(0, 0, [["landed"]])], "time bigint, part int, states array<array<string>>")
    land_snapshots(docs, path, "UTC")
    with open(os.path.join(path, "ingest_date=1970-01-01", "foreign.json"), "w") as fh:
        fh.write(json.dumps({"time": 0, "states": [["foreign"]]}) + "\n")
    kept = one_copy(read_snapshots(spark, path)).collect()
    assert [r.states for r in kept] == [[["landed"]]]


def test_broken_documents_fail_the_read(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.json"), "w") as fh:
        fh.write(json.dumps({"time": 1, "states": [["x"]]}) + "\n{\"time\": 2, \"sta\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        read_snapshots(spark, tmp_dir).collect()


def test_wrong_mode_fails_the_read(spark, tmp_dir):
    """A file of one document per line read as one document, and the other way round."""
    lines, pretty = os.path.join(tmp_dir, "lines"), os.path.join(tmp_dir, "pretty")
    _write_docs(pretty, [{"time": 1, "states": [["x", None, 2.5, True]]}])
    os.makedirs(lines)
    with open(os.path.join(lines, "a.json"), "w") as fh:
        fh.write("\n".join(json.dumps({"time": t, "states": [["{x}"]]}) for t in (1, 2)) + "\n")
    assert [r.states for r in read_snapshots(spark, pretty, multi_line=True).collect()] == [[["x", None, "2.5", "true"]]]
    assert read_snapshots(spark, lines).count() == 2
    with pytest.raises(Exception, match="several documents"):
        read_snapshots(spark, lines, multi_line=True).collect()
    with open(os.path.join(pretty, "broken.json"), "w") as fh:
        fh.write('{"time": 2,\n "sta')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        read_snapshots(spark, pretty, multi_line=True).collect()


def test_braces_within_text_are_no_second_document(spark, tmp_dir):
    odd = "x} {\"y\\\\"
    _write_docs(tmp_dir, [{"time": 1, "states": [[odd, None, 2.5, True]]}])
    assert [r.states for r in read_snapshots(spark, tmp_dir, multi_line=True).collect()] == [[[odd, None, "2.5", "true"]]]


def test_vectors_as_variants(spark, tmp_dir):
    """Types as the document has them; text of a number, a number of a kind too wide, nulls and short vectors."""
    full = ["a1", " C1 ", "Norway", 1772138460, 1772138461.5, 77.125, 21, 9144.0, False, None, "145.25", 0, None, 9450.5, "2107", False, 5.0]
    short, mixed = ["b2", None, 7], ["c3", True, "x", "no", 1e300, {"a": 1}, [1], "3", "true", 1, 2, 3, 4, 5, 6, 7, "5.0"]
    _write_docs(tmp_dir, [{"time": 1, "states": [full, short, mixed]}])
    for multi_line in (True,):
        docs = read_snapshots(spark, tmp_dir, multi_line=multi_line, variant=True)
        rows = {r.icao24: r for r in map_slots(explode_states(one_copy(docs))).collect()}
        a, b, c = (rows[k] for k in ("a1", "b2", "c3"))
        assert (a.callsign, a.time_position, a.last_contact, a.latitude, a.on_ground, a.velocity, a.true_track, a.squawk, a.category) == (
            " C1 ", 1772138460.0, 1772138461.5, 21.0, False, None, 145.25, "2107", 5)
        assert (b.callsign, b.origin_country, b.category) == (None, "7", None)
        assert (c.time_position, c.last_contact, c.longitude, c.latitude, c.baro_altitude, c.category) == (None, 1e300, None, None, 3.0, 5)
        assert c.on_ground is True
