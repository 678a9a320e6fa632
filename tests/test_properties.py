"""Properties: label counts add up, and both merge plans agree with a plain
Python model of MERGE on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyfold.operators import upsert
from skyfold.plans.fixture import fixture_history
from skyfold.plans.marts import dim_countries, fact_flights
from skyfold.plans.preset import speed_category
from tests_support import events_small


def test_label_counts_add_up(spark):
    hist = fixture_history(events_small(spark)).withColumn("speed_category", speed_category())
    n = hist.count()
    for col in ("flight_phase", "flight_category", "speed_category"):
        counts = hist.groupBy(col).count().collect()
        assert sum(r["count"] for r in counts) == n and all(r[col] is not None for r in counts)
    g = hist.agg(F.count_if(F.col("on_ground") == F.lit(True)).alias("on"),
                 F.count_if(F.col("on_ground") == F.lit(False)).alias("off"),
                 F.count_if(F.col("on_ground").isNull()).alias("unknown")).first()
    assert g.on + g.off + g.unknown == n and g.unknown > 0
    # The mart leaves out rows without a country, and there are some.
    known = hist.filter("origin_country IS NOT NULL").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("on_ground") == F.lit(True)).alias("on"),
        F.count_if(F.col("on_ground") == F.lit(False)).alias("off")).first()
    assert 0 < known.n < n
    mart = dim_countries(hist).agg(F.sum("total_flights"), F.sum("flights_airborne"),
                                   F.sum("flights_on_ground")).first()
    assert (mart[0], mart[1], mart[2]) == (known.n, known.off, known.on)
    types = fact_flights(hist).groupBy("flight_type").count().collect()
    assert sum(r["count"] for r in types) == n


DDL = "k1 int, k2 string, a string, b double, keep double"
key1 = st.one_of(st.none(), st.integers(0, 5))
key2 = st.sampled_from([None, "x", "y"])
val = st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False).map(lambda v: round(v, 2)))
row = st.tuples(key1, key2, st.sampled_from(["p", "q", None]), val, val)


def _model(target, source):
    """MERGE: matched -> a, b from source (keep stays); unmatched source
    inserted; null keys never match."""
    keyed = {}
    for r in source:
        if r[0] is not None and r[1] is not None:
            keyed[(r[0], r[1])] = r
    out, matched = [], set()
    for t in target:
        k = (t[0], t[1])
        if t[0] is not None and t[1] is not None and k in keyed:
            s = keyed[k]
            out.append((t[0], t[1], s[2], s[3], t[4]))
            matched.add(k)
        else:
            out.append(t)
    for s in source:
        if s[0] is None or s[1] is None or (s[0], s[1]) not in matched:
            out.append(s)
    return out


def _sorted(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def _unique_source(rows):
    seen, out = set(), []
    for r in rows:
        k = (r[0], r[1])
        if r[0] is not None and r[1] is not None:
            if k in seen:
                continue
            seen.add(k)
        out.append(r)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=12), st.lists(row, max_size=12))
def test_merge_plans_match_model(spark, target_rows, source_rows):
    source_rows = _unique_source(source_rows)
    target = spark.createDataFrame(target_rows, DDL)
    source = spark.createDataFrame(source_rows, DDL)
    expected = _sorted(_model(target_rows, source_rows))
    for kw in ({}, {"broadcast_max_rows": 1000}):
        got = _sorted(tuple(r) for r in upsert(target, source, ["k1", "k2"], ["a", "b"], **kw).collect())
        assert got == expected, kw
