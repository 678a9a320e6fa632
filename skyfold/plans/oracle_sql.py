"""DuckDB SQL that computes, from the same Parquet tables, what each
registered query must return. Used by the driver's correctness check and by
the tests; nothing here runs on Spark.

Rounding: Spark rounds the decimal text of a double, so the SQL rounds
``CAST(CAST(x AS VARCHAR) AS DECIMAL(38,20))``. Averages of two-decimal values
are exact (whole cents), as in ``skyfold.functions.aggregates.avg_2dp``.
"""

from __future__ import annotations

from skyfold.plans.fixture import BATCH_A_LAST_DAY, BATCH_B_FIRST_DAY
from skyfold.schema import (
    DAILY_MEASURES, FACT_COLUMNS, HISTORY_COLUMNS, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS,
    MAPPED_COLUMNS,
)

from skyfold.plans.queries import PROCESSING_TIME, RETENTION_AS_OF, SELECTED_DAY  # noqa: E402

# Labels, factors, bounds and the local zone (+05:30) are written out here, not
# taken from the code under test: a wrong constant there must not pass.
LOCAL_DAY = "CAST(ts + INTERVAL 330 MINUTE AS DATE)"
SNAPSHOT_DAY = "(DATE '1970-01-01' + CAST(floor(snapshot_time / 86400) AS INTEGER))"


def r2(x: str) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE)"


def avg2(x: str) -> str:
    """Exact ``ROUND(AVG(x), 2)`` for two-decimal values: whole cents summed,
    quotient rounded half away from zero."""
    cents = f"CAST(round(({x}) * 100) AS HUGEINT)"
    s, n = f"sum({cents})", f"count({cents})"
    return (f"CASE WHEN {n} > 0 THEN CAST(sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})) AS DOUBLE)"
            " / 100 END")


SNAP = "CAST(epoch(date_trunc('hour', ts)) AS BIGINT)"

FX = f"""fx AS (
  SELECT {SNAP} AS snapshot_time,
    CASE WHEN event_id % 47 = 0 THEN NULL ELSE 'u' || lpad(CAST(user_id AS VARCHAR), 5, '0') END AS icao24,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '   '
         ELSE ' cal' || CAST(user_id AS VARCHAR) || '  ' END AS callsign,
    CASE WHEN event_id % 43 = 0 THEN NULL WHEN user_id % 25 = 0 THEN 'India'
         ELSE 'NATION_' || CAST(user_id % 25 AS VARCHAR) END AS origin_country,
    CAST({SNAP} + event_id % 60 AS DOUBLE) AS time_position,
    CAST({SNAP} + event_id % 120 AS DOUBLE) AS last_contact,
    CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(660 + (event_id % 41) * 8 AS DOUBLE) / 10 END AS longitude,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(60 + (event_id % 40) * 8 AS DOUBLE) / 10 END AS latitude,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE value * 25 END AS baro_altitude,
    CASE WHEN event_id % 29 = 0 THEN NULL ELSE event_type = 'signup' END AS on_ground,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS velocity,
    CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 360 AS DOUBLE) END AS true_track,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE (value - 250) / 20 END AS vertical_rate,
    CASE WHEN event_id % 37 = 0 THEN NULL ELSE value * 25 + 120 END AS geo_altitude,
    lpad(CAST(event_id % 7777 AS VARCHAR), 4, '0') AS squawk,
    CAST(event_id % 20 AS INTEGER) AS category,
    ts AS ingested_at,
    event_id
  FROM events)"""

# Fixed values.
CATEGORY_CASE = """CASE category
    WHEN 0 THEN 'No Info' WHEN 1 THEN 'No ADS-B Emitter' WHEN 2 THEN 'Light Aircraft'
    WHEN 3 THEN 'Small Aircraft' WHEN 4 THEN 'Large Aircraft' WHEN 5 THEN 'High Vortex Large Aircraft'
    WHEN 6 THEN 'Heavy Aircraft' WHEN 7 THEN 'High Performance Aircraft' WHEN 8 THEN 'Rotorcraft'
    WHEN 9 THEN 'Glider' WHEN 10 THEN 'lighter Than Air' WHEN 11 THEN 'Parachutist'
    WHEN 12 THEN 'Ultralight' WHEN 15 THEN 'UAV' WHEN 16 THEN 'Surface Vehicle - Emergency'
    WHEN 17 THEN 'Surface Vehicle - Service' ELSE 'Unknown' END"""

PHASE_CASE = """CASE WHEN on_ground = TRUE THEN 'On Ground'
    WHEN baro_altitude < 1000 THEN 'Takeoff / Landing'
    WHEN baro_altitude BETWEEN 1000 AND 6000 THEN 'Climbing / Descending'
    ELSE 'Cruising' END"""

SPEED_CASE = """CASE WHEN speed_kmh IS NULL THEN 'Unknown'
    WHEN speed_kmh < 300 THEN 'Slow (<300 km/h)'
    WHEN speed_kmh < 600 THEN 'Medium (300-600 km/h)'
    WHEN speed_kmh < 900 THEN 'Fast (600-900 km/h)'
    ELSE 'Very Fast (>900 km/h)' END"""

TYPE_CASE = "CASE WHEN origin_country = 'India' THEN 'Domestic' ELSE 'International' END"

REQUIRED = ("icao24 IS NOT NULL AND callsign IS NOT NULL AND latitude IS NOT NULL"
            " AND longitude IS NOT NULL")


def history_cte(name: str, source: str, ingested: str = "ingested_at",
                carry: str = ", event_id") -> str:
    return f"""{name} AS (
  SELECT snapshot_time, icao24, upper(trim(callsign)) AS callsign, origin_country,
    time_position, last_contact, longitude, latitude, on_ground,
    true_track AS heading_degrees, squawk,
    {r2(f'baro_altitude * CAST(3.2804 AS DOUBLE)')} AS altitude_feet,
    {r2(f'geo_altitude * CAST(3.2804 AS DOUBLE)')} AS geo_altitude_feet,
    {r2(f'velocity * CAST(3.6 AS DOUBLE)')} AS speed_kmh,
    {r2(f'vertical_rate * CAST(196.85 AS DOUBLE)')} AS vertical_rate_ftpm,
    {ingested} AS ingested_at,
    {CATEGORY_CASE} AS flight_category,
    {PHASE_CASE} AS flight_phase{carry}
  FROM {source} WHERE {REQUIRED})"""


HX = history_cte("hx", "fx")
BASE = f"WITH {FX},\n{HX}"

KEYED = """kx AS (
  SELECT * EXCLUDE (rn, event_id) FROM (
    SELECT *, row_number() OVER (PARTITION BY snapshot_time, icao24 ORDER BY event_id) AS rn
    FROM hx) WHERE rn = 1)"""

BATCHES = f"""{KEYED},
ta AS (SELECT * FROM kx WHERE {SNAPSHOT_DAY} <= DATE '{BATCH_A_LAST_DAY}'),
tb AS (SELECT * REPLACE (ingested_at + INTERVAL 1 HOUR AS ingested_at,
                         time_position + 0.5 AS time_position,
                         last_contact + 0.5 AS last_contact,
                         speed_kmh + 1.0 AS speed_kmh)
       FROM kx WHERE {SNAPSHOT_DAY} >= DATE '{BATCH_B_FIRST_DAY}')"""


def merge_select(columns, keys, update, target="t", source="s") -> str:
    present_s = " AND ".join(f"{source}.{k} IS NOT NULL" for k in keys)
    present_t = " AND ".join(f"{target}.{k} IS NOT NULL" for k in keys)
    out = []
    for c in columns:
        if c in keys or c in update:
            out.append(f"CASE WHEN {present_s} THEN {source}.{c} ELSE {target}.{c} END AS {c}")
        else:
            out.append(f"CASE WHEN {present_t} THEN {target}.{c} ELSE {source}.{c} END AS {c}")
    return ",\n  ".join(out)


def fact_select(source: str) -> str:
    base = [c for c in FACT_COLUMNS if c not in ("flight_type", "speed_category")]
    return (f"SELECT {', '.join(base)}, {TYPE_CASE} AS flight_type, "
            f"{SPEED_CASE} AS speed_category FROM {source}")


def daily_select(fact: str) -> str:
    return f"""SELECT CAST(ingested_at AS DATE) AS flight_date,
    COUNT(*) AS total_flights,
    COUNT(DISTINCT icao24) AS unique_aircraft,
    COUNT(DISTINCT origin_country) AS countries_represented,
    COUNT(*) FILTER (WHERE on_ground = FALSE) AS flights_airborne,
    COUNT(*) FILTER (WHERE on_ground = TRUE) AS flights_on_ground,
    COUNT(*) FILTER (WHERE flight_type = 'Domestic') AS domestic_flights,
    COUNT(*) FILTER (WHERE flight_type = 'International') AS international_flights,
    {avg2('speed_kmh')} AS avg_speed_kmh,
    {avg2('altitude_feet')} AS avg_altitude_feet
  FROM ({fact}) f WHERE ingested_at IS NOT NULL GROUP BY 1"""


COUNTRY_MART = f"""SELECT origin_country,
    COUNT(DISTINCT icao24) AS unique_aircraft,
    COUNT(*) AS total_flights,
    {avg2('speed_kmh')} AS avg_speed_kmh,
    {avg2('altitude_feet')} AS avg_altitude_feet,
    COUNT(*) FILTER (WHERE on_ground = FALSE) AS flights_airborne,
    COUNT(*) FILTER (WHERE on_ground = TRUE) AS flights_on_ground
  FROM hx WHERE origin_country IS NOT NULL
  GROUP BY origin_country ORDER BY total_flights DESC, origin_country"""

PHASE_MART = f"""SELECT flight_phase, flight_category,
    COUNT(*) AS total_flights,
    {avg2('speed_kmh')} AS avg_speed_kmh,
    {avg2('altitude_feet')} AS avg_altitude_feet,
    {avg2('vertical_rate_ftpm')} AS avg_vertical_rate_ftpm
  FROM hx WHERE flight_phase IS NOT NULL
  GROUP BY flight_phase, flight_category
  ORDER BY total_flights DESC, flight_phase, flight_category"""

MAPPED = ", ".join(MAPPED_COLUMNS)
EVENTS_BY_DAY = f"SELECT *, {LOCAL_DAY} AS d FROM events"


def _distribution(col: str, limit: str = "") -> str:
    return (f'{BASE}\nSELECT {col}, COUNT(*) AS "count" FROM hx GROUP BY {col} '
            f'ORDER BY "count" DESC, {col}{limit}')


def _upsert_history() -> str:
    return (f"{BASE},\n{BATCHES}\nSELECT\n  "
            f"{merge_select(HISTORY_COLUMNS, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS)}\n"
            "FROM ta t FULL OUTER JOIN tb s\n"
            "  ON t.snapshot_time = s.snapshot_time AND t.icao24 = s.icao24")


def _moved_marts(mart: str) -> str:
    """A dimension over both batches merged, the second with a quarter of its hours moved."""
    moved = BATCHES.replace("SELECT * REPLACE (", "SELECT * REPLACE (CASE WHEN (snapshot_time // 3600) % 4 = 0 THEN 'MOVED' "
                                                  "ELSE origin_country END AS origin_country, ")
    merged = (f"SELECT {merge_select(HISTORY_COLUMNS, HISTORY_KEYS, HISTORY_UPDATE_COLUMNS)} FROM ta t "
              "FULL OUTER JOIN tb s ON t.snapshot_time = s.snapshot_time AND t.icao24 = s.icao24")
    return f"{BASE},\n{moved},\nmx AS ({merged})\n{mart.replace('FROM hx', 'FROM mx')}"


def _report() -> str:
    nulls = "\n".join(f"UNION ALL SELECT 'nulls', '{c}', COUNT(*) - COUNT({c}) FROM hx" for c in HISTORY_COLUMNS)
    parts = "\n".join(f"UNION ALL SELECT '{part}', {c}, COUNT(*) FROM hx GROUP BY 2" for part, c in (
        ("phase_distribution", "flight_phase"), ("category_distribution", "flight_category")))
    top = ("SELECT origin_country, COUNT(*) AS n FROM hx GROUP BY 1 "
           "ORDER BY n DESC, origin_country NULLS LAST LIMIT 10")
    return (f"{BASE},\ntop AS ({top})\nSELECT 'rows' AS part, NULL::VARCHAR AS value, COUNT(*) AS n FROM hx\n{nulls}\n{parts}\n"
            "UNION ALL SELECT 'top10_countries', origin_country, n FROM top")


def _upsert_daily() -> str:
    cols = ["flight_date", *DAILY_MEASURES]
    return (f"{BASE},\n{BATCHES},\n"
            f"da AS ({daily_select(fact_select('ta'))}),\n"
            f"db AS ({daily_select(fact_select('tb'))})\n"
            f"SELECT\n  {merge_select(cols, ['flight_date'], DAILY_MEASURES)}\n"
            "FROM da t FULL OUTER JOIN db s ON t.flight_date = s.flight_date")


def _incremental() -> str:
    keyed_fx = """kf AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY snapshot_time, icao24 ORDER BY event_id) AS rn
    FROM fx) WHERE rn = 1)"""
    hist = history_cte("hk", "kf", f"TIMESTAMP '{PROCESSING_TIME}'", carry="")
    return f"WITH {FX},\n{keyed_fx},\n{hist}\nSELECT * FROM hk"


def _one_day() -> str:
    hist = history_cte("hp", "fx", f"TIMESTAMP '{PROCESSING_TIME}'", carry="")
    local_day = "(DATE '1970-01-01' + CAST(floor((snapshot_time + 19800) / 86400) AS INTEGER))"
    return f"WITH {FX},\n{hist}\nSELECT * FROM hp WHERE {local_day} = DATE '{SELECTED_DAY}'"


def _null_profile() -> str:
    cols = ",\n  ".join(f"COUNT(*) - COUNT({c}) AS {c}" for c in HISTORY_COLUMNS)
    return f"{BASE}\nSELECT\n  {cols}\nFROM hx"


def _mart_registry() -> str:
    return f"""{BASE}
SELECT 'fct_flights' AS mart, COUNT(*) AS row_count FROM hx
UNION ALL SELECT 'dim_countries', COUNT(*) FROM
  (SELECT DISTINCT origin_country FROM hx WHERE origin_country IS NOT NULL)
UNION ALL SELECT 'dim_flight_phases', COUNT(*) FROM
  (SELECT DISTINCT flight_phase, flight_category FROM hx WHERE flight_phase IS NOT NULL)
UNION ALL SELECT 'agg_flights_daily', COUNT(*) FROM
  (SELECT DISTINCT CAST(ingested_at AS DATE) FROM hx WHERE ingested_at IS NOT NULL)"""


ORACLES: dict[str, str] = {
    "flagship_country_mart": f"{BASE}\n{COUNTRY_MART}",
    "snapshot_json_roundtrip": f"WITH {FX}\nSELECT {MAPPED} FROM fx",
    "snapshot_variant_roundtrip": f"WITH {FX}\nSELECT {MAPPED} FROM fx",
    "date_partition_select": (
        "SELECT event_id, ts, user_id, event_type, value, d AS ingest_date FROM "
        f"({EVENTS_BY_DAY}) WHERE d = DATE '{SELECTED_DAY}'"),
    "parquet_day_overwrite": (
        "SELECT event_id, ts, user_id, event_type, "
        f"CASE WHEN d = DATE '{SELECTED_DAY}' THEN value * 2.0 ELSE value END AS value, "
        f"d AS ingest_date FROM ({EVENTS_BY_DAY})"),
    "table_first_run_then_upsert": _upsert_history(),
    "table_merge_by_shuffle": _upsert_history(),
    "retention_90d": (
        "SELECT * FROM orders WHERE o_orderdate >= "
        f"CAST(DATE '{RETENTION_AS_OF}' - INTERVAL 90 DAY AS TIMESTAMP)"),
    "required_columns_filter": f"WITH {FX}\nSELECT * FROM fx WHERE {REQUIRED}",
    "bbox_filter": (
        f"WITH {FX}\nSELECT * FROM fx WHERE latitude BETWEEN 6.0 AND 37.0 "
        "AND longitude BETWEEN 68.0 AND 97.0"),
    "clean_units": f"{BASE}\nSELECT * FROM hx",
    "processing_time_default": (
        f"WITH {FX}\nSELECT event_id, TRUE AS stamped, TRUE AS one_time, TRUE AS after_event FROM fx WHERE {REQUIRED}"),
    "category_label": f"WITH {FX}\nSELECT event_id, category, {CATEGORY_CASE} AS flight_category FROM fx",
    "flight_phase": (
        f"WITH {FX}\nSELECT event_id, on_ground, baro_altitude, {PHASE_CASE} AS flight_phase FROM fx"),
    "flight_type": f"WITH {FX}\nSELECT event_id, origin_country, {TYPE_CASE} AS flight_type FROM fx",
    "speed_band": f"{BASE}\nSELECT event_id, speed_kmh, {SPEED_CASE} AS speed_category FROM hx",
    "fact_projection": f"{BASE}\n{fact_select('hx')}",
    "snapshot_dedup": f"WITH {FX}\nSELECT {MAPPED} FROM fx",
    "landed_vectors": (
        f"WITH {FX}\nSELECT CASE WHEN event_id % 53 = 0 THEN NULL ELSE snapshot_time END AS time, "
        "COUNT(*) AS vectors FROM fx GROUP BY 1"),
    "key_dedup": (
        f"{BASE}\nSELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
        "(PARTITION BY snapshot_time, icao24 ORDER BY event_id) AS rn FROM hx) WHERE rn = 1"),
    "upsert_composite_key": _upsert_history(),
    "upsert_small_source": _upsert_history(),
    "table_by_name_first_run_then_upsert": _upsert_history(),
    "bucketed_merge": _upsert_history(),
    "replace_by_name": (
        f"{BASE}\nSELECT origin_country, COUNT(DISTINCT icao24) AS unique_aircraft FROM hx GROUP BY 1"),
    "expire_by_name": (
        f"SELECT event_id, ts, user_id, event_type, value, d AS ingest_date FROM ({EVENTS_BY_DAY}) "
        "WHERE d >= DATE '2024-02-01' - 20"),
    "upsert_daily": _upsert_daily(),
    "row_count": "SELECT COUNT(*) AS row_count FROM lineitem",
    "null_profile": _null_profile(),
    "phase_distribution": _distribution("flight_phase"),
    "category_distribution": _distribution("flight_category"),
    "top10_countries": _distribution("origin_country", " LIMIT 10"),
    "filter_loss": (
        f"WITH {FX}\nSELECT COUNT(*) AS rows_before, "
        f"COUNT(*) FILTER (WHERE {REQUIRED}) AS rows_after, "
        f"COUNT(*) - COUNT(*) FILTER (WHERE {REQUIRED}) AS rows_lost FROM fx"),
    "phase_mart": f"{BASE}\n{PHASE_MART}",
    "daily_mart": f"{BASE}\n{daily_select(fact_select('hx'))}",
    "mart_registry": _mart_registry(),
    "end_to_end_country_mart": f"{BASE}\n{COUNTRY_MART}",
    "fact_from_touched_partitions": fact_select(f"({_upsert_history()})"),
    "country_mart_from_touched_partitions": _moved_marts(COUNTRY_MART),
    "phase_mart_from_touched_partitions": _moved_marts(PHASE_MART),
    "quality_report_one_scan": _report(),
    "boxed_incremental": (_incremental() + " WHERE latitude BETWEEN 10.0 AND 30.0 AND longitude BETWEEN 70.0 AND 90.0"),
    "process_one_day": _one_day(),
    "incremental_accumulate": _incremental(),
}
