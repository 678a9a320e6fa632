"""Aircraft-shaped rows derived from the ``events`` table.

The driver tables hold no aircraft data, so every snapshot query reads
``events`` and derives state vectors from it row by row (no row is dropped or
sampled); the work grows with the table. Nulls, blank call signs and the
boundary values of the labelling rules come from fixed residues of
``event_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.functions.scalar import utc_date_of_epoch
from skyfold.operators.dedup import dedup_by
from skyfold.plans.preset import clean
from skyfold.schema import HISTORY_KEYS, STATE_SLOTS

# The day split of the two-batch upsert checks: batch A ends on the first
# date, batch B starts on the second; days in between are in both.
BATCH_A_LAST_DAY = "2024-01-20"
BATCH_B_FIRST_DAY = "2024-01-11"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(modulus: int, value: str) -> str:
    return f"CASE WHEN event_id % {modulus} = 0 THEN NULL ELSE {value} END"


SNAPSHOT_TIME = "(unix_timestamp(ts) - pmod(unix_timestamp(ts), 3600))"

# One SQL expression per output column, in output order.
FIXTURE_COLUMNS = (
    (f"{SNAPSHOT_TIME}", "snapshot_time"),
    (_null_when(47, "concat('u', lpad(CAST(user_id AS STRING), 5, '0'))"), "icao24"),
    ("CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '   ' "
     "ELSE concat(' cal', CAST(user_id AS STRING), '  ') END", "callsign"),
    ("CASE WHEN event_id % 43 = 0 THEN NULL WHEN user_id % 25 = 0 THEN 'India' "
     "ELSE concat('NATION_', CAST(user_id % 25 AS STRING)) END", "origin_country"),
    (f"CAST({SNAPSHOT_TIME} + event_id % 60 AS DOUBLE)", "time_position"),
    (f"CAST({SNAPSHOT_TIME} + event_id % 120 AS DOUBLE)", "last_contact"),
    (_null_when(23, "CAST(660 + (event_id % 41) * 8 AS DOUBLE) / 10"), "longitude"),
    (_null_when(19, "CAST(60 + (event_id % 40) * 8 AS DOUBLE) / 10"), "latitude"),
    (_null_when(13, "value * 25"), "baro_altitude"),
    (_null_when(29, "event_type = 'signup'"), "on_ground"),
    (_null_when(17, "value"), "velocity"),
    (_null_when(31, "CAST(event_id % 360 AS DOUBLE)"), "true_track"),
    (_null_when(5, "(value - 250) / 20"), "vertical_rate"),
    (_null_when(37, "value * 25 + 120"), "geo_altitude"),
    ("lpad(CAST(event_id % 7777 AS STRING), 4, '0')", "squawk"),
    ("CAST(event_id % 20 AS INT)", "category"),
    ("ts", "ingested_at"),
    ("event_id", "event_id"),
)


def flight_fixture(events: DataFrame) -> DataFrame:
    """Mapped-row shape (``snapshot_time`` + 15 slots) plus ``ingested_at`` and
    ``event_id``; one output row per event."""
    return events.selectExpr(*[f"{sql} AS {name}" for sql, name in FIXTURE_COLUMNS])


def state_vector(df: DataFrame) -> list[Column]:
    """Columns of a mapped row back in slot order; unmapped slots are null."""
    by_pos = {pos: name for pos, name, _ in STATE_SLOTS}
    width = max(by_pos) + 1
    return [F.col(by_pos[i]) if i in by_pos else F.lit(None).cast("string") for i in range(width)]


def fixture_history(events: DataFrame) -> DataFrame:
    """History rows of the fixture (``ingested_at`` = event time), plus ``event_id``."""
    return clean(flight_fixture(events), F.col("ingested_at"), carry=("event_id",))


def keyed_history(events: DataFrame) -> DataFrame:
    """One row per ``(snapshot_time, icao24)``: the smallest ``event_id`` wins."""
    return dedup_by(fixture_history(events), HISTORY_KEYS, "event_id")


def snapshot_date() -> Column:
    return utc_date_of_epoch("snapshot_time")


def batch_a(keyed: DataFrame) -> DataFrame:
    return keyed.filter(snapshot_date() <= F.lit(BATCH_A_LAST_DAY).cast("date"))


def batch_b(keyed: DataFrame) -> DataFrame:
    """A later, re-processed batch: overlaps A on some days and changes values."""
    return (keyed.filter(snapshot_date() >= F.lit(BATCH_B_FIRST_DAY).cast("date"))
            .withColumns({
                "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"),
                "time_position": F.col("time_position") + F.lit(0.5),
                "last_contact": F.col("last_contact") + F.lit(0.5),
                "speed_kmh": F.col("speed_kmh") + F.lit(1.0),
            }))
