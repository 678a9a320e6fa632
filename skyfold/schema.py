"""Schemas of the snapshot data model.

A raw snapshot is one JSON document ``{time, states}``; ``states`` is a list of
positional vectors of mixed JSON types. Spark reads such a vector as
``array<string>``: numbers and booleans keep their JSON text, ``null`` stays
null. The read schema is explicit so no inference pass runs over the files.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ``part`` is optional: a document that is a whole snapshot has none (read as
# null). Our own landing splits a very large snapshot into numbered parts so
# that no single document, and so no single task, holds an unbounded list.
# ``copy`` names the landing run: the parts of one copy of a snapshot share it.
RAW_SCHEMA = T.StructType([
    T.StructField("time", T.LongType(), True),
    T.StructField("part", T.IntegerType(), True),
    T.StructField("copy", T.StringType(), True),
    T.StructField("states", T.ArrayType(T.ArrayType(T.StringType(), True), True), True),
])

RAW_DDL = "time bigint, part int, copy string, states array<array<string>>"
# The same with the elements of a vector as they are typed in the document.
RAW_VARIANT_DDL = RAW_DDL.replace("<array<string>>", "<array<variant>>")

# The slot table of a state vector (position, column, type).
# Slots 12 (sensors) and 15 are not mapped.
STATE_SLOTS = (
    (0, "icao24", "string"),
    (1, "callsign", "string"),
    (2, "origin_country", "string"),
    (3, "time_position", "double"),
    (4, "last_contact", "double"),
    (5, "longitude", "double"),
    (6, "latitude", "double"),
    (7, "baro_altitude", "double"),
    (8, "on_ground", "boolean"),
    (9, "velocity", "double"),
    (10, "true_track", "double"),
    (11, "vertical_rate", "double"),
    (13, "geo_altitude", "double"),
    (14, "squawk", "string"),
    (16, "category", "int"),
)

MAPPED_COLUMNS = ["snapshot_time"] + [name for _, name, _ in STATE_SLOTS]

# The transformed row and the history table, in this order.
HISTORY_COLUMNS = [
    "snapshot_time", "icao24", "callsign", "origin_country", "time_position",
    "last_contact", "longitude", "latitude", "on_ground", "heading_degrees",
    "squawk", "altitude_feet", "geo_altitude_feet", "speed_kmh",
    "vertical_rate_ftpm", "ingested_at", "flight_category", "flight_phase",
]

HISTORY_KEYS = ["snapshot_time", "icao24"]

# Columns a matched history row takes from the new batch; the two keys and
# ``time_position``, ``last_contact`` keep the stored value.
HISTORY_UPDATE_COLUMNS = [
    "callsign", "origin_country", "latitude", "longitude", "altitude_feet",
    "geo_altitude_feet", "speed_kmh", "vertical_rate_ftpm", "heading_degrees",
    "on_ground", "squawk", "flight_phase", "flight_category", "ingested_at",
]

FACT_COLUMNS = [
    "icao24", "callsign", "origin_country", "latitude", "longitude",
    "altitude_feet", "geo_altitude_feet", "speed_kmh", "vertical_rate_ftpm",
    "heading_degrees", "on_ground", "squawk", "flight_phase", "flight_category",
    "snapshot_time", "ingested_at", "flight_type", "speed_category",
]

DAILY_KEYS = ["flight_date"]

DAILY_MEASURES = [
    "total_flights", "unique_aircraft", "countries_represented",
    "flights_airborne", "flights_on_ground", "domestic_flights",
    "international_flights", "avg_speed_kmh", "avg_altitude_feet",
]
