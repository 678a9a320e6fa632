"""The aircraft-snapshot preset: the constants of the source pipeline and the
transform that turns mapped state vectors into history rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.functions.labels import bucketize, code_label, equals_label, first_match
from skyfold.functions.scalar import scale_round, trim_upper
from skyfold.functions.sqltext import ident
from skyfold.operators.filters import all_present, require_non_null, within_box
from skyfold.operators.shape import drop_columns, explode_states, map_slots, rename
from skyfold.schema import HISTORY_COLUMNS

# ---------------------------------------------------------------------------
# These must equal the source pipeline's for equal results.
# ---------------------------------------------------------------------------
LOCAL_ZONE = "Asia/Kolkata"
HOME_COUNTRY = "India"
# min_lat, max_lat, min_lon, max_lon
BOUNDING_BOX = (6.0, 37.0, 68.0, 97.0)
REQUIRED_COLUMNS = ("icao24", "callsign", "latitude", "longitude")
METRES_TO_FEET = 3.2804
MPS_TO_KMH = 3.6
MPS_TO_FEET_PER_MINUTE = 196.85
CATEGORY_LABELS = {
    0: "No Info",
    1: "No ADS-B Emitter",
    2: "Light Aircraft",
    3: "Small Aircraft",
    4: "Large Aircraft",
    5: "High Vortex Large Aircraft",
    6: "Heavy Aircraft",
    7: "High Performance Aircraft",
    8: "Rotorcraft",
    9: "Glider",
    10: "lighter Than Air",
    11: "Parachutist",
    12: "Ultralight",
    15: "UAV",
    16: "Surface Vehicle - Emergency",
    17: "Surface Vehicle - Service",
}
UNKNOWN = "Unknown"
PHASE_ON_GROUND = "On Ground"
PHASE_LOW = "Takeoff / Landing"
PHASE_MID = "Climbing / Descending"
PHASE_HIGH = "Cruising"
PHASE_LOW_BELOW_M = 1000
PHASE_MID_UP_TO_M = 6000
DOMESTIC = "Domestic"
INTERNATIONAL = "International"
SPEED_BANDS = (
    (300, "Slow (<300 km/h)"),
    (600, "Medium (300-600 km/h)"),
    (900, "Fast (600-900 km/h)"),
)
SPEED_TOP = "Very Fast (>900 km/h)"
RETENTION_DAYS = 90
DROPPED_AFTER_TRANSFORM = ("baro_altitude", "geo_altitude", "velocity", "vertical_rate", "category")
# ---------------------------------------------------------------------------


def category_label(c: str | Column = "category") -> Column:
    return code_label(c, CATEGORY_LABELS, UNKNOWN)


def flight_phase(on_ground: str = "on_ground", altitude_m: str = "baro_altitude") -> Column:
    """First match: on the ground; below the low bound; between the bounds
    (inclusive); else cruising (a null altitude included)."""
    alt = ident(altitude_m)
    return first_match([
        (f"{ident(on_ground)} = TRUE", PHASE_ON_GROUND),
        (f"{alt} < {PHASE_LOW_BELOW_M}", PHASE_LOW),
        (f"{alt} BETWEEN {PHASE_LOW_BELOW_M} AND {PHASE_MID_UP_TO_M}", PHASE_MID),
    ], PHASE_HIGH)


def flight_type(country: str = "origin_country") -> Column:
    return equals_label(country, HOME_COUNTRY, DOMESTIC, INTERNATIONAL)


def speed_category(speed: str = "speed_kmh") -> Column:
    return bucketize(speed, SPEED_BANDS, SPEED_TOP, null_label=UNKNOWN)


def required_present() -> Column:
    return all_present(REQUIRED_COLUMNS)


def transform_states(mapped: DataFrame, ingested_at: Column | None = None,
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """Mapped vectors → history rows (18 columns, fixed order).

    ``ingested_at`` defaults to the processing time; pass a literal (or a
    column) for repeatable results. ``carry`` names extra input columns kept
    after the 18 (e.g. a row id used to order a later dedup).
    """
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    df = mapped.withColumns({
        "callsign": trim_upper("callsign"),
        "altitude_feet": scale_round("baro_altitude", METRES_TO_FEET),
        "geo_altitude_feet": scale_round("geo_altitude", METRES_TO_FEET),
        "speed_kmh": scale_round("velocity", MPS_TO_KMH),
        "vertical_rate_ftpm": scale_round("vertical_rate", MPS_TO_FEET_PER_MINUTE),
    })
    df = rename(df, {"true_track": "heading_degrees"})
    df = df.withColumns({
        "ingested_at": stamp,
        "flight_category": category_label("category"),
        "flight_phase": flight_phase(),
    })
    return drop_columns(df, DROPPED_AFTER_TRANSFORM).select(*HISTORY_COLUMNS, *carry)


def clean(mapped: DataFrame, ingested_at: Column | None = None,
          carry: tuple[str, ...] = (), box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Required-columns filter (and bounding box, if given), then the transform (filter runs before trim)."""
    rows = require_non_null(mapped, REQUIRED_COLUMNS)
    return transform_states(rows if box is None else within_box(rows, box), ingested_at, carry)


def snapshot_rows(docs: DataFrame, ingested_at: Column | None = None,
                  box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Snapshot documents → history rows: explode, map slots, filter, transform."""
    return clean(map_slots(explode_states(docs)), ingested_at, box=box)
