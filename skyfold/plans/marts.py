"""Fact, dimension and daily summary tables, and their registry.

Each builder is a lazy DataFrame over the history; Catalyst prunes the scan to
the columns the mart uses. The dimension builders sort for readers of the
returned rows; a table write does not keep that order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions.aggregates import avg_2dp, avg_2dp_of_state, avg_2dp_state, avg_2dp_state_names
from skyfold.functions.scalar import utc_day
from skyfold.functions.sqltext import string_literal
from skyfold.plans.preset import DOMESTIC, INTERNATIONAL, flight_type, speed_category
from skyfold.schema import FACT_COLUMNS


def fact_flights(history: DataFrame) -> DataFrame:
    base = [c for c in FACT_COLUMNS if c not in ("flight_type", "speed_category")]
    return history.select(*base, flight_type().alias("flight_type"),
                          speed_category().alias("speed_category"))


def _avg2(c: str):
    return avg_2dp(c)


def dim_countries(history: DataFrame) -> DataFrame:
    return (history.filter(F.col("origin_country").isNotNull())
            .groupBy("origin_country")
            .agg(F.countDistinct("icao24").alias("unique_aircraft"),
                 F.expr("count(1)").alias("total_flights"),
                 _avg2("speed_kmh").alias("avg_speed_kmh"),
                 _avg2("altitude_feet").alias("avg_altitude_feet"),
                 F.expr("count_if(on_ground = FALSE)").alias("flights_airborne"),
                 F.expr("count_if(on_ground = TRUE)").alias("flights_on_ground"))
            .orderBy(F.desc("total_flights"), "origin_country"))


def dim_flight_phases(history: DataFrame) -> DataFrame:
    return (history.filter(F.col("flight_phase").isNotNull())
            .groupBy("flight_phase", "flight_category")
            .agg(F.expr("count(1)").alias("total_flights"),
                 _avg2("speed_kmh").alias("avg_speed_kmh"),
                 _avg2("altitude_feet").alias("avg_altitude_feet"),
                 _avg2("vertical_rate_ftpm").alias("avg_vertical_rate_ftpm"))
            .orderBy(F.desc("total_flights"), "flight_phase", "flight_category"))


def daily_summary(fact: DataFrame) -> DataFrame:
    """Per UTC day of ``ingested_at``. Two distinct counts plan as one Expand."""
    stamp_type = fact.schema["ingested_at"].dataType.simpleString()
    return (fact.filter(F.col("ingested_at").isNotNull())
            .groupBy(utc_day("ingested_at", stamp_type).alias("flight_date"))
            .agg(F.expr("count(1)").alias("total_flights"),
                 F.countDistinct("icao24").alias("unique_aircraft"),
                 F.countDistinct("origin_country").alias("countries_represented"),
                 F.expr("count_if(on_ground = FALSE)").alias("flights_airborne"),
                 F.expr("count_if(on_ground = TRUE)").alias("flights_on_ground"),
                 F.expr(f"count_if(flight_type = {string_literal(DOMESTIC)})").alias("domestic_flights"),
                 F.expr(f"count_if(flight_type = {string_literal(INTERNATIONAL)})").alias("international_flights"),
                 _avg2("speed_kmh").alias("avg_speed_kmh"),
                 _avg2("altitude_feet").alias("avg_altitude_feet")))


# -- dimensions from per-partition state ----------------------------------------
#
# A dimension over the whole history is the sum of what its partitions hold, once
# distinct values stay apart: per partition and group the counts and exact sums, and
# per aircraft so that an aircraft seen on several days counts once. When a merge
# changes some partitions, only their state is computed again; the dimension
# reads the state, which has a row per aircraft and day and not per report.
# Groups without a key stay in the state: a partition with rows always has state.

_COUNTRY_SUMS = ("speed_kmh", "altitude_feet")
_PHASE_SUMS = ("speed_kmh", "altitude_feet", "vertical_rate_ftpm")


def country_state(history: DataFrame, partition_col: str) -> DataFrame:
    return history.groupBy(partition_col, "origin_country", "icao24").agg(
        F.expr("count(1)").alias("total_flights"),
        *(part for c in _COUNTRY_SUMS for part in avg_2dp_state(c)),
        F.expr("count_if(on_ground = FALSE)").alias("flights_airborne"),
        F.expr("count_if(on_ground = TRUE)").alias("flights_on_ground"))


def countries_of_state(state: DataFrame) -> DataFrame:
    """``dim_countries``, unsorted, from the state of all partitions."""
    added = ["total_flights", "flights_airborne", "flights_on_ground",
             *(name for c in _COUNTRY_SUMS for name in avg_2dp_state_names(c))]
    aircraft = state.filter(F.col("origin_country").isNotNull()).groupBy("origin_country", "icao24").agg(
        *(F.sum(c).alias(c) for c in added))
    return aircraft.groupBy("origin_country").agg(
        F.count("icao24").alias("unique_aircraft"), F.sum("total_flights").alias("total_flights"),
        avg_2dp_of_state("speed_kmh").alias("avg_speed_kmh"),
        avg_2dp_of_state("altitude_feet").alias("avg_altitude_feet"),
        F.sum("flights_airborne").alias("flights_airborne"), F.sum("flights_on_ground").alias("flights_on_ground"))


def phase_state(history: DataFrame, partition_col: str) -> DataFrame:
    return history.groupBy(partition_col, "flight_phase", "flight_category").agg(
        F.expr("count(1)").alias("total_flights"), *(part for c in _PHASE_SUMS for part in avg_2dp_state(c)))


def phases_of_state(state: DataFrame) -> DataFrame:
    """``dim_flight_phases``, unsorted, from the state of all partitions."""
    return state.filter(F.col("flight_phase").isNotNull()).groupBy("flight_phase", "flight_category").agg(
        F.sum("total_flights").alias("total_flights"),
        avg_2dp_of_state("speed_kmh").alias("avg_speed_kmh"),
        avg_2dp_of_state("altitude_feet").alias("avg_altitude_feet"),
        avg_2dp_of_state("vertical_rate_ftpm").alias("avg_vertical_rate_ftpm"))


#: Marts kept by state: (state of some partitions, mart from the state of all).
STATE_MARTS = {"dim_countries": (country_state, countries_of_state), "dim_flight_phases": (phase_state, phases_of_state)}

# Named builders in the order they must run: the daily summary reads the fact.
MART_BUILDERS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "fct_flights": lambda t: fact_flights(t["history"]),
    "dim_countries": lambda t: dim_countries(t["history"]),
    "dim_flight_phases": lambda t: dim_flight_phases(t["history"]),
    "agg_flights_daily": lambda t: daily_summary(t["fct_flights"]),
}


def build_marts(history: DataFrame,
                read_back: Callable[[str, DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Run the builders in order; ``read_back`` may persist a mart and return
    the stored table, so later builders read it instead of recomputing."""
    tables = {"history": history}
    for name, build in MART_BUILDERS.items():
        df = build(tables)
        tables[name] = read_back(name, df) if read_back else df
    tables.pop("history")
    return tables


def mart_row_counts(history: DataFrame) -> DataFrame:
    """One row per mart: its name and its row count."""
    marts = build_marts(history)
    parts = [df.agg(F.expr("count(1)").alias("row_count")).select(
                 F.lit(name).alias("mart"), "row_count") for name, df in marts.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
