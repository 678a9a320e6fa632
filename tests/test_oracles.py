"""Every registered query against its DuckDB oracle at sf 0.001."""

import pytest

import __spark_entry__ as entry
from skyfold.plans.queries import QUERIES
from oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert res["columns_match"], res
    assert res["exact"], res
    assert not res["python_udf"], res      # built-in functions only


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["origin_country", "unique_aircraft", "total_flights", "avg_speed_kmh",
                          "avg_altitude_feet", "flights_airborne", "flights_on_ground"]
