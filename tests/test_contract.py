"""The registry: every query has a name by the survey's ids; SQL checks run on the smallest data."""

import sys

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import ROOT, TESTDATA

sys.path.insert(0, f"{ROOT}/tools")
from check import TABLES, compare  # noqa: E402

SF = f"{TESTDATA}/sf0.001"
SMALL = ["a2_silver_weather", "a4_energy_wide", "a5_snapshots_hourly", "a11_cvar", "a12_quantiles", "a19_zone_means",
         "j3_zone_distances", "s4_market_xml"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 100


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["region_id", "horizon_h", "p_shortfall", "cvar_shortfall", "wind_p10", "wind_p50", "wind_p90"]
    assert df.count() > 0


@pytest.mark.parametrize("name", SMALL)
def test_query_equals_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF).toPandas()
    assert len(got) > 0
    assert compare(got, duck.execute(contract.oracle_sql()[name]).df()) == ""
