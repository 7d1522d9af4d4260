"""Cells to zones, zone matrices, energy shapes and snapshots."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from windrisk.functions import geo
from windrisk.operators import correlation, energy, snapshots, spatial
from windrisk.schemas import ZONES

T0 = dt.datetime(2024, 1, 1)


def test_nine_zones():
    assert len(ZONES) == 9 and list(ZONES)[0] == "SE1"


def test_nearest_zone_equals_brute_force(spark):
    lat, lon = np.meshgrid(np.arange(54, 72, 0.25), np.arange(4, 32, 0.5))
    cells = pd.DataFrame({"latitude": lat.ravel(), "longitude": lon.ravel(), "x": 1})
    got = spatial.assign_zone(spark.createDataFrame(cells)).toPandas()
    names, centers = list(ZONES), np.array(list(ZONES.values()))
    d = ((got[["latitude", "longitude"]].to_numpy()[:, None] - centers[None]) ** 2).sum(axis=2)
    assert list(got.region_id) == [names[i] for i in d.argmin(axis=1)]


def test_tie_goes_to_the_first_zone_and_far_cells_are_kept(spark):
    zones = {"B": (0.0, 0.0), "A": (0.0, 2.0)}
    cells = spark.createDataFrame([(0.0, 1.0), (80.0, -170.0), (None, 1.0)], "latitude double, longitude double")
    got = spatial.assign_zone(cells, zones)
    assert rows(got.select("latitude", "region_id")) == [(0.0, "B"), (80.0, "B")]
    one = spatial.assign_zone(cells, {"ONLY": (1.0, 1.0)})
    assert one.count() == 2
    with pytest.raises(ValueError):
        spatial.assign_zone(cells, metric="miles")


def test_no_join_and_no_python_in_the_zone_assignment(spark):
    cells = spark.createDataFrame([(0.0, 1.0)], "latitude double, longitude double")
    plan = spatial.assign_zone(cells)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Python" not in plan


def test_mean_of_file_means_weighs_files_not_cells(spark):
    grid = [("a", T0, 62.0, 14.5, 3.0, 4.0)] * 3 + [("b", T0, 62.0, 14.5, 6.0, 8.0), ("b", T0, 62.0, 14.5, float("nan"), 1.0)]
    df = spark.createDataFrame(grid, "file_id string, timestamp timestamp, latitude double, longitude double, u10 double, v10 double")
    assert rows(spatial.silver_weather(df).select("region_id", "wind_speed_mps")) == [("SE1", 7.5)]


def zone_frame(spark, zones):
    return spark.createDataFrame([(z, *p) for z, p in zones.items()], "region_id string, lat double, lon double")


def test_distance_matrix(spark):
    zones = dict(ZONES, X=(None, None))
    one = spatial.distance_matrix(zone_frame(spark, zones)).toPandas().pivot(index="zone_a", columns="zone_b", values="km")
    tiled = spatial.distance_matrix(zone_frame(spark, zones), blocks=3).toPandas().pivot(index="zone_a", columns="zone_b", values="km")
    assert one.shape == (10, 10) and (np.diag(one) == 0).all() and (one.to_numpy() == one.to_numpy().T).all()
    assert one.equals(tiled)
    def km(a, b):
        (la, lo), (lb, lp) = np.radians(zones[a]), np.radians(zones[b])
        return 6371 * math.acos(math.sin(la) * math.sin(lb) + math.cos(la) * math.cos(lb) * math.cos(lo - lp))
    assert one.loc["SE1", "FI"] == pytest.approx(km("SE1", "FI"), rel=1e-6)
    assert one.loc["X", "SE1"] == pytest.approx(6371 * math.acos(math.cos(math.radians(62)) * math.cos(math.radians(14.5))), rel=1e-6)


@pytest.mark.parametrize("nu", [0.5, 1.5, 2.5])
def test_general_matern_equals_closed_forms(spark, nu):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.5, 30.0, 100.0, 450.0, 3000.0)], "km double")
    general = F.when(F.col("km") == 0, F.lit(1.0)).otherwise(geo._bessel_kernel(nu)(F.col("km") / F.lit(100.0 + 1e-9)))
    for a, b in df.select(geo.matern(F.col("km"), 100.0, nu), general).collect():
        assert a == pytest.approx(b, rel=1e-7, abs=1e-12)


def test_general_matern_lies_between(spark):
    df = spark.createDataFrame([(80.0,)], "km double")
    low, mid, high = df.select(*[geo.matern(F.col("km"), 100.0, nu, 2.0) for nu in (0.5, 1.0, 1.5)]).first()
    assert low < mid < high


def test_matern_matrix_diagonal(spark):
    m = spatial.matern_matrix(spatial.distance_matrix(zone_frame(spark, ZONES)), 100.0, 1.0, 4.0)
    assert {r.value for r in m.where("zone_a = zone_b").collect()} == {4.0}
    assert spatial.frobenius(m).first()[0] > 12.0


ENERGY = "file_id string, timestamp timestamp, region_id string, variable string, value_mwh double"


def test_energy_wide_nulls_and_zeros(spark):
    data = [("f", T0, "SE", "B19", 5.0), ("g", T0, "SE", "B19", 2.0), ("f", T0, "SE1", "load_mwh", 9.0),
            ("f", T0, "10YFI-1--------U", "B18", 1.0), ("f", T0, "FI", "load_mwh", 3.0), ("f", T0, "XX", "B19", 7.0),
            ("f", T0, "DK1", "B19", float("nan")), ("f", T0, "DK2", "B16", 4.0), ("f", None, "DK2", "B19", 4.0)]
    df = energy.normalise(spark.createDataFrame(data, ENERGY))
    want = [("DK1", 0.0, 0.0, None), ("FI", 0.0, 1.0, 3.0), ("SE", 7.0, 0.0, None), ("SE1", None, None, 9.0)]
    assert rows(energy.wide(df).drop("timestamp")) == want
    through_join = energy.stacked(df).groupBy("timestamp", "region_id").agg(
        *[F.sum(c).alias(c) for c in ("wind_onshore_mwh", "wind_offshore_mwh", "total_load_mwh")])
    assert rows(through_join.drop("timestamp")) == want


def test_energy_hourly_averages_points(spark):
    data = [("f", T0 + dt.timedelta(minutes=15 * i), "SE", "B19", float(i)) for i in range(4)]
    df = energy.normalise(spark.createDataFrame(data, ENERGY))
    assert energy.wide(df).count() == 4
    assert rows(energy.wide(df, hourly=True).drop("timestamp")) == [("SE", 1.5, 0.0, None)]


def test_text_timestamps_are_parsed_and_bad_ones_dropped(spark):
    data = [("2024-01-01T00:00Z", "SE", "B19", 1.0), ("nope", "SE", "B19", 1.0)]
    df = energy.normalise(spark.createDataFrame(data, "timestamp string, region_id string, variable string, value_mwh double"))
    assert rows(df.select("region_id", "value_mwh")) == [("SE", 1.0)]


def test_weather_joins_load_by_zone_and_wind_by_area(spark):
    weather = spark.createDataFrame([(T0, "SE1", 5.0), (T0, "FI", 6.0), (T0, "NO2", 7.0)], "timestamp timestamp, region_id string, wind_speed_mps double")
    data = [("f", T0, "SE", "B19", 5.0), ("f", T0, "SE1", "load_mwh", 9.0), ("f", T0, "FI", "B18", 1.0)]
    got = energy.with_weather(weather, energy.wide(energy.normalise(spark.createDataFrame(data, ENERGY))))
    assert rows(got.drop("timestamp")) == [("FI", "FI", 6.0, 0.0, 1.0, None), ("NO2", "NO", 7.0, None, None, None),
                                           ("SE1", "SE", 5.0, 5.0, 0.0, 9.0)]


OBS = "timestamp timestamp, region_id string, wind_speed_mps double"


def test_snapshots_drop_null_keys_and_skip_nan(spark):
    data = [(T0, "A", 1.0), (T0, "A", float("nan")), (T0, None, 5.0), (None, "A", 5.0), (T0, "B", float("nan")),
            (T0 + dt.timedelta(minutes=10), "A", 4.0)]
    df = spark.createDataFrame(data, OBS)
    assert rows(snapshots.snapshots(df).select("region_id", "wind_speed_mps")) == [("A", 1.0), ("A", 4.0), ("B", None)]
    assert rows(snapshots.snapshots(df, hourly=True).select("region_id", "wind_speed_mps")) == [("A", 2.5), ("B", None)]


def test_drought_scaffold_and_prices(spark):
    hour = dt.timedelta(hours=1)
    data = [(T0, "A", 2.9), (T0, "B", 9.0), (T0 + 2 * hour, "A", 3.0), (T0 + 2 * hour, "B", None)]
    snaps = spark.createDataFrame(data, OBS)
    flags = snapshots.drought_flags(snaps)
    assert [r.is_drought for r in flags.orderBy("timestamp").collect()] == [True, False]
    assert snapshots.hour_scaffold(snaps).count() == 6
    assert snapshots.fill_scaffold(snapshots.hour_scaffold(snaps), snaps).where("wind_speed_mps IS NULL").count() == 3
    prices = spark.createDataFrame([(T0, "A", 300.0), (T0, "B", 100.0), (T0 + hour, "A", 50.0)],
                                   "timestamp timestamp, region_id string, price_eur_mwh double")
    assert rows(snapshots.price_regimes(prices, flags)) == [(False, 0.0, 50.0, 1), (True, 0.5, 200.0, 2)]
    assert snapshots.in_drought(prices, flags).count() == 2


def test_observed_row_count(spark):
    from windrisk.sources import sinks
    df, seen = snapshots.observed_rows(spark.range(17))
    sinks.noop(df)
    assert seen.get["n_rows"] == 17


def corr_case(spark, values, zones="ABC"):
    data = [(T0 + dt.timedelta(hours=i), z, v) for i, row in enumerate(values) for z, v in zip(zones, row) if v is not None]
    return spark.createDataFrame(data, OBS)


@pytest.mark.parametrize("pivot", [24, 0])
def test_correlation_equals_numpy_on_complete_timesteps(spark, pivot):
    rng = np.random.default_rng(9)
    values = rng.normal(7, 2, (30, 3))
    values[:, 1] += values[:, 0]
    data = values.tolist()
    data[4][2] = None
    got = correlation.correlation_matrix(corr_case(spark, data), pivot_zones=pivot).toPandas()
    want = np.corrcoef(np.delete(values, 4, axis=0).T)
    assert np.allclose(got.pivot(index="zone_a", columns="zone_b", values="value").to_numpy(), want, atol=1e-12)


@pytest.mark.parametrize("pivot", [24, 0])
def test_constant_zone_and_single_timestep_give_null(spark, pivot):
    got = correlation.correlation_matrix(corr_case(spark, [[1.0, 5.0], [2.0, 5.0]], "AB"), pivot_zones=pivot)
    assert rows(got) == [("A", "A", 1.0), ("A", "B", None), ("B", "A", None), ("B", "B", None)]
    one = correlation.correlation_matrix(corr_case(spark, [[1.0, 5.0]], "AB"), pivot_zones=pivot)
    assert one.count() == 0


def test_nested_round_trip(spark):
    matrix = correlation.correlation_matrix(corr_case(spark, [[1.0, 5.0], [2.0, 7.0], [0.0, 1.0]], "AB"))
    nested = correlation.nested(matrix).first()
    assert nested.zone_ids == ["A", "B"] and nested.correlation_matrix[0][0] == 1.0
    assert rows(correlation.unnested(correlation.nested(matrix))) == rows(matrix)


@pytest.mark.parametrize("value", [0.1, 7.1])
@pytest.mark.parametrize("pivot", [1, 24])
def test_a_constant_zone_has_no_correlation_whatever_its_mean_rounds_to(spark, value, pivot):
    from windrisk.operators import correlation
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), z, v) for h in range(70)
            for z, v in (("a", float(h % 7)), ("b", float(h % 5)), ("c", value))]
    df = spark.createDataFrame(rows, "timestamp timestamp, region_id string, wind_speed_mps double")
    got = {(r.zone_a, r.zone_b): r.value for r in correlation.correlation_matrix(df, pivot_zones=pivot).collect()}
    assert all(v is None for k, v in got.items() if "c" in k) and got[("a", "a")] == 1.0


def test_hourly_energy_adds_files_up(spark):
    from windrisk.operators import energy
    at = dt.datetime(2024, 1, 1)
    rows = [(f, at + dt.timedelta(minutes=m), "SE1", "B19", 10.0) for f in (1, 2) for m in (0, 30)]
    df = spark.createDataFrame(rows, "file_id int, timestamp timestamp, region_id string, variable string, value_mwh double")
    assert energy.wide(df, hourly=True).first().wind_onshore_mwh == 20.0
    with pytest.raises(ValueError):
        energy.wide(df.drop("file_id"), hourly=True)
