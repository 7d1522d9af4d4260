"""Nearest zone of long zone lists against all distances."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from windrisk.operators import spatial, zone_search
from windrisk.schemas import ZONES


def _frame(spark, lat, lon):
    return spark.createDataFrame(pd.DataFrame({"region_id": [f"z{i}" for i in range(len(lat))], "zone_idx": np.arange(len(lat)),
                                               "lat": lat, "lon": lon}))


def _brute(cell_lat, cell_lon, lat, lon, metric):
    if metric == "degrees":
        return (cell_lat[:, None] - lat) ** 2 + (cell_lon[:, None] - lon) ** 2
    a = (np.sin(np.radians(lat - cell_lat[:, None]) / 2) ** 2
         + np.cos(np.radians(cell_lat[:, None])) * np.cos(np.radians(lat)) * np.sin(np.radians(lon - cell_lon[:, None]) / 2) ** 2)
    return np.arctan2(np.sqrt(a), np.sqrt(1 - a))


@pytest.mark.parametrize("metric", ["degrees", "haversine"])
def test_ten_thousand_zones_equal_brute_force(spark, metric):
    """Dense and sparse parts, cells far from every zone, both sides of the date line and both poles."""
    rng = np.random.default_rng(3)
    lat = np.concatenate([rng.normal(55, 2, 7000), rng.uniform(-89, 89, 1000), rng.normal(-17, 1, 1900), rng.uniform(88, 90, 100)])
    lon = np.concatenate([rng.normal(12, 3, 7000), rng.uniform(-180, 180, 1000), (rng.normal(180, 2, 1900) + 180) % 360 - 180,
                          rng.uniform(-180, 180, 100)])
    cell_lat = np.concatenate([rng.uniform(-90, 90, 1500), rng.normal(-17, 3, 200), [90.0, -90.0, 0.0, 0.0]])
    cell_lon = np.concatenate([rng.uniform(-180, 180, 1500), (rng.normal(180, 3, 200) + 180) % 360 - 180, [0.0, 0.0, 180.0, -180.0]])
    cells = spark.createDataFrame(pd.DataFrame({"latitude": cell_lat, "longitude": cell_lon}))
    got = zone_search.nearest_zones(cells, _frame(spark, lat, lon), metric).toPandas()
    assert len(got) == len(cell_lat)
    gaps = _brute(got.latitude.to_numpy(), got.longitude.to_numpy(), lat, lon, metric)
    chosen = gaps[np.arange(len(got)), got.region_id.str[1:].astype(int)]
    assert np.all(chosen <= gaps.min(axis=1) * (1 + 1e-12) + 1e-15)


def test_ties_go_to_the_first_zone(spark):
    """An even lattice: many cells are equally far from two or four zones; every position is taken twice."""
    lat, lon = [a.ravel() for a in np.meshgrid(np.arange(40.0, 60.0, 2.0), np.arange(0.0, 40.0, 2.0))]
    lat, lon = np.concatenate([lat[::-1], lat]), np.concatenate([lon[::-1], lon])
    cell_lat, cell_lon = [a.ravel() for a in np.meshgrid(np.arange(41.0, 59.0, 1.0), np.arange(1.0, 39.0, 1.0))]
    cells = spark.createDataFrame(pd.DataFrame({"latitude": cell_lat, "longitude": cell_lon}))
    got = zone_search.nearest_zones(cells, _frame(spark, lat, lon)).toPandas()
    gaps = _brute(got.latitude.to_numpy(), got.longitude.to_numpy(), lat, lon, "degrees")
    assert list(got.region_id) == [f"z{i}" for i in gaps.argmin(axis=1)]


@pytest.mark.parametrize("metric", ["degrees", "haversine"])
def test_same_as_literal_zones(spark, metric):
    grid = spark.range(4000).select(
        (F.lit(40.0) + F.col("id") % 97 * 0.5).alias("latitude"), (F.lit(-30.0) + F.col("id") % 83 * 0.75).alias("longitude"),
        F.col("id").alias("row"), F.lit("x").alias("first"))
    zones = spark.createDataFrame([(z, i, *at) for i, (z, at) in enumerate(ZONES.items())], "region_id string, zone_idx int, lat double, lon double")
    got = zone_search.assign_zone_list(grid, zones, metric)
    assert got.columns == ["latitude", "longitude", "row", "first", "region_id"]
    assert rows(got) == rows(spatial.assign_zone(grid, metric=metric))


def test_missing_positions_and_empty_lists(spark):
    zones = spark.createDataFrame([("A", 0, None, 1.0), ("B", 1, float("nan"), 1.0), ("C", 2, 1.0, 1.0)],
                                  "region_id string, zone_idx int, lat double, lon double")
    grid = spark.createDataFrame([(0.0, 1.0), (None, 1.0), (float("nan"), 2.0), (80.0, -170.0)], "latitude double, longitude double")
    assert rows(zone_search.assign_zone_list(grid, zones)) == [(0.0, 1.0, "C"), (80.0, -170.0, "C")]
    assert rows(zone_search.assign_zone_list(grid, zones.limit(0))) == [(0.0, 1.0, None), (80.0, -170.0, None)]
    assert zone_search.assign_zone_list(grid.limit(0), zones).count() == 0
    with pytest.raises(ValueError):
        zone_search.nearest_zones(grid, zones, "miles")
