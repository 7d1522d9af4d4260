"""Correlations of many zones, tile by tile."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from windrisk.operators import correlation


def _long(values):
    steps, zones = values.shape
    stamps = pd.date_range("2024-01-01", periods=steps, freq="h")
    return pd.DataFrame({"timestamp": np.repeat(stamps, zones), "region_id": np.tile([f"z{i:04d}" for i in range(zones)], steps),
                         "wind_speed_mps": values.ravel()})


@pytest.mark.parametrize("zones, tile, block", [(70, 16, 4096), (33, 33, 7), (40, 64, 16)])
def test_tiles_equal_numpy(spark, monkeypatch, zones, tile, block):
    """Slices that do and do not divide the zones, one and many blocks; a constant zone and an incomplete timestep."""
    monkeypatch.setattr(correlation._tiled_products, "__defaults__", (block,))
    rng = np.random.default_rng(zones)
    values = rng.normal(1000, 1, (60, zones)) + rng.normal(0, 2, (60, 1)) * rng.random(zones)
    values[:, 3] = 7.1
    frame = _long(values).drop(index=5).reset_index(drop=True)  # zone 5 is missing at the first timestep
    got = correlation.correlation_matrix(spark.createDataFrame(frame).repartition(5), array_zones=8, tile=tile).toPandas()
    assert len(got) == zones * zones
    with np.errstate(all="ignore"):
        expected = np.corrcoef(values[1:].T)
    matrix = got.pivot(index="zone_a", columns="zone_b", values="value").to_numpy(dtype=float)
    flat = np.arange(zones) == 3
    assert np.isnan(matrix[flat]).all() and np.isnan(matrix[:, flat]).all()
    assert np.allclose(matrix[~flat][:, ~flat], expected[~flat][:, ~flat], atol=1e-10)
    assert np.array_equal(matrix[~flat][:, ~flat], matrix[~flat][:, ~flat].T)


def test_too_few_steps_and_missing_zones(spark):
    rows = spark.createDataFrame(_long(np.random.default_rng(1).normal(5, 1, (4, 30))))
    one = rows.where(F.col("timestamp") < F.lit("2024-01-01 01:00:00").cast("timestamp"))
    assert correlation.correlation_matrix(one, array_zones=8, tile=8).count() == 0
    known = [f"z{i:04d}" for i in range(31)]
    assert correlation.correlation_matrix(rows, known, array_zones=8, tile=8).count() == 0
