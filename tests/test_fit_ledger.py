"""The incremental fit against a fit of all rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from windrisk.operators import features as feat
from windrisk.operators import fit_ledger, hsgp
from windrisk.plans import forecasting


@pytest.fixture(scope="module")
def days():
    """Rows of ten daily files, three zones, as one frame each."""
    rng = np.random.default_rng(5)
    out = {}
    for d in range(10):
        hours = pd.date_range(f"2023-03-{d + 1:02d}", periods=24, freq="h")
        frame = pd.DataFrame([(t, z) for t in hours for z in ("DK1", "FI", "SE1")], columns=["timestamp", "region_id"])
        out[f"day{d}"] = frame.assign(file_id=f"day{d}", wind_speed_mps=rng.normal(7, 2, len(frame)))
    return out


def _table(spark, frames):
    return spark.createDataFrame(pd.concat(frames, ignore_index=True))


def _check(spark, folder, rows):
    """The ledger's statistics are those of all rows in the same basis."""
    model, index = fit_ledger.fit(spark, folder)
    full = hsgp.fit_of(hsgp.sufficient_statistics(feat.features(rows), model.domain), model.domain)
    assert model.n == full.n and model.yy == pytest.approx(full.yy, rel=1e-12)
    assert np.allclose(model.gram, full.gram, rtol=1e-10, atol=1e-9)
    assert np.allclose(model.proj, full.proj, rtol=1e-10, atol=1e-9)
    assert sorted(r.region_id for r in index.collect()) == sorted(r.region_id for r in rows.select("region_id").distinct().collect())
    return model


def test_add_replace_withdraw(spark, days, tmp_path):
    folder = str(tmp_path / "ledger")
    assert fit_ledger.fit(spark, folder) is None
    first = _table(spark, [days[f"day{d}"] for d in range(7)])
    assert fit_ledger.update(first, folder) == fit_ledger.Update(7, 0, 0, True)
    _check(spark, folder, first)
    # Same content in another order: nothing to do, nothing written.
    assert fit_ledger.update(first.orderBy(F.rand(1)).repartition(3), folder) == fit_ledger.Update(0, 0, 0, False)
    assert fit_ledger.last_commit(spark, folder).batch == 0

    changed = days["day3"].assign(wind_speed_mps=days["day3"].wind_speed_mps + 1.0)
    new_zone = days["day8"].assign(region_id=days["day8"].region_id.replace("FI", "NO1"))
    second = _table(spark, [days["day0"], days["day1"], changed, days["day4"], days["day6"], days["day7"], new_zone])
    assert fit_ledger.update(second, folder) == fit_ledger.Update(2, 1, 2, False)
    _check(spark, folder, second)
    # The new zone goes with its file.
    third = _table(spark, [days["day0"], days["day1"], changed, days["day4"], days["day6"], days["day7"]])
    assert fit_ledger.update(third, folder) == fit_ledger.Update(0, 0, 1, False)
    model = _check(spark, folder, third)
    trained = forecasting.train_ledger(spark, folder, n_samples=20, grid_points=8)
    assert trained.model.n == model.n and trained.draws.count() == 20
    assert forecasting.forecast_table(third, trained).count() == 9
    fit_ledger.update(third.limit(0), folder)
    assert fit_ledger.fit(spark, folder) is None


def test_interval_versions(spark, days, tmp_path):
    """Data within the room ahead keep the version; data beyond it, before the start, or far too short begin a new one."""
    folder = str(tmp_path / "ledger")
    steps = [(range(2, 6), True), (range(2, 7), False), (range(2, 10), True), (range(0, 10), True), (range(0, 9), False), (range(4, 6), True)]
    for days_in, new_version in steps:
        rows = _table(spark, [days[f"day{d}"] for d in days_in])
        assert fit_ledger.update(rows, folder).new_version is new_version
        _check(spark, folder, rows)
    assert fit_ledger.update(rows, folder, m_temporal=6).new_version
    assert _check(spark, folder, rows).domain.m_temporal == 6


def test_failed_update_leaves_the_ledger(spark, days, tmp_path, monkeypatch):
    folder = str(tmp_path / "ledger")
    first = _table(spark, [days["day0"], days["day1"], days["day2"]])
    fit_ledger.update(first, folder)
    second = _table(spark, [days["day0"], days["day2"], days["day3"]])
    with monkeypatch.context() as broken:
        broken.setattr(fit_ledger, "_stored_sums", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fit_ledger.update(second, folder)
    _check(spark, folder, first)
    assert fit_ledger.update(second, folder) == fit_ledger.Update(1, 0, 1, False)
    _check(spark, folder, second)


def test_totals_are_rebuilt(spark, days, tmp_path, monkeypatch):
    monkeypatch.setattr(fit_ledger, "REBUILD", 2)
    folder = str(tmp_path / "ledger")
    for files in ((0, 1, 2, 3), (0, 1, 2), (0, 1, 3), (1, 2, 3)):
        rows = _table(spark, [days[f"day{d}"] for d in files])
        fit_ledger.update(rows, folder)
        _check(spark, folder, rows)


def test_listing_decides_what_is_read(spark, days, tmp_path):
    folder = str(tmp_path / "ledger")
    rows = _table(spark, [days["day0"], days["day1"], days["day2"]])
    listing = lambda **files: spark.createDataFrame(list(files.items()), "file_id string, digest string")
    assert fit_ledger.update(rows, folder, listing(day0="a", day1="a", day2="a")).added == 3
    # Only the changed file's rows are at hand.
    changed = days["day1"].assign(wind_speed_mps=1.0)
    assert fit_ledger.update(_table(spark, [changed]), folder, listing(day0="a", day1="b", day2="a")) == fit_ledger.Update(0, 1, 0, False)
    _check(spark, folder, _table(spark, [days["day0"], changed, days["day2"]]))


def test_missing_values_count_nothing(spark, days, tmp_path):
    folder = str(tmp_path / "ledger")
    holes = days["day1"].astype({"region_id": object}).copy()
    holes.loc[0, "region_id"], holes.loc[1, "wind_speed_mps"] = None, float("nan")
    rows = _table(spark, [days["day0"], holes])
    fit_ledger.update(rows, folder)
    _check(spark, folder, rows.dropna())
    assert fit_ledger.update(rows.limit(0), str(tmp_path / "none")) == fit_ledger.Update(0, 0, 0, True)
    assert fit_ledger.fit(spark, str(tmp_path / "none")) is None
