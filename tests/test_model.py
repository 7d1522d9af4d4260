"""The low-rank model against dense formulas."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from windrisk.operators import features as feat
from windrisk.operators import hsgp
from windrisk.plans import forecasting


@pytest.fixture(scope="module")
def snaps(spark):
    """48 hours, four zones, N(7, 2)."""
    rng = np.random.default_rng(42)
    hours = pd.date_range("2023-01-01", periods=48, freq="h")
    frame = pd.DataFrame([(t, z) for t in hours for z in ("SE1", "SE2", "SE3", "SE4")], columns=["timestamp", "region_id"])
    frame["wind_speed_mps"] = rng.normal(7, 2, len(frame))
    return spark.createDataFrame(frame).cache()


def test_features(snaps):
    f = feat.features(snaps).toPandas()
    assert len(f) == 192
    assert f.x_s.between(0, 1).all() and sorted(f.x_s.unique()) == pytest.approx([0, 1 / 3, 2 / 3, 1])
    assert f.x_t.min() == 0 and f.x_t.max() == pytest.approx(47 / 168)


def test_horizon_points(snaps):
    points = feat.horizon_points(snaps).toPandas()
    assert len(points) == 12 and set(points.horizon_h) == {24, 48, 72}
    one = points[(points.region_id == "SE4") & (points.horizon_h == 48)].iloc[0]
    assert one.timestamp == pd.Timestamp("2023-01-04 23:00") and one.x_s == 1.0
    assert one.x_t == pytest.approx((47 + 48) / 168)


def test_single_zone_has_coordinate_zero(spark):
    df = spark.createDataFrame([("SE1", "2024-01-01 00:00:00", 1.0)], "region_id string, t string, wind_speed_mps double")
    f = feat.features(df.select(F.to_timestamp("t").alias("timestamp"), "region_id", "wind_speed_mps")).first()
    assert f.x_s == 0.0 and f.x_t == 0.0


def dense(fit_features, domain):
    phi = domain.basis(fit_features.x_s.to_numpy(), fit_features.x_t.to_numpy())
    return phi, fit_features.y.to_numpy()


def test_sufficient_statistics_equal_dense_sums(snaps):
    rows = feat.features(snaps)
    model = hsgp.fit(rows)
    phi, y = dense(rows.toPandas(), model.domain)
    assert np.allclose(model.gram, phi.T @ phi, rtol=1e-9, atol=1e-8)
    assert np.allclose(model.proj, phi.T @ y, rtol=1e-9, atol=1e-8)
    assert model.n == 192 and model.yy == pytest.approx((y * y).sum())


def test_evidence_equals_dense_gaussian(snaps):
    rows = feat.features(snaps)
    model = hsgp.fit(rows, 3, 4)
    phi, y = dense(rows.toPandas(), model.domain)
    for ell_s, ell_t, eta, sigma in ((0.3, 0.7, 2.0, 1.5), (1.0, 0.2, 5.0, 2.2)):
        d = eta * hsgp.spectral_root(model.domain, ell_s, ell_t)
        cov = (phi * d ** 2) @ phi.T + sigma ** 2 * np.eye(len(y))
        sign, logdet = np.linalg.slogdet(cov)
        want = -0.5 * (y @ np.linalg.solve(cov, y) + logdet + len(y) * math.log(2 * math.pi))
        got = hsgp.log_evidence(model, ell_s, ell_t, np.array([eta]), np.array([sigma]))[0]
        assert got == pytest.approx(want, rel=1e-9)


def test_basis_reproduces_the_kernel():
    domain = hsgp.Domain(40, 40, 0.0, 2.0, 0.0, 2.0)
    x = np.array([-0.3, 0.1, 0.5])
    phi = domain.basis(x, x)
    got = (phi * hsgp.spectral_root(domain, 0.5, 0.7) ** 2) @ phi.T
    r = np.abs(x[:, None] - x[None, :])
    scaled = np.sqrt(5 * ((r / 0.5) ** 2 + (r / 0.7) ** 2))
    assert np.allclose(got, (1 + scaled + scaled ** 2 / 3) * np.exp(-scaled), atol=5e-3)


def test_posterior_is_normalised_and_refined_grid_agrees(spark, snaps):
    model = hsgp.fit(feat.features(snaps), 3, 4)
    def means(points):
        nodes = hsgp.hyper_posterior(spark, model, points=points)
        return nodes.agg(F.sum("weight"), *[F.sum(F.col(p) * F.col("weight")) for p in hsgp.PARAMS]).first()
    coarse, fine = means(12), means(20)
    assert coarse[0] == pytest.approx(1.0) and fine[0] == pytest.approx(1.0)
    assert np.allclose(coarse[1:], fine[1:], rtol=0.03)
    assert 1.5 < fine[4] < 2.5  # sigma of the data is 2


def test_hyper_draws_follow_the_weights(spark, snaps):
    model = hsgp.fit(feat.features(snaps), 3, 4)
    nodes = hsgp.hyper_posterior(spark, model, points=12)
    draws = hsgp.hyper_draws(nodes, 400).toPandas()
    assert sorted(draws.sample_id) == list(range(400))
    want = nodes.agg(F.sum(F.col("sigma") * F.col("weight"))).first()[0]
    assert draws.sigma.mean() == pytest.approx(want, rel=0.02)
    assert draws.sort_values("sample_id").sigma.head(100).mean() == pytest.approx(want, rel=0.05)


def test_predictive_draws_match_posterior_moments(spark, snaps):
    """With one fixed hyper-parameter draw, mean and covariance have closed forms."""
    rows = feat.features(snaps)
    model = hsgp.fit(rows, 3, 4)
    n = 4000
    theta = dict(ell_spatial=0.5, ell_temporal=0.5, eta=3.0, sigma=1.5)
    draws = spark.range(n).select(F.col("id").cast("int").alias("sample_id"), *[F.lit(v).alias(k) for k, v in theta.items()])
    points = feat.horizon_points(snaps, [24])
    out = hsgp.predictive(points, hsgp.weight_draws(draws, model), model, ["region_id", "horizon_h"])
    wide = out.toPandas().pivot(index="sample_id", columns="region_id", values="value")
    pts = points.toPandas().set_index("region_id").loc[wide.columns]
    phi = model.domain.basis(pts.x_s.to_numpy(), pts.x_t.to_numpy())
    d = theta["eta"] * hsgp.spectral_root(model.domain, 0.5, 0.5)
    a = np.eye(model.domain.size) + d[:, None] * model.gram * d / 1.5 ** 2
    mean = phi @ (d * np.linalg.solve(a, d * model.proj / 1.5 ** 2))
    cov = (phi * d) @ np.linalg.inv(a) @ (phi * d).T + 1.5 ** 2 * np.eye(len(pts))
    assert np.allclose(wide.mean().to_numpy(), mean, atol=0.15)
    assert np.allclose(np.cov(wide.to_numpy().T), cov, rtol=0.1, atol=0.25)


def test_predictive_is_reproducible_and_partition_free(spark, snaps):
    trained = forecasting.train(snaps, n_samples=20, m_spatial=3, m_temporal=4, grid_points=8)
    first = forecasting.predictive_draws(snaps, trained).orderBy("region_id", "horizon_h", "sample_id").toPandas()
    again = forecasting.predictive_draws(snaps.repartition(7), trained).orderBy("region_id", "horizon_h", "sample_id").toPandas()
    assert len(first) == 4 * 3 * 20
    assert np.allclose(first.value, again.value, atol=1e-9)


def test_forecast_end_to_end(spark, snaps):
    table = forecasting.raw_to_forecasts(snaps, n_samples=50).toPandas()
    assert len(table) == 12
    assert table.p_shortfall.between(0, 1).all() and (table.cvar_shortfall >= 0).all()
    assert (table.wind_p10 <= table.wind_p50).all() and (table.wind_p50 <= table.wind_p90).all()
    assert sorted(table.timestamp.unique()) == list(pd.to_datetime(["2023-01-03 23:00", "2023-01-04 23:00", "2023-01-05 23:00"]))


def test_too_few_rows_give_an_empty_forecast(spark, snaps):
    few = snaps.limit(9)
    assert forecasting.train(few) is None
    table = forecasting.forecast_table(few, None)
    assert table.count() == 0 and len(table.columns) == 8
    assert forecasting.train(snaps.limit(0)) is None


def test_no_model_draws_are_nan(spark, snaps):
    draws = hsgp.no_model_draws(feat.horizon_points(snaps), 5, ["region_id", "horizon_h"])
    assert draws.count() == 60 and draws.where(~F.isnan("value")).count() == 0


def test_fixed_count_truncates_and_bootstraps_whole_scenarios(spark):
    rows = [(24, s, z, float(10 * s + i)) for s in range(5) for i, z in enumerate("ab")]
    draws = spark.createDataFrame(rows, "horizon_h int, sample_id int, region_id string, value double")
    cut = hsgp.fixed_count(draws, 3).toPandas()
    assert sorted(cut.value) == [0.0, 1.0, 10.0, 11.0, 20.0, 21.0]
    grown = hsgp.fixed_count(draws, 12).toPandas().pivot(index="sample_id", columns="region_id", values="value")
    assert len(grown) == 12 and list(grown.index) == list(range(12))
    assert (grown["b"] - grown["a"] == 1.0).all()


def test_long_draws_and_concat(spark):
    draws = spark.createDataFrame([(i, 1.0, 2.0, 3.0, float(i)) for i in range(6)], ["sample_id", *hsgp.PARAMS])
    chains = hsgp.long_draws(draws, 2)
    assert chains.count() == 24
    assert {(r.chain, r.draw) for r in chains.collect()} == {(c, d) for c in range(2) for d in range(3)}
    one = chains.where("chain = 0").drop("chain")
    assert hsgp.concat_chains([one, one]).groupBy("chain").count().orderBy("chain").collect()[1]["count"] == 12
    with pytest.raises(ValueError):
        hsgp.concat_chains([])
