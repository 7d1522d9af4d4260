"""Chain, ELBO and calibration diagnostics against direct numpy computations."""

from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from windrisk.operators import diagnostics as diag


def chain_table(spark, arrays):
    """{param: (chains x draws)} as a table."""
    parts = []
    for param, x in arrays.items():
        c, d = x.shape
        parts.append(pd.DataFrame({"chain": np.repeat(np.arange(c), d), "draw": np.tile(np.arange(d), c),
                                   "param": param, "value": x.ravel()}))
    return spark.createDataFrame(pd.concat(parts)).repartition(5)


def halves(x):
    half = x.shape[1] // 2
    return np.concatenate([x[:, :half], x[:, x.shape[1] - half:]])


def plain_rhat(split):
    n = split.shape[1]
    within = split.var(axis=1, ddof=1).mean()
    return np.sqrt((within * (n - 1) / n + split.mean(axis=1).var(ddof=1)) / within)


def scores(x):
    ranks = pd.Series(x.ravel()).rank().to_numpy()
    inverse = NormalDist().inv_cdf
    return np.array([inverse((r - 0.375) / (len(ranks) + 0.25)) for r in ranks]).reshape(x.shape)


def direct_ess(split):
    """Loop form: pairs of autocorrelations up to the first negative pair, made non-increasing.

    The last pair looked at, (n - 3) // 2 at most, counts by its even member only.
    """
    m, n = split.shape
    centred = split - split.mean(axis=1, keepdims=True)
    acov = np.array([[(c[:n - k] * c[k:]).sum() / n for k in range(n)] for c in centred]).mean(axis=0)
    total = acov[0] + split.mean(axis=1).var(ddof=1)
    within = acov[0] * n / (n - 1)
    rho = [1.0] + [1 - (within - acov[k]) / total for k in range(1, n)]
    tau, ceiling, k = -1.0, np.inf, 0
    while k // 2 < (n - 3) // 2 and rho[k] + rho[k + 1] > 0:
        ceiling = min(ceiling, rho[k] + rho[k + 1])
        tau += 2 * ceiling
        k += 2
    if rho[k] > 0:
        tau += rho[k]
    return m * n / max(tau, 1 / np.log10(m * n))


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(5)
    white = rng.normal(size=(4, 201))
    walk = np.zeros((4, 201))
    for t in range(1, 201):
        walk[:, t] = 0.9 * walk[:, t - 1] + rng.normal(size=4)
    shifted = rng.normal(size=(4, 201)) + np.arange(4)[:, None]
    ties = np.round(rng.normal(size=(4, 201)), 1)
    return {"white": white, "walk": walk, "shifted": shifted, "ties": ties}


def test_split_rhat(spark, arrays):
    got = diag.rhat(chain_table(spark, arrays), "split").toPandas().set_index("param")["r_hat"]
    for name, x in arrays.items():
        assert got[name] == pytest.approx(plain_rhat(halves(x)), rel=1e-9)
    assert got["shifted"] > 1.3 and got["white"] < 1.02


def test_rank_rhat(spark, arrays):
    got = diag.rhat(chain_table(spark, arrays)).toPandas().set_index("param")["r_hat"]
    for name, x in arrays.items():
        split = halves(x)
        want = max(plain_rhat(scores(split)), plain_rhat(scores(np.abs(split - np.median(split)))))
        assert got[name] == pytest.approx(want, rel=1e-9)
    with pytest.raises(ValueError):
        diag.rhat(chain_table(spark, arrays), "other")


def test_ess(spark, arrays):
    got = diag.ess(chain_table(spark, arrays)).toPandas().set_index("param")
    for name, x in arrays.items():
        assert got.loc[name, "ess_bulk"] == pytest.approx(direct_ess(scores(halves(x))), rel=1e-6)
        low, high = np.quantile(x, [0.05, 0.95])
        want = min(direct_ess(halves((x <= q).astype(float))) for q in (low, high))
        assert got.loc[name, "ess_tail"] == pytest.approx(want, rel=1e-6)
    assert got.loc["walk", "ess_bulk"] < 0.3 * got.loc["white", "ess_bulk"]


def test_normal_scores_of_large_groups(spark, arrays):
    split = diag.split_chains(chain_table(spark, {"ties": arrays["ties"], "walk": arrays["walk"]}))
    order = ["param", "seq", "pos"]
    small = diag.normal_scores(split).toPandas().sort_values(order)
    large = diag.normal_scores(split, in_memory_rows=0).toPandas().sort_values(order)
    assert list(small.columns) == list(large.columns) == ["param", "seq", "pos", "value"]
    assert np.allclose(small.value, large.value) and list(small.seq) == list(large.seq)


def test_autocovariance_blocks_change_nothing(spark, arrays):
    split = diag.split_chains(chain_table(spark, {"walk": arrays["walk"]}))
    whole = diag.autocovariance(split, 20).orderBy("lag").toPandas()
    pieces = diag.autocovariance(split, 20, block=23).orderBy("lag").toPandas()
    assert np.allclose(whole.acov, pieces.acov, atol=1e-10)
    assert list(whole.lag) == list(range(21))


def test_lag_range_grows_until_resolved(spark):
    rng = np.random.default_rng(6)
    slow = np.zeros((2, 1200))
    for t in range(1, 1200):
        slow[:, t] = 0.995 * slow[:, t - 1] + rng.normal(size=2)
    split = diag.split_chains(chain_table(spark, {"slow": slow}))
    got = diag._ess(split, lags=4).first().ess
    assert got == pytest.approx(direct_ess(halves(slow)), rel=1e-6)


def test_constant_chain(spark):
    split = diag.split_chains(chain_table(spark, {"c": np.ones((2, 40))}))
    assert diag._ess(split).first().ess == 80.0
    assert diag.rhat(chain_table(spark, {"c": np.ones((2, 40))}), "split").first().r_hat is None


def test_elbo(spark):
    def history(run, values):
        return [(run, i, float(v)) for i, v in enumerate(values)]
    rng = np.random.default_rng(7)
    rows = history("flat", 100 + rng.normal(0, 0.1, 1200)) + history("short", [100.0] * 999)
    rows += history("noisy", 100 + rng.normal(0, 20, 1200)) + history("tiny", range(39)) + history("rising", range(1000))
    df = spark.createDataFrame(rows, "run_id string, iter long, elbo double")
    verdict = {r.run_id: r.elbo_converged for r in diag.elbo_converged(df).collect()}
    assert verdict == {"flat": True, "short": False, "noisy": False, "tiny": False, "rising": False}
    for limit in (200_000, 0):
        drift = {r.run_id: r for r in diag.elbo_drift(df, limit).collect()}
        assert "tiny" not in drift
        last, prev = np.arange(950, 1000).mean(), np.arange(900, 950).mean()
        assert drift["rising"].rel_delta == pytest.approx((last - prev) / (prev + 1e-9))
        assert drift["rising"].still_improving and not drift["short"].still_improving


def test_median_error_and_bundle(spark, arrays):
    rng = np.random.default_rng(8)
    samples, y = rng.normal(size=(31, 5)), rng.normal(size=5)
    observed = spark.createDataFrame(pd.DataFrame({"obs_id": range(5), "y": y}))
    long = spark.createDataFrame(pd.DataFrame({"obs_id": np.tile(range(5), 31), "value": samples.ravel()}))
    want = np.abs(y - np.median(samples, axis=0)).mean()
    assert diag.median_error(observed, long).first()[0] == pytest.approx(want)
    stats = spark.createDataFrame([(0, 0, True), (0, 1, False)], "chain int, draw int, diverging boolean")
    metrics = diag.run_diagnostics(spark, chains=chain_table(spark, {"white": arrays["white"]}), sampler_stats=stats,
                                   observed=observed, samples=long)
    table = {r.key: r for r in diag.verdicts(metrics).collect()}
    assert set(table) == {"max_r_hat", "min_ess_bulk", "min_ess_tail", "n_divergences", "crps"}
    assert table["n_divergences"].value == 1.0 and table["n_divergences"].label == "warn"
    assert table["crps"].label is None
    assert diag.run_diagnostics(spark).count() == 0


def test_normal_quantile_column(spark):
    from windrisk.functions.normal import normal_quantile
    ps = [1e-300, 1e-12, 1e-4, 0.02, 0.075, 0.3, 0.5, 0.7, 0.97, 1 - 1e-9]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select(normal_quantile(F.col("p")).alias("z")).collect()
    assert np.allclose([r.z for r in got], [NormalDist().inv_cdf(p) for p in ps], rtol=1e-12)
