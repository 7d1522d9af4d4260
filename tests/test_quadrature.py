"""Adaptive quadrature against closed forms and dense grids."""

import math
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from windrisk.operators import hsgp, quadrature

# Workers cannot import this file, so its functions travel whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAMES = ["a", "b", "c", "d"]
LIMITS = [(-12.0, 12.0)] * 4
BOX = [(-4.0, 4.0)] * 4


def moments(spark, log_density, points=8, limits=LIMITS, box=BOX):
    """Mean of log x and of x for every parameter, and the quadrature."""
    found = quadrature.integrate(spark, log_density, box, limits, points)
    rows = quadrature.nodes(spark, found, log_density, limits, NAMES).toPandas()
    w = np.exp(rows.log_post + rows.log_share - found.top)
    w /= w.sum()
    logs = np.log(rows[NAMES].to_numpy())
    return (w.to_numpy()[:, None] * logs).sum(axis=0), (w.to_numpy()[:, None] * rows[NAMES].to_numpy()).sum(axis=0), found


def gaussian(z, mean, precision):
    d = z - mean
    return -0.5 * np.einsum("ni,ij,nj->n", d, precision, d)


def stack(z1, z2, z3, z4):
    return np.stack([np.full(len(z3), z1), np.full(len(z3), z2), z3, z4], axis=1)


def test_correlated_gaussian(spark):
    root = np.tril(np.array([[0.3, 0, 0, 0], [0.2, 0.1, 0, 0], [-0.3, 0.2, 0.2, 0], [0.1, 0.0, -0.3, 0.05]]))
    precision = np.linalg.inv(root @ root.T)
    mean = np.array([0.5, -1.0, 1.5, -2.0])
    logs, _, found = moments(spark, lambda *z: gaussian(stack(*z), mean, precision))
    assert np.allclose(logs, mean, atol=0.01) and found.error <= quadrature.TOLERANCE


def test_skewed_gamma_products(spark):
    """x ~ Gamma(shape, 1): strongly skewed in log space for small shapes; E x = shape."""
    shapes = np.array([0.6, 1.0, 3.0, 20.0])
    _, means, found = moments(spark, lambda *z: (stack(*z) * shapes - np.exp(stack(*z))).sum(axis=1), limits=[(-40.0, 12.0)] * 4)
    assert np.allclose(means, shapes, rtol=0.01) and found.error <= quadrature.TOLERANCE


def test_two_peaks_keep_their_shares(spark):
    first, second = np.array([-2.0, -1.5, 0.0, 1.0]), np.array([1.5, 1.0, 0.5, -1.0])
    sharp = np.diag([1 / 0.15 ** 2] * 4)

    def both(*z):
        rows = stack(*z)
        return np.logaddexp(math.log(0.3) + gaussian(rows, first, sharp), math.log(0.7) + gaussian(rows, second, sharp))

    logs, _, found = moments(spark, both)
    assert np.allclose(logs, 0.3 * first + 0.7 * second, atol=0.03)


def model_of(gram, proj, yy, n):
    size = int(math.isqrt(len(proj)))
    return hsgp.Fit(hsgp.Domain(size, len(proj) // size, 0.5, 0.75, 0.5, 0.75), np.array(gram), np.array(proj), yy, n)


def means_of(spark, model, points):
    nodes = hsgp.hyper_posterior(spark, model, points=points)
    return nodes.agg(*[F.sum(F.col(p) * F.col("weight")).alias(p) for p in hsgp.PARAMS], F.sum("weight").alias("weight"),
                     F.max("error").alias("error")).first()


def test_no_data_gives_the_priors(spark):
    """Flat evidence: means of InvGamma(3, 0.5), InvGamma(3, 1), HalfNormal(3), HalfNormal(2)."""
    got = means_of(spark, model_of(np.zeros((1, 1)), np.zeros(1), 0.0, 0), 8)
    half = math.sqrt(2.0 / math.pi)
    assert np.allclose(got[:4], [0.25, 0.5, 3.0 * half, 2.0 * half], rtol=0.02)
    assert got.weight == pytest.approx(1.0)


def test_data_without_noise_still_ends(spark):
    got = means_of(spark, model_of(np.eye(4) * 50.0, np.zeros(4), 0.0, 50), 8)
    assert got.weight == pytest.approx(1.0) and 0 < got.sigma < 1e-2


@pytest.mark.parametrize("n, noise", [(12, 1.0), (4000, 0.05)])
def test_posterior_equals_a_dense_grid(spark, n, noise):
    """Few rows (wide, skewed) and many precise ones (narrow): means as on 40 nodes an axis laid by hand."""
    rng = np.random.default_rng(3)
    domain = hsgp.Domain(2, 2, 0.5, 0.75, 0.5, 0.75)
    x = rng.random((n, 2))
    phi = domain.basis(x[:, 0], x[:, 1])
    y = phi @ np.array([2.0, -1.0, 0.5, 0.3]) + noise * rng.normal(size=n)
    model = hsgp.Fit(domain, phi.T @ phi, phi.T @ y, float(y @ y), n)
    got = means_of(spark, model, 8)
    value = hsgp._log_posterior(model)
    wide = noise * math.sqrt(0.5 / n) * 8
    axes = [np.linspace(math.log(0.02), math.log(30.0), 40), np.linspace(math.log(0.03), math.log(60.0), 40),
            np.linspace(math.log(0.01), math.log(14.0), 60),
            np.linspace(math.log(0.1), math.log(9.0), 60) if n == 12 else math.log(noise) + np.linspace(-wide / noise, wide / noise, 60)]
    inner = [g.ravel() for g in np.meshgrid(axes[2], axes[3], indexing="ij")]
    grid = np.stack([[value(a, b, *inner) for b in axes[1]] for a in axes[0]])
    w = np.exp(grid - grid.max())
    w /= w.sum()
    want = [(w.sum(axis=(1, 2)) * np.exp(axes[0])).sum(), (w.sum(axis=(0, 2)) * np.exp(axes[1])).sum(),
            (w.sum(axis=(0, 1)) * np.exp(inner[0])).sum(), (w.sum(axis=(0, 1)) * np.exp(inner[1])).sum()]
    assert np.allclose(got[:4], want, rtol=0.04)
