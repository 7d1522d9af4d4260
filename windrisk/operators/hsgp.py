"""Low-rank space-time Gaussian process, fitted from one distributed pass of sums.

y ~ N(f(x), sigma^2), f a zero-mean GP with a Matern-5/2 kernel with one lengthscale per
dimension, written in m_s * m_t sine basis functions. Given the four hyper-parameters the
weights are Gaussian, so all that is needed from the data is the Gram matrix of the basis,
its product with y, y'y and n. These do not depend on the hyper-parameters: the data are
read once, and the posterior is found by quadrature over a grid that Spark evaluates.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrisk.functions.basis import phase
from windrisk.operators import quadrature
from windrisk.session import keep, small_side, store

# Basis size, boundary factor, minimum rows, and the priors
# ell_spatial ~ InvGamma(3, 0.5), ell_temporal ~ InvGamma(3, 1), eta ~ HalfNormal(3), sigma ~ HalfNormal(2).
M_SPATIAL = 5
M_TEMPORAL = 10
BOUNDARY = 1.5
MIN_ROWS = 10
PRIORS = {
    "ell_spatial": ("inverse_gamma", 3.0, 0.5),
    "ell_temporal": ("inverse_gamma", 3.0, 1.0),
    "eta": ("half_normal", 3.0),
    "sigma": ("half_normal", 2.0),
}
PARAMS = list(PRIORS)

# Box of the first scan; eta and sigma are scaled by the root mean square of the data, but never beyond what the priors allow.
FIRST_BOX = {"ell_spatial": (0.02, 8.0), "ell_temporal": (0.02, 16.0), "eta": (0.05, 16.0), "sigma": (0.02, 2.0)}
# The posterior counts inside these limits only; data without noise would pull sigma to 0.
LIMITS = {"ell_spatial": (1e-3, 1e4), "ell_temporal": (1e-3, 1e4), "eta": (1e-4, 60.0), "sigma": (1e-4, 60.0)}
GRID_POINTS = 16


@dataclass(frozen=True)
class Domain:
    """Centre and half-length of the basis interval in each dimension."""
    m_spatial: int
    m_temporal: int
    center_s: float
    length_s: float
    center_t: float
    length_t: float

    @property
    def size(self) -> int:
        return self.m_spatial * self.m_temporal

    def frequencies(self) -> tuple[np.ndarray, np.ndarray]:
        """Angular frequency of every tensor-product basis function, per dimension."""
        ws = np.pi * np.arange(1, self.m_spatial + 1) / (2.0 * self.length_s)
        wt = np.pi * np.arange(1, self.m_temporal + 1) / (2.0 * self.length_t)
        return np.repeat(ws, self.m_temporal), np.tile(wt, self.m_spatial)

    def basis(self, x_s: np.ndarray, x_t: np.ndarray) -> np.ndarray:
        """(rows, size) matrix of basis values."""
        s = _sines(x_s, self.m_spatial, self.center_s, self.length_s)
        t = _sines(x_t, self.m_temporal, self.center_t, self.length_t)
        return (s[:, :, None] * t[:, None, :]).reshape(len(s), -1)


@dataclass(frozen=True)
class Fit:
    """Sums over all observations; their size depends on the basis only, never on the data."""
    domain: Domain
    gram: np.ndarray
    proj: np.ndarray
    yy: float
    n: int
    y_mean: float = 0.0


def _sines(x, m: int, center: float, length: float) -> np.ndarray:
    angle = (np.asarray(x, dtype=float) - center + length) * (np.pi / (2.0 * length))
    return np.sin(angle[:, None] * np.arange(1, m + 1)) / math.sqrt(length)


def enough_rows(snaps: DataFrame, minimum: int = MIN_ROWS) -> bool:
    """False when the table is too small to fit."""
    return snaps.limit(minimum).count() >= minimum


def interval(low: float, high: float, c: float = BOUNDARY) -> tuple[float, float]:
    """Centre and half-length of a basis interval, `c` times as long as the data."""
    half = (high - low) / 2.0
    return (low + high) / 2.0, c * (half if half > 0 else 1.0)


def domain_of(features: DataFrame, m_spatial: int = M_SPATIAL, m_temporal: int = M_TEMPORAL,
              c: float = BOUNDARY) -> Domain:
    """Interval around the data: centred at mid-range, `c` times the half-range long."""
    ends = features.agg(F.min("x_s").alias("s0"), F.max("x_s").alias("s1"),
                        F.min("x_t").alias("t0"), F.max("x_t").alias("t1")).first()
    return Domain(m_spatial, m_temporal, *interval(ends.s0, ends.s1, c), *interval(ends.t0, ends.t1, c))


def zone_sums(features: DataFrame, domain: Domain, y: Column | None = None, by: Sequence[str] = ("x_s",)) -> DataFrame:
    """The only pass over the observations: trigonometric sums per spatial coordinate, or per other keys.

    The basis is a product, and sin(bu) sin(du) = (cos((b-d)u) - cos((b+d)u)) / 2, so the
    m^2 Gram sums of a zone follow from 2 m_t cosine sums and m_t sine sums. All are plain
    aggregates: generated code, combined before the shuffle, one small row per zone.
    """
    y = F.col("y") if y is None else y
    angle = phase(F.col("x_t"), domain.center_t, domain.length_t)
    rows = features.select(*by, angle.alias("u"), y.alias("y")).dropna()
    cosines = [F.sum(F.cos(F.col("u") * F.lit(float(k)))).alias(f"c{k}") for k in range(1, 2 * domain.m_temporal + 1)]
    sines = [F.sum(F.col("y") * F.sin(F.col("u") * F.lit(float(k)))).alias(f"s{k}")
             for k in range(1, domain.m_temporal + 1)]
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("y_sum"), F.sum(F.col("y") * F.col("y")).alias("yy"),
        *cosines, *sines)


def sufficient_statistics(features: DataFrame, domain: Domain, y: Column | None = None) -> DataFrame:
    """Long form (part, i, j, value): 'gram' (upper triangle), 'proj', 'yy', 'n'."""
    return expand_sums(zone_sums(features, domain, y), domain)


def expand_sums(sums: DataFrame, domain: Domain) -> DataFrame:
    """Sufficient statistics from zone sums.

    They are expanded by the spatial basis task by task; what is shuffled is m^2 numbers per task.
    """
    m, mt = domain.size, domain.m_temporal
    up_i, up_j = np.triu_indices(m)
    b = np.arange(1, mt + 1)
    near, far = np.abs(b[:, None] - b[None, :]), b[:, None] + b[None, :]
    cos_names = ["n"] + [f"c{k}" for k in range(1, 2 * mt + 1)]
    sin_names = [f"s{k}" for k in range(1, mt + 1)]

    def expand(batches):
        gram, proj, yy, n = np.zeros((m, m)), np.zeros(m), 0.0, 0
        for batch in batches:
            space = _sines(batch["x_s"], domain.m_spatial, domain.center_s, domain.length_s)
            cosine = batch[cos_names].to_numpy(dtype=float)
            sine = batch[sin_names].to_numpy(dtype=float)
            time = (cosine[:, near] - cosine[:, far]) / (2.0 * domain.length_t)
            gram += np.einsum("ka,kc,kbd->abcd", space, space, time, optimize=True).reshape(m, m)
            proj += np.einsum("ka,kb->ab", space, sine).reshape(m) / math.sqrt(domain.length_t)
            yy += float(batch["yy"].sum())
            n += int(batch["n"].sum())
        yield pd.DataFrame({
            "part": ["gram"] * len(up_i) + ["proj"] * m + ["yy", "n"],
            "i": np.concatenate([up_i, np.arange(m), [0, 0]]).astype("int32"),
            "j": np.concatenate([up_j, np.zeros(m + 2, dtype=int)]).astype("int32"),
            "value": np.concatenate([gram[up_i, up_j], proj, [yy, n]])})

    return (sums.mapInPandas(expand, "part string, i int, j int, value double")
            .groupBy("part", "i", "j").agg(F.sum("value").alias("value")))


def fit(features: DataFrame, m_spatial: int = M_SPATIAL, m_temporal: int = M_TEMPORAL, c: float = BOUNDARY,
        center_y: bool = False) -> Fit:
    """Collect the sufficient statistics: m^2/2 + m + 2 numbers, whatever the number of rows.

    `center_y=False` keeps the zero-mean model, whose forecasts drift to 0 m/s far ahead.
    """
    domain = domain_of(features, m_spatial, m_temporal, c)
    mean = features.agg(F.avg("y")).first()[0] if center_y else 0.0
    y = F.col("y") - F.lit(float(mean)) if center_y else None
    return fit_of(sufficient_statistics(features, domain, y), domain, mean)


def fit_of(statistics: DataFrame, domain: Domain, mean: float = 0.0) -> Fit:
    """The sufficient statistics, collected."""
    m = domain.size
    gram, proj, scalars = np.zeros((m, m)), np.zeros(m), {}
    for part, i, j, value in statistics.collect():
        if part == "gram":
            gram[i, j] = gram[j, i] = value
        elif part == "proj":
            proj[i] = value
        else:
            scalars[part] = value
    return Fit(domain, gram, proj, scalars["yy"], int(scalars["n"]), float(mean))


def spectral_root(domain: Domain, ell_s: float, ell_t: float) -> np.ndarray:
    """Square roots of the unit-variance Matern-5/2 spectral density at every basis function."""
    ws, wt = domain.frequencies()
    density = (10.0 * np.pi * 5.0 ** 2.5 * ell_s * ell_t
               * (5.0 + (ell_s * ws) ** 2 + (ell_t * wt) ** 2) ** -3.5)
    return np.sqrt(density)


def _log_prior(name: str, x: np.ndarray) -> np.ndarray:
    kind, *args = PRIORS[name]
    if kind == "inverse_gamma":
        shape, scale = args
        return shape * math.log(scale) - math.lgamma(shape) - (shape + 1) * np.log(x) - scale / x
    (scale,) = args
    return 0.5 * math.log(2.0 / math.pi) - math.log(scale) - x * x / (2.0 * scale * scale)


def log_evidence(model: Fit, ell_s: float, ell_t: float, eta: np.ndarray, sigma: np.ndarray) -> np.ndarray:
    """log p(y | theta) for one pair of lengthscales and arrays of eta and sigma.

    One eigendecomposition serves every (eta, sigma): they only rescale the eigenvalues.
    """
    root = spectral_root(model.domain, ell_s, ell_t)
    values, vectors = np.linalg.eigh(root[:, None] * model.gram * root[None, :])
    values = np.maximum(values, 0.0)
    along = (vectors.T @ (root * model.proj)) ** 2
    ratio = (eta / sigma) ** 2
    gain = 1.0 + ratio[:, None] * values[None, :]
    explained = ratio * (along[None, :] / gain).sum(axis=1)
    return -0.5 * ((model.yy - explained) / sigma ** 2 + np.log(gain).sum(axis=1)
                   + 2.0 * model.n * np.log(sigma) + model.n * math.log(2.0 * math.pi))


def _log_posterior(model: Fit) -> quadrature.LogDensity:
    """Log posterior density in log space, hence the Jacobian x of each parameter."""
    def value(z1: float, z2: float, z3: np.ndarray, z4: np.ndarray) -> np.ndarray:
        ell_s, ell_t, eta, sigma = np.exp(z1), np.exp(z2), np.exp(z3), np.exp(z4)
        prior = (_log_prior("ell_spatial", ell_s) + z1 + _log_prior("ell_temporal", ell_t) + z2
                 + _log_prior("eta", eta) + z3 + _log_prior("sigma", sigma) + z4)
        return log_evidence(model, ell_s, ell_t, eta, sigma) + prior

    return value


def log_posterior(params: DataFrame, model: Fit) -> DataFrame:
    """`params` (one column per hyper-parameter) with `log_post`, the log posterior density in log space up to a constant."""
    value = _log_posterior(model)

    def evaluate(batches):
        for batch in batches:
            logs = np.log(batch[PARAMS].to_numpy(dtype=float))
            yield batch.assign(log_post=[float(value(a, b, np.array([c]), np.array([d]))[0]) for a, b, c, d in logs])

    return params.select(*PARAMS).mapInPandas(evaluate, ", ".join(f"{p} double" for p in PARAMS) + ", log_post double")


def _boxes(model: Fit) -> tuple[quadrature.Limits, quadrature.Limits]:
    """Box of the first scan and outer limits, in log space; eta and sigma in units of the data's root mean square."""
    scale = math.sqrt(model.yy / max(model.n, 1)) or 1.0
    box = dict(FIRST_BOX)
    box["sigma"] = tuple(min(b * scale, 12.0 * b) for b in FIRST_BOX["sigma"])
    box["eta"] = tuple(min(b * scale, b) for b in FIRST_BOX["eta"])
    limits = dict(LIMITS)
    for p in ("eta", "sigma"):
        limits[p] = (LIMITS[p][0] * min(1.0, scale), max(LIMITS[p][1], 10.0 * scale))
    return [tuple(np.log(box[p])) for p in PARAMS], [tuple(np.log(limits[p])) for p in PARAMS]


def hyper_posterior(spark: SparkSession, model: Fit, points: int = GRID_POINTS) -> DataFrame:
    """Weighted nodes over the hyper-parameters, one row per node; weights sum to one.

    `points` nodes an axis to begin with; cells are refined where weight lies, in a bounded number of rounds. `error` is the
    estimated relative error of the integral, the same in every row.
    """
    box, limits = _boxes(model)
    log_post = _log_posterior(model)
    found = quadrature.integrate(spark, log_post, box, limits, points)
    rows = store(quadrature.nodes(spark, found, log_post, limits, PARAMS), "nodes")
    weight = F.exp(F.col("log_post") + F.col("log_share") - F.lit(found.top))
    total = rows.agg(F.sum(weight)).first()[0]
    return rows.withColumn("weight", weight / F.lit(total)).drop("log_share").withColumn("error", F.lit(found.error))


def hyper_draws(posterior: DataFrame, n_samples: int, seed: int = 42) -> DataFrame:
    """`n_samples` equally weighted draws (sample_id, four parameters) by systematic resampling.

    Every node takes the sample ids that fall in its slice of cumulated weight: sums per
    lengthscale pair give the offset, a window inside the pair the rest. Ids are spread
    over the grid by a fixed permutation, so any prefix of them is a fair sample too.
    """
    pairs = posterior.groupBy("pair").agg(F.sum("weight").alias("in_pair"))
    before = Window.orderBy("pair").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pairs.select("pair", F.coalesce(F.sum("in_pair").over(before), F.lit(0.0)).alias("offset"))
    inside = Window.partitionBy("pair").orderBy("node")
    upto = F.sum("weight").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    prior = F.coalesce(F.sum("weight").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    shift = F.lit(np.random.default_rng(seed).random())
    stride = next(k for k in range(int(n_samples * 0.618) + 1, 2 * n_samples + 2) if math.gcd(k, n_samples) == 1)
    n = F.lit(float(n_samples))
    placed = (posterior.withColumn("lo", prior).withColumn("hi", upto).join(offsets, "pair")
              .withColumn("first", F.ceil((F.col("lo") + F.col("offset")) * n - shift))
              .withColumn("last", F.ceil((F.col("hi") + F.col("offset")) * n - shift) - 1))
    # Rounding of the cumulated weight may leave the ends a hair short of 0 or 1.
    slots = placed.where(F.col("last") >= F.col("first")).withColumn("slot", F.explode(F.sequence("first", "last")))
    return (slots.where((F.col("slot") >= 0) & (F.col("slot") < n_samples))
            .select(F.pmod(F.col("slot") * F.lit(stride), F.lit(n_samples)).cast("int").alias("sample_id"), *PARAMS))


def long_draws(draws: DataFrame, n_chains: int = 1) -> DataFrame:
    """(chain, draw, param, value), samples dealt to chains in turn."""
    pairs = F.explode(F.array(*[F.struct(F.lit(p).alias("param"), F.col(p).alias("value")) for p in PARAMS])).alias("p")
    return draws.select(
        F.pmod("sample_id", F.lit(n_chains)).cast("int").alias("chain"),
        F.floor(F.col("sample_id") / F.lit(n_chains)).cast("int").alias("draw"), pairs).select("chain", "draw", "p.*")


def concat_chains(chains: Sequence[DataFrame]) -> DataFrame:
    """Separate chain tables (draw, param, value) stacked under a new `chain` key."""
    if not chains:
        raise ValueError("no chains")
    out = None
    for number, chain in enumerate(chains):
        tagged = chain.withColumn("chain", F.lit(number))
        out = tagged if out is None else out.unionByName(tagged)
    return out.select("chain", "draw", "param", "value")


def weight_draws(draws: DataFrame, model: Fit, seed: int = 42) -> DataFrame:
    """Basis weights of each hyper-parameter draw: (sample_id, sigma, weights ARRAY<DOUBLE>).

    weights = D beta with beta ~ N(A^-1 u / sigma^2, A^-1), A = I + D G D / sigma^2, u = D r.
    """
    gram, proj, domain = model.gram, model.proj, model.domain

    def sample(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                d = row.eta * spectral_root(domain, row.ell_spatial, row.ell_temporal)
                a = np.eye(domain.size) + d[:, None] * gram * d[None, :] / row.sigma ** 2
                lower = np.linalg.cholesky(a)
                half = np.linalg.solve(lower, d * proj / row.sigma ** 2)
                noise = np.random.default_rng([seed, int(row.sample_id)]).standard_normal(domain.size)
                out.append(d * np.linalg.solve(lower.T, half + noise))
            yield pd.DataFrame({"sample_id": batch["sample_id"], "sigma": batch["sigma"], "weights": out})

    return draws.mapInPandas(sample, "sample_id int, sigma double, weights array<double>")


def predictive(points: DataFrame, weights: DataFrame, model: Fit, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Predictive draws (keys..., sample_id, value) at every row of `points` (x_s, x_t).

    The weights are n_samples * m numbers, set by arguments, and go out with the task; the
    points may be as many as the observations and stay distributed. All points share the
    weights of a sample, which keeps the dependence between zones; the noise of a point
    is seeded by its own keys, so a rerun of a lost task gives the same rows.
    """
    rows = sorted(weights.collect(), key=lambda r: r.sample_id)
    sample_ids = np.array([r.sample_id for r in rows], dtype="int32")
    coefficients = np.array([r.weights for r in rows])
    sigma = np.array([r.sigma for r in rows])
    domain, mean, keys = model.domain, model.y_mean, list(keys)
    fields = {f.name: f.dataType.simpleString() for f in points.schema.fields}
    schema = ", ".join([f"{k} {fields[k]}" for k in keys] + ["sample_id int", "value double"])

    def draw(batches):
        for batch in batches:
            # A few thousand numbers per slice, however large the Arrow batch is.
            for start in range(0, len(batch), 512):
                part = batch.iloc[start:start + 512]
                f = domain.basis(part["x_s"], part["x_t"]) @ coefficients.T
                noise = np.stack([np.random.default_rng([seed, h & 0x7FFFFFFFFFFFFFFF]).standard_normal(len(sigma))
                                  for h in part["noise_key"]])
                value = mean + f + noise * sigma
                out = part[keys].loc[part.index.repeat(len(sigma))].reset_index(drop=True)
                yield out.assign(sample_id=np.tile(sample_ids, len(part)), value=value.ravel())

    keyed = points.select(*keys, "x_s", "x_t", F.xxhash64(*keys).alias("noise_key"))
    return keyed.mapInPandas(draw, schema)


def no_model_draws(points: DataFrame, n_samples: int, keys: Sequence[str]) -> DataFrame:
    """Without a model every draw is NaN."""
    ids = F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))).alias("sample_id")
    return points.select(*keys, ids).withColumn("value", F.lit(float("nan")))


def fixed_count(draws: DataFrame, n_samples: int, group: str = "horizon_h", seed: int = 42) -> DataFrame:
    """Exactly `n_samples` scenarios per group: the first ones, or a bootstrap if there are too few.

    Whole scenarios are kept or repeated, so all zones of a scenario stay together.
    """
    scenarios = draws.select(group, "sample_id").distinct()
    order = Window.partitionBy(group).orderBy("sample_id")
    # A literal limit on row_number lets every task drop surplus ids before the shuffle.
    first = keep(scenarios.withColumn("slot", F.row_number().over(order)).where(F.col("slot") <= n_samples))
    have = first.groupBy(group).agg(F.count(F.lit(1)).alias("have"))
    slots = have.select(group, "have", F.explode(F.sequence(F.lit(1), F.lit(n_samples))).alias("new_id"))
    picked = slots.select(
        group, (F.col("new_id") - 1).alias("new_id"),
        F.when(F.col("have") == n_samples, F.col("new_id"))
        .otherwise(F.pmod(F.xxhash64(group, "new_id", F.lit(seed)), F.col("have")) + 1).alias("slot"))
    # n_samples rows per group: with few groups the draws are not shuffled at all.
    chosen = small_side(picked.join(first, [group, "slot"]).select(group, "sample_id", "new_id"))
    others = [c for c in draws.columns if c not in (group, "sample_id")]
    return draws.join(chosen, [group, "sample_id"]).select(group, F.col("new_id").alias("sample_id"), *others)
