"""Convergence, calibration and matrix diagnostics, as (key, value) metric rows."""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrisk.functions.normal import normal_quantile
from windrisk.operators import ranks
from windrisk.operators.spatial import frobenius
from windrisk.session import keep, small_side, store

# Convergence windows, thresholds and quality gates.
ELBO_WINDOW = 500
ELBO_TOLERANCE = 0.01
DRIFT_MIN_POINTS = 40
DRIFT_SHARE = 0.05
DRIFT_WARNING = 1e-3
RHAT_GATE = 1.01
ESS_GATE = 400.0


# --- ELBO -----------------------------------------------------------------------------

def last_points(history: DataFrame, n: int) -> DataFrame:
    """The last `n` points of every run. The limit is literal, so tasks drop the rest before the shuffle."""
    newest = Window.partitionBy("run_id").orderBy(F.col("iter").desc())
    return history.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= n)


def elbo_converged(history: DataFrame, window: int = ELBO_WINDOW) -> DataFrame:
    """Per run: last value, and whether the spread of the last window is under 1 % of its mean.

    Runs shorter than two windows have not converged.
    """
    sizes = history.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_points"), F.max_by("elbo", "iter").alias("elbo_final"))
    recent = last_points(history, window).groupBy("run_id").agg(
        F.stddev_pop("elbo").alias("sd"), F.avg("elbo").alias("mean"))
    stable = F.col("sd") < F.abs("mean") * F.lit(ELBO_TOLERANCE)
    return sizes.join(recent, "run_id").select(
        "run_id", "n_points", "elbo_final", "sd", "mean",
        ((F.col("n_points") >= 2 * window) & stable).alias("elbo_converged"))


def elbo_drift(history: DataFrame, in_memory_rows: int = ranks.IN_MEMORY_ROWS) -> DataFrame:
    """Mean of the last 5 % of each run against the 5 % before it.

    The two cut points are order statistics of the iteration number, so a long run is
    never sorted in one task. Runs under 40 points have no verdict.
    """
    tail = lambda n: F.greatest(F.lit(1), F.floor(n * F.lit(DRIFT_SHARE)))
    cuts = small_side(ranks.pick_ranks(history, ["run_id"], "iter", [
        ranks.Pick("last", lambda n: n - tail(n), lambda n: n - tail(n)),
        ranks.Pick("previous", lambda n: F.greatest(n - 2 * tail(n), F.lit(0)), lambda n: F.greatest(n - 2 * tail(n), F.lit(0))),
    ], in_memory_rows))
    newest = F.col("iter") >= F.col("last_lo")
    means = (history.join(cuts, "run_id")
             .where((F.col("iter") >= F.col("previous_lo")) & (F.col("n") >= DRIFT_MIN_POINTS))
             .groupBy("run_id")
             .agg(F.avg(F.when(newest, F.col("elbo"))).alias("last_mean"),
                  F.avg(F.when(~newest, F.col("elbo"))).alias("prev_mean")))
    drift = F.abs(F.col("last_mean") - F.col("prev_mean")) / (F.abs("prev_mean") + F.lit(1e-9))
    return (means.withColumn("rel_delta", drift)
            .withColumn("still_improving", F.col("rel_delta") > F.lit(DRIFT_WARNING)))


# --- Chains ---------------------------------------------------------------------------
# A chain table is (chain, draw, param, value); draws of a chain are numbered 0 .. n-1.

def split_chains(chains: DataFrame) -> DataFrame:
    """Each chain cut into two halves of equal length; an odd middle draw is left out.

    Halves follow from the draw number and the chain length, without ordering anything.
    """
    lengths = small_side(chains.groupBy("param", "chain").agg(F.count(F.lit(1)).alias("n")))
    half = F.floor(F.col("n") / 2)
    return (chains.join(lengths, ["param", "chain"])
            .withColumn("half", F.when(F.col("draw") < half, F.lit(0)).when(F.col("draw") >= F.col("n") - half, F.lit(1)))
            .where(F.col("half").isNotNull())
            .select("param", (F.col("chain") * 2 + F.col("half")).alias("seq"),
                    (F.col("draw") - F.when(F.col("half") == 1, F.col("n") - half).otherwise(F.lit(0))).alias("pos"),
                    "value"))


def _rhat(split: DataFrame, name: str) -> DataFrame:
    """Between- and within-sequence variance of (param, seq, value), one row per param."""
    seqs = split.groupBy("param", "seq").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("var"))
    pooled = seqs.groupBy("param").agg(
        F.avg("n").alias("n"), F.var_samp("mean").alias("between"), F.avg("var").alias("within"))
    estimate = F.col("within") * (F.col("n") - 1) / F.col("n") + F.col("between")
    return pooled.select("param", F.sqrt(F.try_divide(estimate, F.col("within"))).alias(name))


def normal_scores(values: DataFrame, in_memory_rows: int = ranks.IN_MEMORY_ROWS) -> DataFrame:
    """`value` replaced by the normal quantile of its pooled average rank within the param."""
    ranked = ranks.with_average_ranks(values, ["param"], "value", in_memory_rows)
    score = normal_quantile((F.col("rank") - 0.375) / (F.col("n") + 0.25))
    return ranked.select(*[score.alias("value") if c == "value" else c for c in values.columns])


def rhat(chains: DataFrame, method: str = "rank") -> DataFrame:
    """Split R-hat per param: 'split' (plain), or 'rank' (rank-normalised, larger of bulk and folded)."""
    if method not in ("rank", "split"):
        raise ValueError(f"method must be 'rank' or 'split', got {method!r}")
    split = split_chains(chains)
    if method == "split":
        return _rhat(split, "r_hat")
    split = store(split)
    bulk = _rhat(normal_scores(split), "bulk")
    median = small_side(ranks.quantiles(split, ["param"], "value", [0.5]))
    folded = split.join(median, "param").withColumn("value", F.abs(F.col("value") - F.col("p50"))).drop("p50")
    return (bulk.join(_rhat(normal_scores(folded), "folded"), "param")
            .select("param", F.greatest("bulk", "folded").alias("r_hat")))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _lag_products(series: pd.Series, own: pd.Series, lags: pd.Series) -> pd.Series:
    """Sums x[i] x[i + k] over the block's own i, for k = 0 .. lags, by Fourier transform."""
    out = []
    for x, own_count, top in zip(series, own, lags):
        size = 1 << int(np.ceil(np.log2(len(x) + own_count + 1)))
        products = np.fft.irfft(np.conj(np.fft.rfft(x[:own_count], size)) * np.fft.rfft(x, size), size)
        padded = np.zeros(top + 1)
        usable = min(top + 1, len(x))
        padded[:usable] = products[:usable]
        out.append(padded)
    return pd.Series(out)


def autocovariance(split: DataFrame, max_lag: int, block: int = 50_000) -> DataFrame:
    """Biased autocovariance at lags 0 .. max_lag, averaged over the sequences of a param.

    Gives (param, lag, acov) plus per param the sequence length `n`, their number `m`, and
    the variance `between` of their means. A sequence is cut into blocks of consecutive
    positions, each with the `max_lag` values that follow it, so one long sequence is
    shared among many tasks, no task holds more than a block, and the sums are exact.
    """
    block = max(block, max_lag)
    center = split.groupBy("param", "seq").agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"))
    center = small_side(center)
    shape = center.groupBy("param").agg(
        F.min("n").alias("n"), F.count(F.lit(1)).alias("m"), F.coalesce(F.var_samp("mean"), F.lit(0.0)).alias("between"))
    centred = split.join(center, ["param", "seq"]).select(
        "param", "seq", "n", F.col("pos").cast("long").alias("pos"), (F.col("value") - F.col("mean")).alias("x"))
    # A position belongs to its own block and follows those that end up to max_lag before it.
    first = F.greatest(F.lit(0), F.floor((F.col("pos") - max_lag) / block))
    blocks = F.explode(F.sequence(first, F.floor(F.col("pos") / block)))
    packed = (centred.withColumn("block", blocks)
              .groupBy("param", "seq", "block")
              .agg(F.max("n").alias("n"), F.count_if(F.floor(F.col("pos") / block) == F.col("block")).cast("int").alias("own"),
                   F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("rows")))
    sums = packed.select(
        "param", "seq", "n", F.posexplode(_lag_products(F.col("rows")["x"], "own", F.lit(max_lag))).alias("lag", "s"))
    # Sequences of a param have equal length, so the mean over them is one more sum.
    return (sums.groupBy("param", "lag").agg(F.sum(F.col("s") / F.col("n")).alias("acov"))
            .join(shape, "param")
            .select("param", "lag", (F.col("acov") / F.col("m")).alias("acov"), "n", "m", "between"))


def effective_size(acov: np.ndarray, n: int, m: int, between: float) -> tuple[float, bool]:
    """Effective sample size of m sequences of length n from their mean autocovariances.

    Autocorrelations are added in pairs up to the first negative pair, never rising. The
    flag is False if the given lags end before that pair is met.
    """
    size = m * n
    within = acov[0] * n / (n - 1.0)
    total = acov[0] + between
    if not total > 0.0:
        return float(size), True
    rho = 1.0 - (within - acov[:n]) / total
    rho[0] = 1.0
    # The pair at which the sum ends counts by its even member only; the last lags have
    # too few terms to be looked at.
    last = max((n - 3) // 2, 0)
    pairs = rho[:len(rho) // 2 * 2].reshape(-1, 2).sum(axis=1)[:last + 1]
    stops = np.flatnonzero(pairs <= 0.0)
    stop = int(stops[0]) if len(stops) else len(pairs) - 1
    tau = -1.0 + 2.0 * np.minimum.accumulate(pairs[:stop]).sum() if stop else -1.0
    tau += max(rho[2 * stop], 0.0)
    return size / max(tau, 1.0 / np.log10(size)), bool(len(stops)) or len(pairs) == last + 1


@F.pandas_udf(T.StructType([T.StructField("size", T.DoubleType()), T.StructField("ended", T.BooleanType())]))
def _sizes(acov: pd.Series, n: pd.Series, m: pd.Series, between: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([effective_size(np.array(a), int(i), int(j), b) for a, i, j, b in zip(acov, n, m, between)],
                        columns=["size", "ended"])


def _ess(split: DataFrame, lags: int = 128) -> DataFrame:
    """(param, ess); the lag range grows until every param has met its last positive pair."""
    while True:
        table = (autocovariance(split, lags).groupBy("param", "n", "m", "between")
                 .agg(F.array_sort(F.collect_list(F.struct("lag", "acov"))).alias("rows")))
        found = keep(table.select("param", _sizes(F.col("rows")["acov"], "n", "m", "between").alias("e")))
        if found.where(~F.col("e.ended")).limit(1).count() == 0:
            return found.select("param", F.col("e.size").alias("ess"))
        lags *= 4


def ess(chains: DataFrame) -> DataFrame:
    """Bulk and tail ESS per param.

    Bulk: of the rank-normalised split chains. Tail: the smaller one of the two indicators
    'at or below the 5 % / 95 % quantile'. The three series of a param go through as one job.
    """
    ends = small_side(ranks.quantiles(chains, ["param"], "value", [0.05, 0.95]))
    split = store(split_chains(chains))
    with_ends = split.join(ends, "param")
    def series(rows: DataFrame, kind: str, value: Column) -> DataFrame:
        return rows.select(F.concat(F.lit(f"{kind}|"), "param").alias("param"), "seq", "pos", value.alias("value"))
    def indicator(end: str) -> Column:
        return (F.col("value") <= F.col(end)).cast("double")
    every = (series(normal_scores(split), "bulk", F.col("value"))
             .unionByName(series(with_ends, "low", indicator("p5")))
             .unionByName(series(with_ends, "high", indicator("p95"))))
    found = _ess(store(every))
    kind, name = F.substring_index("param", "|", 1), F.expr("substring(param, instr(param, '|') + 1)")
    def of(label: str) -> Column:
        return F.max(F.when(F.col("kind") == label, F.col("ess")))
    return (found.select(kind.alias("kind"), name.alias("param"), "ess").groupBy("param")
            .agg(of("bulk").alias("ess_bulk"), F.least(of("low"), of("high")).alias("ess_tail")))


def _metric(df: DataFrame, value: Column, key: str) -> DataFrame:
    return df.select(F.lit(key).alias("key"), value.cast("double").alias("value"))


def divergences(sampler_stats: DataFrame) -> DataFrame:
    """Number of divergent draws as one (key, value) row; needs no chain."""
    return _metric(sampler_stats.agg(F.count_if("diverging").alias("v")), F.col("v"), "n_divergences")


def chain_metrics(chains: DataFrame, sampler_stats: DataFrame | None = None,
                  params: Sequence[str] | None = None) -> DataFrame:
    """Number of divergent draws, worst R-hat, smallest ESS, as (key, value) rows.

    `params` limits R-hat and ESS to the named parameters.
    """
    if params is not None:
        chains = chains.where(F.col("param").isin(list(params)))
    chains = store(chains)
    out = _metric(rhat(chains).agg(F.max("r_hat").alias("v")), F.col("v"), "max_r_hat")
    sizes = keep(ess(chains))
    for name in ("ess_bulk", "ess_tail"):
        out = out.unionByName(_metric(sizes.agg(F.min(name).alias("v")), F.col("v"), f"min_{name}"))
    if sampler_stats is not None:
        out = out.unionByName(divergences(sampler_stats))
    return out


def parameter_correlation(chains: DataFrame, params: Sequence[str]) -> DataFrame:
    """Pearson correlation between parameters over all draws, (param_a, param_b, value)."""
    from windrisk.operators.correlation import correlation_matrix
    series = chains.where(F.col("param").isin(list(params))).select(
        F.struct("chain", "draw").alias("timestamp"), F.col("param").alias("region_id"),
        F.col("value").alias("wind_speed_mps"))
    return correlation_matrix(series, params).select(
        F.col("zone_a").alias("param_a"), F.col("zone_b").alias("param_b"), "value")


# --- Calibration ----------------------------------------------------------------------

def median_error(observed: DataFrame, samples: DataFrame) -> DataFrame:
    """Mean absolute error of the median forecast. `observed` (obs_id, y), `samples` (obs_id, value)."""
    median = ranks.quantiles(samples, ["obs_id"], "value", [0.5])
    return (observed.join(median, "obs_id")
            .agg(F.avg(F.abs(F.col("y") - F.col("p50"))).alias("crps_median_mae")))


def crps(observed: DataFrame, samples: DataFrame, in_memory_rows: int = ranks.IN_MEMORY_ROWS) -> DataFrame:
    """Mean continuous ranked probability score of sample forecasts. `observed` (obs_id, y), `samples` (obs_id, value).

    For n samples E|X - y| - E|X - X'| / 2, the second mean by the ranks: sum of (2 rank - n - 1) x over n^2.
    """
    ranked = ranks.with_average_ranks(samples, ["obs_id"], "value", in_memory_rows)
    spread = ranked.groupBy("obs_id").agg(
        (F.sum((2 * F.col("rank") - F.col("n") - 1) * F.col("value")) / F.first("n") / F.first("n")).alias("spread"))
    error = (samples.join(observed, "obs_id").groupBy("obs_id").agg(F.avg(F.abs(F.col("value") - F.col("y"))).alias("error")))
    return error.join(spread, "obs_id").agg(F.avg(F.col("error") - F.col("spread")).alias("crps"))


# --- Bundle ---------------------------------------------------------------------------

def run_diagnostics(spark: SparkSession, chains: DataFrame | None = None, sampler_stats: DataFrame | None = None,
                    elbo: DataFrame | None = None, correlation: DataFrame | None = None,
                    observed: DataFrame | None = None, samples: DataFrame | None = None) -> DataFrame:
    """Metrics for whichever inputs are given, as one (key, value) table. Flags are 0 / 1."""
    parts = []
    if chains is not None:
        parts.append(chain_metrics(chains, sampler_stats))
    if elbo is not None:
        verdict = elbo_converged(elbo)
        parts.append(_metric(verdict, F.col("elbo_final"), "elbo_final"))
        parts.append(_metric(verdict, F.col("elbo_converged"), "elbo_converged"))
    if correlation is not None:
        parts.append(_metric(frobenius(correlation), F.col("frobenius"), "spatial_corr_norm"))
    if observed is not None and samples is not None:
        parts.append(_metric(median_error(observed, samples), F.col("crps_median_mae"), "crps"))
    if not parts:
        return spark.createDataFrame([], "key string, value double")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def verdicts(metrics: DataFrame) -> DataFrame:
    """Pass or warn for the gated metrics: no divergences, R-hat under 1.01, ESS over 400."""
    key, value = F.col("key"), F.col("value")
    passed = (F.when(key == "n_divergences", value == 0)
              .when(key == "max_r_hat", value < F.lit(RHAT_GATE))
              .when(key.isin("min_ess_bulk", "min_ess_tail"), value > F.lit(ESS_GATE)))
    return metrics.withColumn("label", F.when(passed, F.lit("pass")).when(~passed, F.lit("warn")))
