"""Predictive draws to tail risk, CVaR, quantiles, forecasts and alerts.

`draws` is long: (horizon_h, sample_id, region_id, value). A NaN value is a missing draw, as NULL is:
it counts in no share, mean or quantile, and a zone with missing draws only keeps its row with NULL measures.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrisk.functions.timefn import not_nan
from windrisk.operators import ranks
from windrisk.schemas import ALERT_PROBABILITY, AT_RISK_PROBABILITY, CVAR_ALPHA, FORECAST, QUANTILES, THRESHOLD_MPS
from windrisk.session import settle, small_side

ZONE = ["horizon_h", "region_id"]
SCENARIO = ["horizon_h", "sample_id"]


def shortfall(value: Column, threshold: float = THRESHOLD_MPS) -> Column:
    """How far below the threshold; never negative; NULL for a missing draw."""
    return F.when(value < F.lit(threshold), F.lit(threshold) - value).when(value.isNotNull(), F.lit(0.0))


def _known(draws: DataFrame) -> DataFrame:
    return draws.withColumn("value", not_nan(F.col("value")))


def tail_risk(draws: DataFrame, threshold: float = THRESHOLD_MPS) -> DataFrame:
    """Share of draws strictly below the threshold, per horizon and zone."""
    return _known(draws).groupBy(*ZONE).agg(
        F.avg((F.col("value") < F.lit(threshold)).cast("double")).alias("p_shortfall"))


def scenario_totals(draws: DataFrame, threshold: float = THRESHOLD_MPS) -> DataFrame:
    """Shortfall of one draw summed over all zones."""
    return _known(draws).groupBy(*SCENARIO).agg(F.sum(shortfall(F.col("value"), threshold)).alias("total"))


def tail_scenarios(draws: DataFrame, threshold: float = THRESHOLD_MPS, alpha: float = CVAR_ALPHA,
                   in_memory_rows: int = ranks.IN_MEMORY_ROWS) -> DataFrame:
    """The worst alpha share of scenarios of each horizon; ties at the cutoff stay in.

    Totals are sums of floating numbers, so they are stored once: cutoff and comparison
    must see the very same bits.
    """
    totals = settle(scenario_totals(draws, threshold))
    cutoffs = small_side(ranks.kth_largest(totals, ["horizon_h"], "total", alpha, in_memory_rows=in_memory_rows))
    return (totals.join(cutoffs, "horizon_h")
            .where(F.col("total") >= F.col("cutoff"))
            .select(*SCENARIO, "total"))


def cvar(draws: DataFrame, threshold: float = THRESHOLD_MPS, alpha: float = CVAR_ALPHA,
         in_memory_rows: int = ranks.IN_MEMORY_ROWS) -> DataFrame:
    """Mean zone shortfall over the tail scenarios."""
    # A short tail is broadcast, and the draws are only scanned; a long one is shuffled.
    tail = small_side(tail_scenarios(draws, threshold, alpha, in_memory_rows).select(*SCENARIO))
    return (_known(draws).join(tail, SCENARIO, "left_semi")
            .groupBy(*ZONE)
            .agg(F.avg(shortfall(F.col("value"), threshold)).alias("cvar_shortfall")))


def quantiles(draws: DataFrame, probabilities: Sequence[float] = QUANTILES, prefix: str = "wind_p",
              in_memory_rows: int = ranks.IN_MEMORY_ROWS) -> DataFrame:
    return ranks.quantiles(draws, ZONE, "value", probabilities, prefix, in_memory_rows)


def forecasts(draws: DataFrame, threshold: float = THRESHOLD_MPS, alpha: float = CVAR_ALPHA,
              issued_for: Column | None = None) -> DataFrame:
    """The forecast table: tail risk, CVaR and quantiles per horizon and zone.

    `issued_for` gives the forecast timestamp, e.g. the last observation plus the horizon.
    """
    # Tail risk rides along on the pass for the quantiles.
    below = F.avg((F.col("v") < F.lit(threshold)).cast("double"))
    bands = ranks.quantiles(draws, ZONE, "value", QUANTILES, "wind_p", extra={"p_shortfall": below})
    zones = draws.select(*ZONE).dropna().distinct()
    out = zones.join(bands, ZONE, "left").join(cvar(draws, threshold, alpha), ZONE, "left")
    stamp = F.lit(None).cast("timestamp") if issued_for is None else issued_for
    typed = out.withColumn("timestamp", stamp)
    return typed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FORECAST])


def alerts(table: DataFrame, threshold: float = ALERT_PROBABILITY) -> DataFrame:
    """Forecast rows at or above the alert probability; none if the column is absent."""
    if "p_shortfall" not in table.columns:
        return table.limit(0)
    return table.where(F.col("p_shortfall") >= F.lit(threshold))


def alert_records(table: DataFrame, threshold: float = ALERT_PROBABILITY) -> DataFrame:
    """One message per alert."""
    found = alerts(table, threshold)
    if "p_shortfall" not in found.columns:
        return found
    message = F.format_string("Risk alert: region=%s horizon_h=%s p_shortfall=%.3f",
                              "region_id", F.col("horizon_h").cast("string"), "p_shortfall")
    return found.select("region_id", "horizon_h", "p_shortfall", message.alias("message"))


def at_risk(table: DataFrame, threshold: float = AT_RISK_PROBABILITY) -> DataFrame:
    """Rows strictly above the at-risk probability, with a label."""
    label = F.concat(F.col("region_id"), F.lit(" @ +"), F.col("horizon_h").cast("string"), F.lit("h"))
    return table.where(F.col("p_shortfall") > F.lit(threshold)).withColumn("label", label)


def joint_drought(draws: DataFrame, min_zones: int, threshold: float = THRESHOLD_MPS) -> DataFrame:
    """Share of draws in which at least `min_zones` zones are below the threshold together."""
    below = _known(draws).groupBy(*SCENARIO).agg(F.count_if(F.col("value") < F.lit(threshold)).alias("n_below"))
    return below.groupBy("horizon_h").agg(
        F.avg((F.col("n_below") >= F.lit(min_zones)).cast("double")).alias("p_joint"))
