"""Zone-hour snapshots, droughts, scaffolds and price regimes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrisk.functions.timefn import hour_of, hours_between, not_nan
from windrisk.schemas import PRICE_SPIKE_EUR, THRESHOLD_MPS


def clean(obs: DataFrame) -> DataFrame:
    """Null keys dropped, NaN measures turned into NULL."""
    return (obs.select("timestamp", "region_id", not_nan(F.col("wind_speed_mps")).alias("wind_speed_mps"))
            .dropna(subset=["timestamp", "region_id"]))


def snapshots(obs: DataFrame, hourly: bool = False) -> DataFrame:
    """Mean wind per (timestamp, zone): at the exact timestamp, or per clock hour."""
    rows = clean(obs)
    if hourly:
        rows = rows.withColumn("timestamp", hour_of(F.col("timestamp")))
    return rows.groupBy("timestamp", "region_id").agg(F.avg("wind_speed_mps").alias("wind_speed_mps"))


def extent(obs: DataFrame) -> DataFrame:
    """Rows, zones, timesteps and the covered span, as one row."""
    return obs.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("region_id").alias("n_zones"),
        F.countDistinct("timestamp").alias("n_timesteps"))


def span(obs: DataFrame) -> DataFrame:
    """First and last timestamp and the hours between them, as one row."""
    ends = obs.agg(F.min("timestamp").alias("t_min"), F.max("timestamp").alias("t_max"))
    return ends.withColumn("span_hours", hours_between(F.col("t_min"), F.col("t_max")))


def zone_list(obs: DataFrame) -> DataFrame:
    """Distinct zones in order."""
    return obs.select("region_id").dropna().distinct().orderBy("region_id")


def drought_flags(snaps: DataFrame, threshold: float = THRESHOLD_MPS) -> DataFrame:
    """Per timestamp: is any zone below the threshold, and how many are."""
    below = F.col("wind_speed_mps") < F.lit(threshold)
    return (snaps.groupBy("timestamp")
            .agg(F.coalesce(F.bool_or(below), F.lit(False)).alias("is_drought"),
                 F.count_if(below).alias("zones_below"),
                 F.count(F.lit(1)).alias("n_zones")))


def share_below(obs: DataFrame, threshold: float = THRESHOLD_MPS, by: tuple[str, ...] = ("region_id",)) -> DataFrame:
    """Fraction of observations below the cut-in speed."""
    share = F.avg((F.col("wind_speed_mps") < F.lit(threshold)).cast("double"))
    return obs.groupBy(*by).agg(share.alias("share_below"), F.count(F.lit(1)).alias("n_rows"))


def hour_scaffold(obs: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Every hour of the covered span for every zone, both ends included.

    The span is a scalar subquery; each zone row grows its own hours, so nothing is cross-joined.
    """
    zones = obs.select("region_id").dropna().distinct() if zones is None else zones.select("region_id")
    hours = obs.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    first = hours.select(F.date_trunc("hour", "lo")).scalar()
    last = hours.select(F.date_trunc("hour", "hi")).scalar()
    return zones.select(F.explode(F.sequence(first, last, F.expr("interval 1 hour"))).alias("timestamp"), "region_id")


def fill_scaffold(scaffold: DataFrame, snaps: DataFrame) -> DataFrame:
    """Snapshots on the full calendar; missing hours are NULL."""
    return scaffold.join(snaps, ["timestamp", "region_id"], "left")


def in_drought(rows: DataFrame, flags: DataFrame) -> DataFrame:
    """Rows whose timestep is a drought timestep."""
    return rows.join(flags.where("is_drought").select("timestamp"), "timestamp", "left_semi")


def price_regimes(prices: DataFrame, flags: DataFrame, spike: float = PRICE_SPIKE_EUR) -> DataFrame:
    """Spike share and mean price in and out of drought timesteps."""
    droughts = flags.where("is_drought").select("timestamp", F.lit(True).alias("is_drought"))
    return (prices.join(droughts, "timestamp", "left")
            .groupBy(F.coalesce("is_drought", F.lit(False)).alias("is_drought"))
            .agg(F.avg((F.col("price_eur_mwh") > F.lit(spike)).cast("double")).alias("spike_share"),
                 F.avg("price_eur_mwh").alias("mean_price"),
                 F.count(F.lit(1)).alias("n_rows")))


def published(column: Column, places: int = 4, half_even: bool = False) -> Column:
    """Measures as stored: 4 places for wind, 2 for prices."""
    return F.bround(column, places) if half_even else F.round(column, places)


def observed_rows(df: DataFrame, name: str = "written"):
    """`df` with a row counter that fills while it is written, instead of a second count job."""
    from pyspark.sql import Observation
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen
