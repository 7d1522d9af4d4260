"""Model coordinates: zone index, scaled time, and horizon points."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrisk.functions.timefn import hours_between
from windrisk.schemas import HORIZONS, TEMPORAL_SCALE_H
from windrisk.session import keep, small_side


def zone_index(snaps: DataFrame) -> DataFrame:
    """Dense 0-based index of the sorted zones, and their number; one row per zone.

    The global window runs over the distinct zones only, never over observations.
    """
    zones = keep(snaps.select("region_id").dropna().distinct())
    order = Window.orderBy("region_id")
    return small_side(zones.select(
        "region_id",
        (F.row_number().over(order) - 1).alias("zone_idx"),
        F.count(F.lit(1)).over(Window.partitionBy()).cast("int").alias("n_zones")))


def spatial_coordinate() -> Column:
    """Zone index scaled to [0, 1]."""
    return F.col("zone_idx") / F.greatest(F.col("n_zones") - 1, F.lit(1)).cast("double")


def elapsed_hours(snaps: DataFrame) -> DataFrame:
    """Hours since the first timestamp of the table."""
    first = snaps.agg(F.min("timestamp").alias("t_min")).scalar()
    return snaps.withColumn("hours", hours_between(first, F.col("timestamp")))


def features(snaps: DataFrame, temporal_scale_h: float = TEMPORAL_SCALE_H, index: DataFrame | None = None) -> DataFrame:
    """(timestamp, region_id, x_s in [0, 1], x_t in scaled hours, y)."""
    index = zone_index(snaps) if index is None else index
    return (elapsed_hours(snaps).join(index, "region_id")
            .select("timestamp", "region_id",
                    spatial_coordinate().alias("x_s"),
                    (F.col("hours") / F.lit(temporal_scale_h)).alias("x_t"),
                    F.col("wind_speed_mps").alias("y")))


def horizon_points(snaps: DataFrame, horizons: Sequence[int] = HORIZONS,
                   temporal_scale_h: float = TEMPORAL_SCALE_H, index: DataFrame | None = None) -> DataFrame:
    """Every zone at every horizon after the last observation, in model coordinates."""
    index = zone_index(snaps) if index is None else index
    ends = snaps.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    first, last = ends.select("lo").scalar(), ends.select("hi").scalar()
    hours = F.explode(F.array(*[F.lit(h) for h in horizons]))
    spread = index.select("region_id", "zone_idx", "n_zones", hours.alias("horizon_h"))
    ahead = F.make_dt_interval(F.lit(0), F.col("horizon_h"))
    return spread.select(
        (last + ahead).alias("timestamp"), "region_id", "horizon_h",
        spatial_coordinate().alias("x_s"),
        ((hours_between(first, last) + F.col("horizon_h")) / F.lit(temporal_scale_h)).alias("x_t"))
