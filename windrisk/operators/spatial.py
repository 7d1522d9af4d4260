"""Grid cells to zones, zone-hour means and zone-pair matrices."""

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrisk.functions import geo
from windrisk.functions.timefn import not_nan
from windrisk.schemas import ZONES

# Zones per slice of a pair matrix: a tile is at most about TILE * TILE rows.
TILE = 256


def assign_zone(grid: DataFrame, zones: Mapping[str, tuple[float, float]] = ZONES,
                metric: str = "degrees") -> DataFrame:
    """Every cell goes to its nearest zone, however far away; on a tie the zone listed first wins.

    The zone list is configuration, so each centroid is a pair of literals and the search is
    a projection in generated code: no join, no shuffle. Cells without a position are left out.
    """
    names, columns = list(zones), grid.columns
    lat, lon = F.col("latitude"), F.col("longitude")
    distances = [d.alias(f"__d{i}") for i, d in enumerate(geo.zone_distances(lat, lon, zones, metric))]
    placed = grid.where(not_nan(lat).isNotNull() & not_nan(lon).isNotNull()).select("*", *distances)
    closest = F.least(*[F.col(f"__d{i}") for i in range(len(names))]) if len(names) > 1 else F.col("__d0")
    placed = placed.select("*", closest.alias("__closest"))
    zone = F.lit(names[-1])
    for i in range(len(names) - 2, -1, -1):
        zone = F.when(F.col(f"__d{i}") == F.col("__closest"), F.lit(names[i])).otherwise(zone)
    return placed.select(*columns, zone.alias("region_id"))


def zone_means_per_file(grid: DataFrame, zones: Mapping[str, tuple[float, float]] = ZONES,
                        metric: str = "degrees") -> DataFrame:
    """Mean wind per (file, timestamp, zone)."""
    speed = not_nan(geo.wind_speed("u10", "v10"))
    return (assign_zone(grid, zones, metric)
            .select("file_id", "timestamp", "region_id", speed.alias("wind_speed_mps"))
            .dropna(subset=["timestamp"])
            .groupBy("file_id", "timestamp", "region_id")
            .agg(F.avg("wind_speed_mps").alias("wind_speed_mps")))


def mean_of_files(per_file: DataFrame) -> DataFrame:
    """Overlapping files: each file counts once, so this is a mean of per-file means.

    Kept apart from the per-file mean on purpose, because the weights differ.
    """
    return (per_file.groupBy("timestamp", "region_id")
            .agg(F.avg("wind_speed_mps").alias("wind_speed_mps")))


def silver_weather(grid: DataFrame, zones: Mapping[str, tuple[float, float]] = ZONES,
                   metric: str = "degrees") -> DataFrame:
    """Gridded wind to one row per (timestamp, zone), in one plan."""
    return mean_of_files(zone_means_per_file(grid, zones, metric))


def zone_pairs(zones: DataFrame, blocks: int | None = None, columns: tuple[str, ...] = ("lat", "lon")) -> DataFrame:
    """Every ordered pair of zones, the full square matrix in long form.

    The matrix itself is the result, so its size is n * n. The zone list is cut into
    slices and the pairing is an equi-join on the (row slice, column slice) of each tile,
    so the work spreads over tasks however long the list is. `blocks` is the number of
    slices; by default slices have about TILE zones.
    """
    if blocks is None:
        blocks = max(1, math.ceil(zones.count() / TILE))
    slice_of = F.pmod(F.xxhash64("region_id"), F.lit(blocks)).cast("int")
    every_slice = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    def side(suffix: str, own: str, other: str) -> DataFrame:
        named = [F.col("region_id").alias(f"zone_{suffix}")]
        named += [F.col(c).alias(f"{c}_{suffix}") for c in columns]
        return zones.select(*named, slice_of.alias(own), every_slice.alias(other))
    return (side("a", "tile_row", "tile_col")
            .join(side("b", "tile_col", "tile_row"), ["tile_row", "tile_col"])
            .drop("tile_row", "tile_col"))


def distance_matrix(zones: DataFrame, blocks: int | None = None) -> DataFrame:
    """Great-circle km between all zones; symmetric, zero diagonal; an unplaced zone sits at (0, 0)."""
    placed = zones.select(
        "region_id",
        F.coalesce(F.col("lat"), F.lit(0.0)).alias("lat"),
        F.coalesce(F.col("lon"), F.lit(0.0)).alias("lon"))
    # Computed from the smaller id to the larger one, so both halves are equal to the last bit.
    first = F.col("zone_a") <= F.col("zone_b")
    def ordered(name: str, near: bool) -> Column:
        return F.when(first == F.lit(near), F.col(f"{name}_a")).otherwise(F.col(f"{name}_b"))
    km = geo.haversine_km(ordered("lat", True), ordered("lon", True), ordered("lat", False), ordered("lon", False))
    return zone_pairs(placed, blocks).select(
        "zone_a", "zone_b",
        F.when(F.col("zone_a") == F.col("zone_b"), F.lit(0.0)).otherwise(km).alias("km"))


def matern_matrix(distances: DataFrame, lengthscale_km: float = 100.0, nu: float = 1.5,
                  variance: float = 1.0) -> DataFrame:
    """Matern covariance of each pair; the diagonal is exactly the variance."""
    value = geo.matern(F.col("km"), lengthscale_km, nu, variance)
    on_diagonal = F.col("zone_a") == F.col("zone_b")
    return distances.select(
        "zone_a", "zone_b",
        F.when(on_diagonal, F.lit(float(variance))).otherwise(value).alias("value"))


def frobenius(matrix: DataFrame, value: str = "value") -> DataFrame:
    """sqrt of the sum of squares of a long matrix."""
    return matrix.agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("frobenius"))


def matrix_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two long matrices side by side on their pair key, with the difference."""
    return (left.select("zone_a", "zone_b", F.col("value").alias("left_value"))
            .join(right.select("zone_a", "zone_b", F.col("value").alias("right_value")), ["zone_a", "zone_b"])
            .withColumn("value", F.col("left_value") - F.col("right_value")))
