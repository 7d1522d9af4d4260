"""Nearest zone for zone lists that are too long to be literals: a pyramid of grid cells over the zones, searched from the top.

Level l of the pyramid cuts the map into 2^l by 2^l nodes; a node knows the box of its zones and one zone of it. A position goes down
the levels with the nodes that may hold its nearest zone. A node is dropped only if its box is proven to lie farther away than a zone
that was already seen, so the answer is exact at any distance, and a position keeps a few nodes however dense the zones are.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrisk.functions import geo
from windrisk.functions.timefn import not_nan
from windrisk.schemas import EARTH_RADIUS_KM
from windrisk.session import small_side, store

# Levels go down in steps of 16 children until no node holds more than LEAF_ZONES positions.
STEP, DEEPEST, LEAF_ZONES = 2, 20, 16
# Rounding of a bound never drops a node.
SLACK = 1e-9


def _distance(metric: str, lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    if metric == "degrees":
        dlat, dlon = lat1 - lat2, lon1 - lon2
        return dlat * dlat + dlon * dlon
    return geo.haversine_km(lat1, lon1, lat2, lon2)


def _at_least(metric: str, lat: Column, lon: Column) -> Column:
    """A distance below which no point of the box (south, north, west, east) lies.

    Points at least `a` degrees of longitude away are no nearer than the meridian there, which is asin(cos(lat) sin(a)) away up to
    90 degrees, and no nearer than the pole beyond.
    """
    up = F.greatest(F.lit(0.0), F.col("south") - lat, lat - F.col("north"))
    if metric == "degrees":
        along = F.greatest(F.lit(0.0), F.col("west") - lon, lon - F.col("east"))
        return up * up + along * along
    inside = (lon >= F.col("west")) & (lon <= F.col("east"))
    around = F.when(inside, F.lit(0.0)).otherwise(F.least(
        F.pmod(F.col("west") - lon, F.lit(360.0)), F.pmod(lon - F.col("east"), F.lit(360.0)), F.lit(90.0)))
    meridian = F.asin(F.least(F.lit(1.0), F.cos(F.radians(lat)) * F.sin(F.radians(around))))
    return F.lit(EARTH_RADIUS_KM) * F.greatest(F.radians(up), meridian)


def _wrapped(metric: str, lon: Column) -> Column:
    """Longitude in [-180, 180) where the map is a globe; degrees are a plane with an edge."""
    return lon if metric == "degrees" else F.pmod(lon + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def _node(value: Column, low: float, span: float, level: Column | int) -> Column:
    fine = F.floor((value - F.lit(low)) / F.lit(span) * F.lit(float(1 << DEEPEST))).cast("long")
    inside = F.least(F.greatest(fine, F.lit(0)), F.lit((1 << DEEPEST) - 1))
    return F.floor(inside / F.pow(F.lit(2.0), F.lit(DEEPEST) - level)).cast("long")


def _pyramid(positions: DataFrame) -> DataFrame:
    """One row per level and node with zones: its box, its first zone, the number of its positions."""
    levels = positions.withColumn("level", F.explode(F.array(*[F.lit(i) for i in range(0, DEEPEST + 1, STEP)])))
    placed = levels.select("level", _node(F.col("lat"), -90.0, 180.0, F.col("level")).alias("row"),
                           _node(F.col("wrapped"), -180.0, 360.0, F.col("level")).alias("col"), "lat", "wrapped", "zone_idx", "lon")
    return placed.groupBy("level", "row", "col").agg(
        F.min("lat").alias("south"), F.max("lat").alias("north"), F.min("wrapped").alias("west"), F.max("wrapped").alias("east"),
        F.min(F.struct("zone_idx", "lat", "lon")).alias("first"), F.count(F.lit(1)).alias("n"))


def nearest_zones(cells: DataFrame, zones: DataFrame, metric: str = "degrees") -> DataFrame:
    """Distinct positions (latitude, longitude) with the `region_id` of their nearest zone.

    `zones` has region_id, lat, lon and zone_idx; on a tie the lowest zone_idx wins, then the lowest id. Positions or zones without
    coordinates are left out; without any zone the result is empty. `haversine` crosses the date line and the poles.
    """
    if metric not in ("degrees", "haversine"):
        raise ValueError(f"metric must be 'degrees' or 'haversine', got {metric!r}")
    lat, lon = F.col("lat").cast("double"), F.col("lon").cast("double")
    positions = store(zones.select("region_id", "zone_idx", lat.alias("lat"), lon.alias("lon"))
                      .where(not_nan(F.col("lat")).isNotNull() & not_nan(F.col("lon")).isNotNull())
                      .groupBy("lat", "lon").agg(F.min(F.struct("zone_idx", "region_id")).alias("z"))
                      .select("lat", "lon", _wrapped(metric, F.col("lon")).alias("wrapped"), "z.zone_idx", "z.region_id"), "zones")
    pyramid = store(_pyramid(positions), "pyramid")
    fullest = {r.level: r.n for r in pyramid.groupBy("level").agg(F.max("n").alias("n")).collect()}
    leaf = next((level for level in sorted(fullest) if fullest[level] <= LEAF_ZONES), DEEPEST)

    here_lat, here_lon = F.col("latitude"), F.col("longitude")
    known = not_nan(here_lat).isNotNull() & not_nan(here_lon).isNotNull()
    frontier = (cells.select("latitude", "longitude").where(known).distinct()
                .withColumn("row", F.lit(0).cast("long")).withColumn("col", F.lit(0).cast("long")))
    of_position = Window.partitionBy("latitude", "longitude")
    for level in range(STEP, leaf + 1, STEP):
        nodes = pyramid.where(F.col("level") == level).select(
            F.shiftright("row", STEP).alias("p_row"), F.shiftright("col", STEP).alias("p_col"),
            F.col("row").alias("n_row"), F.col("col").alias("n_col"), "south", "north", "west", "east",
            F.col("first.lat").alias("first_lat"), F.col("first.lon").alias("first_lon"))
        reached = frontier.join(small_side(nodes), (F.col("row") == F.col("p_row")) & (F.col("col") == F.col("p_col")))
        bounded = reached.select(
            "latitude", "longitude", F.col("n_row").alias("row"), F.col("n_col").alias("col"),
            _at_least(metric, here_lat, _wrapped(metric, here_lon)).alias("low"),
            F.min(_distance(metric, here_lat, here_lon, F.col("first_lat"), F.col("first_lon"))).over(of_position).alias("best"))
        frontier = bounded.where(F.col("low") * F.lit(1.0 - SLACK) - F.lit(SLACK) <= F.col("best")).drop("low", "best")
    at_leaf = positions.select(_node(F.col("lat"), -90.0, 180.0, F.lit(leaf)).alias("row"),
                               _node(F.col("wrapped"), -180.0, 360.0, F.lit(leaf)).alias("col"), "lat", "lon", "zone_idx", "region_id")
    gap = _distance(metric, here_lat, here_lon, F.col("lat"), F.col("lon"))
    return (frontier.join(small_side(at_leaf), ["row", "col"])
            .groupBy("latitude", "longitude").agg(F.min(F.struct(gap.alias("gap"), "zone_idx", "region_id")).alias("z"))
            .select("latitude", "longitude", F.col("z.region_id").alias("region_id")))


def assign_zone_list(grid: DataFrame, zones: DataFrame, metric: str = "degrees") -> DataFrame:
    """`spatial.assign_zone` for a zone table of any length: the same result, by a search of the distinct positions.

    Cells without a position are left out. Without any zone, `region_id` is NULL.
    """
    found = store(nearest_zones(grid, zones, metric), "nearest")
    known = not_nan(F.col("latitude")).isNotNull() & not_nan(F.col("longitude")).isNotNull()
    return grid.where(known).join(small_side(found), ["latitude", "longitude"], "left").select(*grid.columns, "region_id")
