"""Zone-by-zone Pearson correlation over complete snapshots."""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrisk.operators.features import zone_index
from windrisk.session import keep, settle, small_side, store

# Up to this many zones one aggregate holds all pairs; beyond, partial products per task.
PIVOT_ZONES = 24
# Up to this many zones a task holds the products of all pairs; beyond, a tile of TILE_ZONES by TILE_ZONES and about BLOCK_STEPS timesteps.
ARRAY_ZONES, TILE_ZONES, BLOCK_STEPS = 512, 256, 4096


def complete_timesteps(snaps: DataFrame, zones: Sequence[str]) -> DataFrame:
    """One row per timestamp with one column per zone; incomplete timesteps are left out."""
    values = snaps.where(F.col("region_id").isin(list(zones))).groupBy("timestamp").agg(*[
        F.avg(F.when(F.col("region_id") == z, F.col("wind_speed_mps"))).alias(f"z{i}") for i, z in enumerate(zones)])
    return values.dropna()


def _pearson(covariance: Column, sd_a: Column, sd_b: Column) -> Column:
    """NULL, not an error, for a constant series; within [-1, 1]."""
    scale = sd_a * sd_b
    # `greatest` and `least` skip NULLs, so the constant case is decided first.
    return F.when(scale > 0.0, F.least(F.greatest(covariance / scale, F.lit(-1.0)), F.lit(1.0)))


def _spread(value: Column) -> Column:
    """Standard deviation, exactly 0 for a series of one value: its mean may be rounded."""
    return F.when(F.min(value) == F.max(value), F.lit(0.0)).otherwise(F.stddev_pop(value))


def _cell(i: Column, j: Column, covariance: Column, sd_a: Column, sd_b: Column) -> Column:
    """A series that varies is fully correlated with itself, without rounding."""
    return F.when((i == j) & (sd_a > 0.0), F.lit(1.0)).otherwise(_pearson(covariance, sd_a, sd_b))


def correlation_matrix(snaps: DataFrame, zones: Sequence[str] | None = None,
                       pivot_zones: int = PIVOT_ZONES, array_zones: int = ARRAY_ZONES, tile: int = TILE_ZONES) -> DataFrame:
    """(zone_a, zone_b, value) for all ordered pairs, over timesteps where every zone reports.

    Fewer than two such timesteps give no rows. No self-join on the timestamp: a row holds
    all zones of a timestep, so all pairs come out of a single map-side aggregate.
    """
    if zones is None:
        some = snaps.select("region_id").dropna().distinct().limit(pivot_zones + 1).collect()
        zones = sorted(r.region_id for r in some)
        known = None
    else:
        known = list(zones)
        snaps = snaps.where(F.col("region_id").isin(known))
    if len(zones) > pivot_zones:
        return _many_zones(snaps, known, array_zones, tile)
    if not zones:
        return snaps.sparkSession.createDataFrame([], "zone_a string, zone_b string, value double")
    upper = _pivoted(complete_timesteps(snaps, zones), len(zones))
    names = F.array(*[F.lit(z) for z in zones])
    return _mirrored(upper).select(F.element_at(names, F.col("i") + 1).alias("zone_a"),
                                   F.element_at(names, F.col("j") + 1).alias("zone_b"), "value")


def _mirrored(upper: DataFrame) -> DataFrame:
    """The upper triangle (i <= j) to the whole matrix."""
    cell, turned = F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))
    places = F.when(F.col("i") == F.col("j"), F.array(cell)).otherwise(F.array(cell, turned))
    return upper.select(F.explode(places).alias("p"), "value").select("p.i", "p.j", "value")


def _pivoted(rows: DataFrame, n: int) -> DataFrame:
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    sums = rows.agg(F.count(F.lit(1)).alias("n"),
                    *[_spread(F.col(f"z{i}")).alias(f"s{i}") for i in range(n)],
                    *[F.covar_pop(f"z{i}", f"z{j}").alias(f"c{i}_{j}") for i, j in pairs])
    cells = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"),
                 _cell(F.lit(i), F.lit(j), F.col(f"c{i}_{j}"), F.col(f"s{i}"), F.col(f"s{j}")).alias("value"))
        for i, j in pairs])
    return sums.where(F.col("n") >= 2).select(F.inline(cells))


def _many_zones(snaps: DataFrame, known: Sequence[str] | None, array_zones: int, tile: int) -> DataFrame:
    """All zones in the data, or the known ones; a known zone without data leaves no complete timestep."""
    index = zone_index(snaps)
    n = index.agg(F.count(F.lit(1))).first()[0] if known is None else len(set(known))
    per_zone = (snaps.join(index.select("region_id", "zone_idx"), "region_id")
                .groupBy("timestamp", "zone_idx").agg(F.avg("wind_speed_mps").alias("v")).dropna())
    sums, flat = _partial_products(per_zone, n) if n <= array_zones else _tiled_products(per_zone, n, tile)
    return _from_sums(sums, flat, index)


def _tiled_products(per_zone: DataFrame, n: int, tile: int, block: int = BLOCK_STEPS) -> tuple[DataFrame, DataFrame]:
    """Sums of products by pair, tile by tile: zones are cut into slices, timesteps into blocks, and the two slices of a tile meet by block.

    A task holds one tile and the rows of one block, however many zones there are. Each value is sent once to each tile of its slice.
    """
    cells = store(per_zone, "cells")
    complete = store(cells.groupBy("timestamp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == n).select("timestamp"), "complete")
    steps = complete.count()
    rows = store(cells.join(complete, "timestamp", "left_semi"), "timesteps")
    flat = store(rows.groupBy(F.col("zone_idx").alias("i")).agg(F.avg("v").alias("mean"), (F.min("v") == F.max("v")).alias("constant")), "means")
    centred = rows.join(small_side(flat.select(F.col("i").alias("zone_idx"), "mean")), "zone_idx")
    # Blocks are dealt by hash; their size is near `block`, whatever the number of timesteps.
    of_block = F.pmod(F.xxhash64("timestamp"), F.lit(max(1, -(-steps // block))))
    sliced = store(
        centred.groupBy("timestamp", F.floor(F.col("zone_idx") / tile).cast("int").alias("slice"))
        .agg(F.array_sort(F.collect_list(F.struct("zone_idx", (F.col("v") - F.col("mean")).alias("v")))).alias("cells"))
        .select(of_block.alias("block"), "timestamp", "slice", F.transform("cells", lambda c: c["v"]).alias("v")), "slices")
    last = F.lit(-(-n // tile) - 1)
    left = sliced.select("block", F.col("slice").alias("a"), F.explode(F.sequence("slice", last)).alias("b"), "timestamp", "v")
    right = sliced.select("block", F.explode(F.sequence(F.lit(0), "slice")).alias("a"), F.col("slice").alias("b"), "timestamp", "v")

    def products(key, x, y):
        # Both sides hold the complete timesteps of the block.
        x, y = (np.stack(side.sort_values("timestamp")["v"].to_numpy()) for side in (x, y))
        i, j = np.indices((x.shape[1], y.shape[1]))
        out = pd.DataFrame({"i": (i + int(key[1]) * tile).ravel().astype("int32"), "j": (j + int(key[2]) * tile).ravel().astype("int32"),
                            "s": (x.T @ y).ravel()})
        return out[out.i <= out.j]

    keys = ["block", "a", "b"]
    tiles = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(products, "i int, j int, s double")
    return store(tiles.groupBy("i", "j").agg(F.sum("s").alias("s")).where(F.lit(steps) >= 2), "sums"), flat


def _partial_products(per_zone: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Sums of products by pair, and flat zones: a timestep is one array, each task adds up products of centred arrays.

    What is shuffled is one zone-by-zone triangle per task, the size of the result.
    """
    cells = F.array_sort(F.collect_list(F.struct("zone_idx", "v")))
    rows = store(per_zone.groupBy("timestamp").agg(cells.alias("cells")).where(F.size("cells") == n)
                 .select(F.transform("cells", lambda c: c["v"]).alias("v")), "timesteps")
    center = np.zeros(n)
    flat = keep(rows.select(F.posexplode("v").alias("i", "v")).groupBy("i").agg(
        F.avg("v").alias("mean"), (F.min("v") == F.max("v")).alias("constant")))
    for place, mean, constant in flat.select("i", "mean", "constant").collect():
        center[place] = mean

    def products(batches):
        total, count = np.zeros((n, n)), 0
        for batch in batches:
            x = np.stack(batch["v"].to_numpy()) - center
            total += x.T @ x
            count += len(x)
        up_i, up_j = np.triu_indices(n)
        yield pd.DataFrame({"i": up_i.astype("int32"), "j": up_j.astype("int32"), "s": total[up_i, up_j], "n": count})

    sums = settle(rows.mapInPandas(products, "i int, j int, s double, n long")
                  .groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).where(F.col("n") >= 2))
    return sums, flat


def _from_sums(sums: DataFrame, flat: DataFrame, index: DataFrame) -> DataFrame:
    """Correlations from the sums of centred products (i <= j); `flat` tells the constant zones."""
    spread = small_side(sums.where("i = j").join(flat.select("i", "constant"), "i").select(
        F.col("i").alias("k"), F.when(F.col("constant"), F.lit(0.0)).otherwise(F.sqrt("s")).alias("sd")))
    def sd_of(side: str) -> DataFrame:
        return spread.select(F.col("k").alias(side), F.col("sd").alias(f"sd_{side}"))
    upper = (sums.join(sd_of("i"), "i").join(sd_of("j"), "j")
             .select("i", "j", _cell(F.col("i"), F.col("j"), F.col("s"), F.col("sd_i"), F.col("sd_j")).alias("value")))
    def name_of(side: str, zone: str) -> DataFrame:
        return index.select(F.col("zone_idx").alias(side), F.col("region_id").alias(zone))
    return (_mirrored(upper).join(name_of("i", "zone_a"), "i").join(name_of("j", "zone_b"), "j")
            .select("zone_a", "zone_b", "value"))


def zone_means(snaps: DataFrame) -> DataFrame:
    """Mean wind per zone as one map."""
    return (snaps.groupBy("region_id").agg(F.avg("wind_speed_mps").alias("v"))
            .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("region_id", "v")))).alias("mean_wind_per_region")))


def nested(matrix: DataFrame) -> DataFrame:
    """Long matrix to one row: sorted zone ids and the nested array."""
    by_row = (matrix.groupBy("zone_a")
              .agg(F.array_sort(F.collect_list(F.struct("zone_b", "value"))).alias("cells")))
    whole = by_row.agg(F.array_sort(F.collect_list(F.struct("zone_a", "cells"))).alias("rows"))
    return whole.select(
        F.transform("rows", lambda r: r["zone_a"]).alias("zone_ids"),
        F.transform("rows", lambda r: F.transform(r["cells"], lambda c: c["value"])).alias("correlation_matrix"))


def unnested(matrix: DataFrame) -> DataFrame:
    """The nested form back to long rows."""
    rows = matrix.select("zone_ids", F.posexplode("correlation_matrix").alias("i", "row"))
    cells = rows.select("zone_ids", "i", F.posexplode("row").alias("j", "value"))
    return cells.select(F.element_at("zone_ids", F.col("i") + 1).alias("zone_a"),
                        F.element_at("zone_ids", F.col("j") + 1).alias("zone_b"), "value")
