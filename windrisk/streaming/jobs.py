"""Hourly snapshots, six-hour correlations and alerts on streams.

Windows are aligned to the clock. Rows later than the watermark are dropped; results are
appended once the watermark has passed a window, so each window is emitted once.
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from windrisk.functions.timefn import not_nan
from windrisk.operators.risk import alerts
from windrisk.streaming import state

# Window lengths.
SNAPSHOT_WINDOW = "1 hour"
CORRELATION_WINDOW = "6 hours"
CORRELATION_SLIDE = "1 hour"
DELAY = "1 hour"
# Our choice: correlation above which a whole window counts as a warning.
WARNING_CORRELATION = 0.7


def file_stream(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.parquet",
                max_files: int = 1000) -> DataFrame:
    return (spark.readStream.schema(schema).option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", max_files).parquet(path))


def last_values(obs: DataFrame, order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """Last value of each zone in each hour of a table, NULL included.

    `order` breaks ties among equal timestamps, e.g. by partition and offset of the topic.
    `first_seen` is the timestamp of the zone's first observation in the hour.
    """
    newest = F.struct(*order)
    return (obs.where(F.col("region_id").isNotNull())
            .groupBy(F.window("timestamp", SNAPSHOT_WINDOW), "region_id")
            .agg(F.max_by("wind_speed_mps", newest).alias("wind_speed_mps"), F.min("timestamp").alias("first_seen")))


def closed_values(obs: DataFrame, order: tuple[str, ...] = ("timestamp",), delay: str = DELAY) -> DataFrame:
    """`last_values` of a stream, each zone-hour given out once the watermark has passed it.

    Tasks reduce their rows to one per zone and hour before they are sent; the state is one row for each open zone-hour. An
    hour closes when a row `delay` past its end is seen, counted from the start of that row's hour; rows of closed hours are
    dropped. A row without zone (the end mark of a bounded stream) only moves the watermark.
    """
    state.with_state(obs.sparkSession)
    # Counted from the end of the hour: what this adds to `delay` is the hour itself.
    closes = F.date_trunc("hour", "timestamp") + F.expr("INTERVAL '59:59.999' MINUTE TO SECOND")
    timed = obs.where(F.col("timestamp").isNotNull()).withColumn("closes", closes).withWatermark(
        "closes", f"{delay} 59 minutes 59 seconds 999 milliseconds")
    # Rows without zone go by a count: a condition on the zone itself would be pushed below the watermark, which they must move.
    return (timed.groupBy(F.window("closes", SNAPSHOT_WINDOW), "region_id")
            .agg(F.max_by("wind_speed_mps", F.struct(*order)).alias("wind_speed_mps"), F.min("timestamp").alias("first_seen"),
                 F.count("region_id").alias("seen")).where(F.col("seen") > 0).drop("seen"))


def hourly_snapshots(obs: DataFrame, order: tuple[str, ...] = ("timestamp",), delay: str = DELAY) -> DataFrame:
    """(hour, timestamp, regions MAP): all zones of an hour in one row. An hour without rows gives none.

    Each zone is reduced first, so the collected list is one entry per zone, however many
    observations an hour or a zone has. On a stream, the watermark closes the zone-hours.
    """
    per_zone = closed_values(obs, order, delay) if obs.isStreaming else last_values(obs, order)
    entry = F.struct("region_id", not_nan(F.col("wind_speed_mps")).alias("v"))
    return (per_zone.groupBy("window")
            .agg(F.min("first_seen").alias("timestamp"), F.map_from_entries(F.collect_list(entry)).alias("regions")))


def _correlations(windows: DataFrame) -> DataFrame:
    """Correlation event of each row's `snapshots`, at most six, sorted by time; none if fewer than two or any value is missing.

    The zones are those of the first snapshot. A constant zone has NULL correlations: it is told by its values, since its
    rounded mean may leave noise in the products. Only column functions, so a task holds one window at a time.
    """
    first = F.element_at("snapshots", 1)
    zoned = windows.where(F.size("snapshots") >= 2).withColumn("zone_ids", F.array_sort(F.map_keys(first["regions"])))
    series = F.transform("zone_ids", lambda z: F.transform("snapshots", lambda s: not_nan(F.element_at(s["regions"], z))))
    whole = zoned.withColumn("series", series).where(
        (F.size("zone_ids") > 0) & F.forall("series", lambda values: F.forall(values, lambda v: v.isNotNull())))
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    means = whole.withColumn("means", F.transform("series", lambda values: total(values) / F.size(values)))
    centred = means.withColumn("centred", F.transform(F.arrays_zip("series", "means"), lambda z: F.transform(
        z["series"], lambda v: v - z["means"])))
    squares = F.transform(F.arrays_zip("series", "centred"), lambda z: F.when(
        F.array_min(z["series"]) == F.array_max(z["series"]), F.lit(0.0)).otherwise(F.sqrt(total(F.transform(z["centred"], lambda c: c * c)))))
    spread = centred.withColumn("spread", squares)

    def cell(a, i, b, j):
        scale = not_nan(a["spread"] * b["spread"])
        product = total(F.zip_with(a["centred"], b["centred"], lambda x, y: x * y))
        ratio = F.when(i == j, F.lit(1.0)).otherwise(not_nan(product / scale))
        # A NULL would be stepped over by `least` and `greatest`.
        return F.when((scale > 0) & ratio.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio)))
    zones = F.arrays_zip("centred", "spread")
    matrix = F.transform(zones, lambda a, i: F.transform(zones, lambda b, j: cell(a, i, b, j)))
    return spread.select("window_start", "window_end", F.element_at("snapshots", -1)["timestamp"].alias("timestamp"), "zone_ids",
                         matrix.alias("correlation_matrix"), F.map_from_arrays("zone_ids", "means").alias("mean_wind_per_region"))


def _by_time(a, b):
    return F.when(a["at"] < b["at"], F.lit(-1)).when(a["at"] > b["at"], F.lit(1)).otherwise(F.lit(0))


def window_correlations(snapshots: DataFrame) -> DataFrame:
    """Correlation event of every six-hour window, sliding by the hour; windows without a result are dropped."""
    hour_end = F.window_time("window")
    entry = F.struct("at", "timestamp", "regions")
    gathered = (snapshots.withColumn("at", hour_end)
                .groupBy(F.window(hour_end, CORRELATION_WINDOW, CORRELATION_SLIDE).alias("w6"))
                .agg(F.array_sort(F.collect_list(entry), _by_time).alias("snapshots")))
    return _correlations(gathered.select(F.col("w6.start").alias("window_start"), F.col("w6.end").alias("window_end"), "snapshots"))


def early_warnings(events: DataFrame, threshold: float = WARNING_CORRELATION) -> DataFrame:
    """Windows in which every pair of zones is correlated above the threshold at once."""
    size = F.size("zone_ids")
    upper = F.flatten(F.transform(
        "correlation_matrix", lambda row, i: F.slice(row, i + 2, F.greatest(size - i - 1, F.lit(0)))))
    above = F.forall(upper, lambda r: F.coalesce(r > F.lit(threshold), F.lit(False)))
    return events.where((size >= 2) & above)


def warning_strengths(events: DataFrame, threshold: float = WARNING_CORRELATION) -> DataFrame:
    """(zones, window_start, window_end, strength) of the warnings; strength is the lowest correlation of two zones."""
    lowest = F.array_min(F.flatten(F.transform("correlation_matrix", lambda row, i: F.slice(row, i + 2, F.size("zone_ids")))))
    return early_warnings(events, threshold).select(
        F.array_join("zone_ids", ",").alias("zones"), "window_start", "window_end", lowest.alias("strength"))


def warning_episodes(warnings: DataFrame) -> DataFrame:
    """Overlapping warnings of a stream as episodes with start, end and peak."""
    return state.episodes(warnings, dt.timedelta(hours=6))


def alert_stream(forecasts: DataFrame) -> DataFrame:
    """Forecast rows at or above the alert probability, as they arrive."""
    return alerts(forecasts)


def run_to_files(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process all that is there, append to Parquet, stop. An end mark in the input closes what is open."""
    return (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
