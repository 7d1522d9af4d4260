"""Look-ups over the forecast table: filters on a scan, never a full read."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrisk.operators.correlation import nested
from windrisk.schemas import FORECAST, HORIZONS, ZONES

MEASURES = ["p_shortfall", "cvar_shortfall", "wind_p10", "wind_p50", "wind_p90"]


def check_arguments(region: str, horizon: int, regions=tuple(ZONES), horizons=HORIZONS) -> tuple[str, int]:
    """Upper-cased region and the horizon, or ValueError."""
    region = region.upper()
    if region not in regions:
        raise ValueError(f"Invalid region_id '{region}'. Must be one of: {sorted(regions)}")
    if horizon not in horizons:
        raise ValueError(f"Invalid horizon_h {horizon}. Must be one of: {sorted(horizons)}")
    return region, horizon


def matching(table: DataFrame, region: str, horizon: int) -> DataFrame:
    """Rows of a region and, if the table has horizons, of that horizon. Both predicates reach the scan."""
    rows = table.where(F.col("region_id") == region)
    if "horizon_h" in table.columns:
        rows = rows.where(F.col("horizon_h") == horizon)
    return rows


def _measures(table: DataFrame, names) -> list:
    return [(F.col(m) if m in table.columns else F.lit(None)).cast("double").alias(m) for m in names]


def _newest(table: DataFrame, rows: DataFrame) -> DataFrame:
    if "timestamp" in table.columns:
        rows = rows.orderBy(F.col("timestamp").desc())
    return rows.limit(1)


def _one_or_default(spark: SparkSession, found: DataFrame | None, region: str, horizon: int, names, default, missing: str) -> DataFrame:
    """The first match with status 'ok', else one row of defaults."""
    base = spark.range(1).select(F.lit(region).alias("region_id"), F.lit(horizon).alias("horizon_h"))
    if found is None:
        return base.select("*", *[F.lit(default).cast("double").alias(n) for n in names], F.lit(missing).alias("status"))
    hit = found.select(F.lit(region).alias("region_id"), F.lit(True).alias("hit"), *names)
    joined = base.join(hit, "region_id", "left")
    present = F.col("hit").isNotNull()
    return joined.select("region_id", "horizon_h",
                         *[F.when(present, F.col(n)).otherwise(F.lit(default).cast("double")).alias(n) for n in names],
                         F.when(present, F.lit("ok")).otherwise(F.lit(missing)).alias("status"))


def forecast(spark: SparkSession, table: DataFrame | None, region: str, horizon: int = 24,
             regions=tuple(ZONES), horizons=HORIZONS) -> DataFrame:
    """p_shortfall of one region and horizon; 0.0 and 'stub' where there is none."""
    region, horizon = check_arguments(region, horizon, regions, horizons)
    if table is None or "region_id" not in table.columns or "p_shortfall" not in table.columns:
        found = None
    else:
        found = _newest(table, matching(table, region, horizon)).select(*_measures(table, ["p_shortfall"]))
    return _one_or_default(spark, found, region, horizon, ["p_shortfall"], 0.0, "stub")


def scenario(spark: SparkSession, table: DataFrame | None, region: str, horizon: int = 24,
             regions=tuple(ZONES), horizons=HORIZONS) -> DataFrame:
    """Full risk profile of one region and horizon; NULLs and 'unavailable' where there is none."""
    region, horizon = check_arguments(region, horizon, regions, horizons)
    if table is None or "region_id" not in table.columns:
        found = None
    else:
        found = _newest(table, matching(table, region, horizon)).select(*_measures(table, MEASURES))
    return _one_or_default(spark, found, region, horizon, MEASURES, None, "unavailable")


def scenarios(table: DataFrame) -> DataFrame:
    """All rows, the timestamp as text."""
    if "timestamp" not in table.columns:
        return table
    return table.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


def scenario_records(table: DataFrame) -> DataFrame:
    """All rows as JSON records with the forecast fields; absent columns are NULL."""
    rows = scenarios(table)
    fields = [(F.col(n) if n in rows.columns else F.lit(None)).alias(n) for n in FORECAST.names]
    return rows.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record"))


def scenario_summary(table: DataFrame | None, spark: SparkSession) -> DataFrame:
    """Number of rows and the status of the listing."""
    if table is None:
        return spark.range(1).select(F.lit(0).cast("long").alias("count"), F.lit("unavailable").alias("status"))
    counted = table.agg(F.count(F.lit(1)).alias("count"))
    return counted.withColumn("status", F.when(F.col("count") > 0, F.lit("ok")).otherwise(F.lit("unavailable")))


def correlations(spark: SparkSession, matrix: DataFrame | None, zones=tuple(ZONES)) -> DataFrame:
    """Zone ids and nested matrix; the default zones and an empty matrix where there is none."""
    if matrix is None or matrix.isEmpty():
        empty = F.array().cast("array<array<double>>")
        return spark.range(1).select(F.array(*[F.lit(z) for z in zones]).alias("zone_ids"),
                                     empty.alias("correlation_matrix"), F.lit("stub").alias("status"))
    return nested(matrix).withColumn("status", F.lit("ok"))
