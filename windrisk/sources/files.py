"""Readers: weather grids, energy CSV, Silver and Gold tables, and their fallbacks."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrisk.schemas import ENERGY_LONG, FORECAST, GRID, WEATHER

CORRUPT = "_corrupt_record"


# Fixed value: newer grids name the time column `valid_time`, older ones `time`.
TIME_COLUMNS = ("valid_time", "time", "timestamp")


def rename_time(df: DataFrame) -> DataFrame:
    """The time column under its common name."""
    for name in TIME_COLUMNS[:2]:
        if name in df.columns and "timestamp" not in df.columns:
            return df.withColumnRenamed(name, "timestamp")
    return df


def wind_alias(df: DataFrame) -> DataFrame:
    """`wind_speed` is accepted for `wind_speed_mps`."""
    if "wind_speed" in df.columns and "wind_speed_mps" not in df.columns:
        return df.withColumnRenamed("wind_speed", "wind_speed_mps")
    return df


def weather_grid(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Every grid file under a prefix as (file_id, timestamp, latitude, longitude, u10, v10).

    An unreadable file is skipped. The schema is given, so no file is opened to infer it;
    it names every known time column, those a file does not have read as NULL.
    """
    times = [T.StructField(name, T.TimestampType()) for name in TIME_COLUMNS]
    schema = T.StructType([*times, *[f for f in GRID.fields if f.name != "timestamp"]])
    grid = (spark.read.schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
            .option("ignoreCorruptFiles", True).parquet(path))
    return grid.select(F.col("_metadata.file_path").alias("file_id"),
                       F.coalesce(*TIME_COLUMNS).alias("timestamp"), "latitude", "longitude", "u10", "v10")


def skipped_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(file_id, why): files under the prefix that `weather_grid` could not read, so a skip never goes unseen.

    `unreadable` files have no usable footer; `broken` ones give fewer rows than their footer says once
    all needed columns are read.
    """
    def name(column: str):
        return F.regexp_replace(column, "^file:/+", "/").alias("file_id")
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
              .option("recursiveFileLookup", True).load(path).select(name("path")))
    grid = weather_grid(spark, path, pattern)
    # Without a data column a scan counts rows by the footers.
    promised = (spark.read.schema("latitude double").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
                .option("ignoreCorruptFiles", True).parquet(path).select(name("_metadata.file_path"))
                .groupBy("file_id").agg(F.count(F.lit(1)).alias("promised")))
    used = F.struct(*[F.col(c) for c in grid.columns if c != "file_id"])
    # The condition holds for every row, but only the values tell.
    read = grid.select(name("file_id"), F.xxhash64(used).alias("h")).groupBy("file_id").agg(
        F.count_if(F.col("h").cast("string") != "").alias("got"))
    counted = listed.join(promised, "file_id", "left").join(read, "file_id", "left")
    why = F.when(F.col("promised").isNull(), F.lit("unreadable")).when(F.coalesce("got", F.lit(0)) < F.col("promised"), F.lit("broken"))
    return counted.select("file_id", why.alias("why")).where(F.col("why").isNotNull())


def energy_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Long energy CSV under one or more prefixes, with `file_id`; malformed lines are kept apart.

    The schema is fixed, nothing is inferred. A line that does not fit keeps its text in
    `_corrupt_record`; `good_rows` and `bad_rows` tell the two apart. All columns are parsed
    whatever a query selects, or else a line would be good or bad depending on the query.
    """
    schema = T.StructType([*ENERGY_LONG.fields, T.StructField(CORRUPT, T.StringType())])
    frames = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).option("ignoreCorruptFiles", True)
              .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(list(paths)))
    # The CSV reader only checks the columns a plan asks for; the guard asks for all of them.
    every_column = F.concat_ws("", *[F.col(c).cast("string") for c in schema.names])
    guarded = F.when(F.length(every_column) >= 0, F.col(CORRUPT))
    return frames.select(F.col("_metadata.file_path").alias("file_id"), *ENERGY_LONG.names, guarded.alias(CORRUPT))


def good_rows(energy: DataFrame) -> DataFrame:
    return energy.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_rows(energy: DataFrame) -> DataFrame:
    return energy.where(F.col(CORRUPT).isNotNull()).select("file_id", CORRUPT)


def silver_weather(spark: SparkSession, path: str) -> DataFrame:
    return wind_alias(spark.read.parquet(path)).select(*WEATHER.names)


def weather_or_table(spark: SparkSession, path: str, table: str = "weather_obs") -> DataFrame:
    """Silver if readable and not empty, else the table; `source` says which. Columns stay, even when empty."""
    try:
        silver = silver_weather(spark, path)
        if not silver.isEmpty():
            return silver.withColumn("source", F.lit("silver"))
    except AnalysisException:
        pass
    return weather_table(spark, table).withColumn("source", F.lit("table"))


def weather_table(spark: SparkSession, table: str = "weather_obs", ordered: bool = False) -> DataFrame:
    """The weather table, three columns, ordered by time and zone if asked."""
    rows = spark.table(table).select(*WEATHER.names)
    return rows.orderBy("timestamp", "region_id") if ordered else rows


def jdbc_options(url: str, table: str, lower: str, upper: str, partitions: int = 64) -> dict[str, str]:
    """Options of a partitioned JDBC read: every task fetches its own time range."""
    return {"url": url, "dbtable": table, "partitionColumn": "timestamp", "lowerBound": lower,
            "upperBound": upper, "numPartitions": str(partitions), "fetchsize": "50000"}


def weather_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load().select(*WEATHER.names)


def gold_forecasts(spark: SparkSession, path: str) -> DataFrame | None:
    """The forecast table as it stands (columns may be missing), or None if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def empty_forecasts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FORECAST)
