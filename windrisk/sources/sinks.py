"""Writers. Rows go from the executors to the files; none pass through the driver."""

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrisk.schemas import ENERGY_LONG, RUN_METRICS
from windrisk.session import store
from windrisk.sources.gates import content_hash, path_exists

HASHES = "content_hashes"
FILE_ROWS = 2_000_000


def overwrite_parquet(df: DataFrame, path: str, sort_by: Sequence[str] = ("timestamp", "region_id")) -> None:
    """Replace a table. Files are sorted inside, which keeps Parquet row-group ranges narrow without a global sort."""
    keys = [c for c in sort_by if c in df.columns]
    out = df.sortWithinPartitions(*keys) if keys else df
    out.write.mode("overwrite").parquet(path)


def write_by_year(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Range-partitioned by year of the timestamp.

    A year is dealt to as many tasks as its counted rows need (FILE_ROWS a file), so a year is neither one
    task nor a file from every task.
    """
    with_year = df.withColumn("year", F.year("timestamp"))
    files = (with_year.groupBy(F.col("year").alias("y")).agg(F.count(F.lit(1)).alias("n"))
             .select("y", F.ceil(F.col("n") / F.lit(FILE_ROWS)).alias("files")))
    salt = F.pmod(F.xxhash64("timestamp"), F.col("files"))
    dealt = with_year.join(F.broadcast(files), F.col("year").eqNullSafe(F.col("y"))).withColumn("__salt", salt).drop("y", "files")
    with_year = dealt.repartition("year", "__salt").drop("__salt")
    with_year.sortWithinPartitions("year", "timestamp").write.mode(mode).partitionBy("year").parquet(path)


def read_years(spark: SparkSession, path: str, start, end) -> DataFrame:
    """Rows of [start, end); the year bounds prune partitions."""
    ts, year = F.col("timestamp"), F.col("year")
    rows = spark.read.parquet(path)
    return rows.where((year >= F.lit(start.year)) & (year <= F.lit(end.year)) & (ts >= F.lit(start)) & (ts < F.lit(end)))


def append_tables(frames: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Append each non-empty frame to its year-partitioned table; returns the tables written."""
    written = []
    for name, frame in frames.items():
        if not frame.isEmpty():
            write_by_year(frame, f"{folder}/{name}", mode="append")
            written.append(name)
    return written


def append_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 50_000) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_rows).mode("append").save()


def table_name(asset_path: Sequence[str]) -> str:
    return "_".join(asset_path)


def replace_table(df: DataFrame | None, asset_path: Sequence[str], location: str | None = None) -> str | None:
    """Replace the table of an asset, managed or at a location; nothing to write, nothing done."""
    if df is None:
        return None
    name = table_name(asset_path)
    writer = df.write.mode("overwrite")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return name


def stored_hash(spark: SparkSession, folder: str, name: str) -> str | None:
    try:
        rows = spark.read.parquet(f"{folder}/{HASHES}").where(F.col("name") == name)
        newest = rows.orderBy(F.desc("written_at")).first()
    except AnalysisException:
        return None
    return newest["hash"] if newest else None


def _remember(spark: SparkSession, folder: str, name: str, digest: str) -> None:
    row = spark.createDataFrame([(name, digest)], "name string, hash string").withColumn("written_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(f"{folder}/{HASHES}")


def write_if_changed(df: DataFrame | None, folder: str, name: str) -> bool:
    """Write `folder/name` unless the same content is already there. Neither row order nor rounding noise counts.

    The table is computed once, into the work folder; its hash and its content come from there. The digest is
    stored after the data, so a run lost in between writes again.
    """
    if df is None:
        return False
    spark, path = df.sparkSession, f"{folder}/{name}"
    df = store(df, "staged")
    digest = str(content_hash(df))
    if stored_hash(spark, folder, name) == digest and path_exists(spark, path):
        return False
    overwrite_parquet(df, path)
    _remember(spark, folder, name, digest)
    return True


def retrain_needed(snaps: DataFrame, folder: str, model_name: str) -> bool:
    """False only if the snapshots are unchanged since the last fit and its result is still there."""
    spark = snaps.sparkSession
    same = stored_hash(spark, folder, f"{model_name}_input") == str(content_hash(snaps))
    there = any(path_exists(spark, f"{folder}/{model_name}{part}") for part in ("", "/draws"))
    return not (same and there)


def mark_trained(snaps: DataFrame, folder: str, model_name: str) -> None:
    _remember(snaps.sparkSession, folder, f"{model_name}_input", str(content_hash(snaps)))


def noop(df: DataFrame) -> None:
    """Run the plan, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def write_energy_csv(df: DataFrame, path: str) -> None:
    """Long energy CSV with a header and a fixed column order."""
    df.select(*ENERGY_LONG.names).write.mode("overwrite").option("header", True).csv(path)


def run_log(spark: SparkSession, run_name: str, params: Mapping[str, object], metrics: Mapping[str, object],
            tags: Mapping[str, str]) -> DataFrame:
    """Rows of a run log. Only numbers are metrics; flags count as 0 or 1; other values are dropped."""
    rows = [(run_name, "param", k, None, str(v)) for k, v in params.items()]
    rows += [(run_name, "metric", k, float(v), None) for k, v in metrics.items() if _is_number(v)]
    rows += [(run_name, "tag", k, None, str(v)) for k, v in tags.items()]
    return spark.createDataFrame(rows, RUN_METRICS)


def _is_number(value: object) -> bool:
    if isinstance(value, str) or value is None:
        return False
    try:
        float(value)
    except (TypeError, ValueError):
        return False
    return True


def log_run(spark: SparkSession, path: str, run_name: str, params: Mapping[str, object],
            metrics: Mapping[str, object], tags: Mapping[str, str]) -> None:
    run_log(spark, run_name, params, metrics, tags).coalesce(1).write.mode("append").parquet(path)


def log_metric_rows(metrics: DataFrame, path: str, run_name: str) -> None:
    """Append a (key, value) table, such as a diagnostics bundle, to the run log."""
    rows = metrics.select(
        F.lit(run_name).alias("run_name"), F.lit("metric").alias("kind"), "key",
        F.col("value").cast("double").alias("value"), F.lit(None).cast("string").alias("text"))
    rows.write.mode("append").parquet(path)
