"""Session settings, the shared work folder, and size-checked broadcasts.

Work tables stay in the shared folder under `windrisk/`; like checkpoint files they are
left for the cluster's own retention rule.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
LOCAL_ROWS = 10_000
BATCH_BYTES = 4 << 20
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Timestamps are UTC instants everywhere; AQE splits skewed joins; batches for Python workers are bounded by bytes too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Ranking filters `rn <= n` drop surplus rows before the shuffle for n up to this.
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "100000")
    # 10 000 long texts, the default batch, are held twice by the worker and once or twice by the executor.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master that names none (unit tests) gets a temporary one; a cluster must name a folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="windrisk-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/windrisk/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Checkpoint a small or already shuffled result, so that it is computed once.

    A checkpoint runs the last stage twice; for results that are large or costly to
    compute in that stage, `store` is the better choice.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write a table to the shared folder and read it back.

    A lost executor costs no recompute, every reader sees the same bits, and the planner
    knows the true size. The shuffle files behind it go as soon as it is written.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more; all that was derived from them must be stored itself."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def _kept(df: DataFrame, local_rows: int) -> tuple[DataFrame, bool]:
    table = df.limit(local_rows + 1).toArrow()
    if table.num_rows <= local_rows:
        return df.sparkSession.createDataFrame(table, schema=df.schema), True
    return settle(df), False


def keep(df: DataFrame, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """Compute a result once: held by the driver if it has at most `local_rows` rows, else checkpointed.

    Most kept results are a handful of groups, zones or runs; those cost one job and no file.
    """
    return _kept(df, local_rows)[0]


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast `df` only if it has at most `max_rows` rows; else leave it to a shuffle join."""
    kept, is_local = _kept(df, min(LOCAL_ROWS, max_rows))
    if is_local or kept.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(kept)
    return kept
