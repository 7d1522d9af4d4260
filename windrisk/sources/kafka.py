"""Kafka source and sink for the streaming jobs; the connector jar comes with the cluster."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrisk.schemas import WEATHER

# Topic names.
WEATHER_TOPIC = "weather-obs"
SNAPSHOT_TOPIC = "grid-snapshots"
CORRELATION_TOPIC = "cross-region-correlations"


def source_options(brokers: str, topic: str, max_per_trigger: int = 1_000_000) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": "earliest",
            "maxOffsetsPerTrigger": str(max_per_trigger), "failOnDataLoss": "true"}


def decode(messages: DataFrame, schema=WEATHER) -> DataFrame:
    """JSON payload to columns, with the arrival order (partition, offset) for last-write-wins."""
    read = messages.select(F.from_json(F.col("value").cast("string"), schema).alias("row"), "partition", "offset")
    return read.select("row.*", "partition", "offset")


def weather_stream(spark: SparkSession, brokers: str, topic: str = WEATHER_TOPIC) -> DataFrame:
    return decode(spark.readStream.format("kafka").options(**source_options(brokers, topic)).load())


def encode(rows: DataFrame) -> DataFrame:
    """Whole row as a JSON payload."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def publish(rows: DataFrame, brokers: str, topic: str, checkpoint: str):
    return (encode(rows).writeStream.format("kafka").option("kafka.bootstrap.servers", brokers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())
