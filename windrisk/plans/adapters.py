"""The shared test tables in the shape of the domain tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrisk.schemas import ZONES

# Zones that the five event types stand for.
EVENT_ZONE = {"view": "SE1", "click": "SE3", "purchase": "NO1", "signup": "DK1", "error": "FI"}
# Codes dealt out over twelve suppliers: zones, areas, EIC codes, and one unknown code.
CODES = ["SE1", "SE2", "SE", "NO", "10YFI-1--------U", "10YSE-1--------K",
         "DK1", "DK2", "XX9", "NO1", "10YNO-0--------C", "FI"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").alias("region_id"),
        (F.col("value") / 10.0).alias("wind_speed_mps"))


def zone_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`obs` under zone names."""
    names = F.create_map(*[F.lit(x) for pair in EVENT_ZONE.items() for x in pair])
    return obs(spark, sf_dir).withColumn("region_id", names[F.col("region_id")])


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly maximum event value per type, as a price."""
    events = table(spark, sf_dir, "events")
    return (events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w"), F.col("event_type").alias("region_id"))
            .agg(F.max("value").alias("price_eur_mwh"))
            .select(F.col("w.start").alias("timestamp"), "region_id", "price_eur_mwh"))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("file_id"), F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        (F.lit(54.0) + (F.col("l_partkey") % 73) * F.lit(0.25)).alias("latitude"),
        (F.lit(-10.0) + ((F.col("l_suppkey") * 37) % 181) * F.lit(0.25)).alias("longitude"),
        (F.col("l_quantity") - 25.0).alias("u10"), (F.col("l_extendedprice") / 10000.0 - 5.0).alias("v10"))


def energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(c) for c in CODES]), (F.col("l_suppkey") % 12 + 1).cast("int"))
    variable = (F.when(F.col("l_returnflag") == "A", "B19").when(F.col("l_returnflag") == "N", "B18")
                .otherwise("load_mwh"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("file_id"), F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        code.alias("region_id"), variable.alias("variable"), F.col("l_quantity").alias("value_mwh"))


def draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("horizon_h"), F.col("vec_id").alias("sample_id"),
        F.posexplode("embedding").alias("dim", "e")).select(
        "horizon_h", "sample_id", F.concat(F.lit("d"), F.col("dim").cast("string")).alias("region_id"),
        (F.lit(4.0) + F.lit(8.0) * F.col("e").cast("double")).alias("value"))


def zone_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws with real zone names and the three real horizons."""
    names = F.array(*[F.lit(z) for z in ZONES])
    rows = draws(spark, sf_dir)
    dim = F.substring("region_id", 2, 8).cast("int")
    # Sample ids stay unique per zone: the dimension's turn joins the vector id.
    turn = F.floor(dim / F.lit(len(ZONES))).cast("long")
    return rows.select(
        ((F.col("horizon_h") % 3 + 1) * 24).alias("horizon_h"),
        (F.col("sample_id") * 8 + turn).alias("sample_id"),
        F.element_at(names, dim % len(ZONES) + 1).alias("region_id"), "value")


def chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % 4).cast("int").alias("chain"), F.floor(F.col("vec_id") / 4).cast("int").alias("draw"),
        F.posexplode("embedding").alias("dim", "e")).select(
        "chain", "draw", F.concat(F.lit("d"), F.col("dim").cast("string")).alias("param"),
        F.col("e").cast("double").alias("value"))


def elbo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run is shifted far up, so that both verdicts occur."""
    shift = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(1e8)).otherwise(F.lit(0.0))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("run_id"), F.col("o_orderkey").alias("iter"),
        (F.col("o_totalprice") + shift).alias("elbo"))


def zones25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("region_id"),
        (F.lit(54.0) + (F.col("n_nationkey") % 5) * F.lit(4.0)).alias("lat"),
        (F.lit(-10.0) + F.col("n_nationkey") * F.lit(1.75)).alias("lon"))


def many_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone per customer; positions are multiples of 1/256 degree, so squared distances are exact."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("region_id"), F.col("c_custkey").cast("long").alias("zone_idx"),
        (F.lit(54.0) + (F.col("c_custkey").cast("long") * 7919 % 4608) / F.lit(256.0)).alias("lat"),
        (F.lit(-10.0) + (F.col("c_custkey").cast("long") * 104729 % 11520) / F.lit(256.0)).alias("lon"))


def xml_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per hour, event type and hundred of event ids; `kind` says generation or load.

    A document never has more than a hundred points. They are numbered in order of event id, in pieces of 15 minutes for `view`, 30 for
    `click` and an hour otherwise. A point whose value ends in .00 is spelled "n/a".
    """
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("region_id"), "value", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"))
    listed = (events.groupBy("hour", "region_id", F.floor(F.col("event_id") / 100).alias("part"))
              .agg(F.array_sort(F.collect_list(F.struct("event_id", "value"))).alias("es")))
    quantity = lambda e: F.when(e["value"] == F.floor(e["value"]), F.lit("n/a")).otherwise(e["value"].cast("string"))
    points = F.array_join(F.transform("es", lambda e, i: F.concat(
        F.lit("<Point><position>"), (i + 1).cast("string"), F.lit("</position><quantity>"), quantity(e),
        F.lit("</quantity></Point>"))), "")
    resolution = F.when(F.col("region_id") == "view", "PT15M").when(F.col("region_id") == "click", "PT30M").otherwise("PT60M")
    is_load = F.col("region_id") == "signup"
    psr = F.when(F.col("region_id").isin("view", "click"), "B19").when(F.col("region_id") == "purchase", "B18").otherwise("B04")
    kind_tag = F.when(is_load, F.lit("")).otherwise(F.concat(F.lit("<MktPSRType><psrType>"), psr, F.lit("</psrType></MktPSRType>")))
    xml = F.concat(
        F.lit('<GL_MarketDocument xmlns="urn:market:document:1"><TimeSeries>'), kind_tag,
        F.lit("<Period><timeInterval><start>"), F.date_format("hour", "yyyy-MM-dd'T'HH:mm'Z'"),
        F.lit("</start></timeInterval><resolution>"), resolution, F.lit("</resolution>"), points,
        F.lit("</Period></TimeSeries></GL_MarketDocument>"))
    return listed.select("hour", "region_id", F.when(is_load, "load").otherwise("generation").alias("kind"), xml.alias("xml"))


def error_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One acknowledgement per event; errors of type `error` carry a real reason."""
    reason = F.when(F.col("event_type") == "error", F.concat(F.lit("Invalid token "), F.col("event_id").cast("string"))) \
        .otherwise(F.lit("No matching data found"))
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("region_id"),
        F.concat(F.lit('<Acknowledgement_MarketDocument xmlns="urn:ack:1"><Reason><code>999</code><text>'), reason,
                 F.lit("</text></Reason></Acknowledgement_MarketDocument>")).alias("xml"))
