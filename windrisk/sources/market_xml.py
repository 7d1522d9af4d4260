"""Market XML documents to long energy rows, and their acknowledgement (error) documents."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrisk.functions.timefn import parse_iso, point_time, resolution_minutes
from windrisk.schemas import LOAD, OFFSHORE, ONSHORE

# Fixed value: the parts of a document that are read.
DOCUMENT = """
    TimeSeries array<struct<
        MktPSRType: struct<psrType: string>,
        Period: array<struct<
            timeInterval: struct<start: string>,
            resolution: string,
            Point: array<struct<position: string, quantity: string>>>>>>
"""
ACKNOWLEDGEMENT = "Reason array<struct<code: string, text: string>>"
CORRUPT = "_corrupt_record"
ACKNOWLEDGEMENT_MARK = "Acknowledgement_MarketDocument"


def _is_acknowledgement():
    return F.col("xml").contains(ACKNOWLEDGEMENT_MARK)


def points(docs: DataFrame, kind: str | None = None) -> DataFrame:
    """(timestamp, region_id, variable, value_mwh) of every readable point.

    `kind` is 'generation' (wind series only, named by production type) or 'load'; without it, series with a
    production type are generation and those without are load. All
    periods of a series are read. Points without a whole position or a numeric quantity,
    and periods without a readable start, are dropped; explicit offsets are converted to UTC.
    """
    if kind not in ("generation", "load", None):
        raise ValueError(f"kind must be 'generation' or 'load', got {kind!r}")
    series = (docs.where(~_is_acknowledgement())
              .select("region_id", F.explode(F.from_xml("xml", DOCUMENT)["TimeSeries"]).alias("s")))
    production = F.trim(F.col("s.MktPSRType.psrType"))
    variable = {"generation": production, "load": F.lit(LOAD), None: F.coalesce(production, F.lit(LOAD))}[kind]
    if kind != "load":
        wanted = [OFFSHORE, ONSHORE] if kind else [OFFSHORE, ONSHORE, LOAD]
        series = series.where(variable.isin(wanted))
    periods = series.select("region_id", variable.alias("variable"), F.explode("s.Period").alias("p"))
    opened = periods.select(
        "region_id", "variable",
        parse_iso(F.col("p.timeInterval.start")).alias("start"),
        resolution_minutes(F.col("p.resolution")).alias("minutes"),
        F.explode("p.Point").alias("point"))
    read = opened.select(
        "region_id", "variable", "start", "minutes",
        F.trim("point.position").try_cast("int").alias("position"),
        F.trim("point.quantity").try_cast("double").alias("value_mwh"))
    kept = read.where(F.col("start").isNotNull() & F.col("position").isNotNull() & F.col("value_mwh").isNotNull())
    return kept.select(
        point_time(F.col("start"), F.col("position"), F.col("minutes")).alias("timestamp"),
        "region_id", "variable", "value_mwh")


def unreadable(docs: DataFrame) -> DataFrame:
    """Documents that are no well-formed XML; neither `points` nor `acknowledgements` can read them."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_xml("xml", f"{DOCUMENT.strip()}, {CORRUPT} string", options)
    return docs.where(F.col("xml").isNull() | parsed[CORRUPT].isNotNull())


def acknowledgements(docs: DataFrame) -> DataFrame:
    """Error documents with their reason; "no matching data" only means there is nothing to read."""
    read = docs.where(_is_acknowledgement()).select(
        "region_id", F.from_xml("xml", ACKNOWLEDGEMENT)["Reason"].alias("reasons"))
    reason = F.coalesce(F.try_element_at("reasons", F.lit(1))["text"], F.lit("(no reason)"))
    return (read.select("region_id", F.trim(reason).alias("reason"))
            .withColumn("is_error", ~F.lower("reason").contains("no matching data")))
