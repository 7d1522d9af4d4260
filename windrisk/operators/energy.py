"""Generation and load: code mapping, sums, long-to-wide, and the join with weather."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrisk.functions.timefn import hour_of, not_nan, parse_iso
from windrisk.schemas import AREA_OF_ZONE, EIC_REGION, LOAD, OFFSHORE, ONSHORE, REGIONS

KEY = ["timestamp", "region_id"]


def _lookup(table: dict[str, str], key: Column) -> Column:
    """Literal map with identity for unknown keys; the tables are fixed and short."""
    entries = [F.lit(part) for pair in table.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), key)


def region_of(code: Column) -> Column:
    return _lookup(EIC_REGION, code)


def area_of(zone: Column) -> Column:
    return _lookup(AREA_OF_ZONE, zone)


def normalise(raw: DataFrame, code: str = "region_id") -> DataFrame:
    """Long energy rows with UTC timestamps and known regions only.

    Rows with an unreadable timestamp, another variable or an unknown region are dropped;
    the variable filter reaches the scan.
    """
    rows = raw.where(F.col("variable").isin(ONSHORE, OFFSHORE, LOAD))
    if dict(rows.dtypes)["timestamp"] == "string":
        rows = rows.withColumn("timestamp", parse_iso(F.col("timestamp")))
    extra = [c for c in ("file_id",) if c in rows.columns]
    return (rows.select(*extra, "timestamp", region_of(F.col(code)).alias("region_id"), "variable",
                        not_nan(F.col("value_mwh")).alias("value_mwh"))
            .where(F.col("region_id").isin(REGIONS) & F.col("timestamp").isNotNull()))


def sums_per_file(rows: DataFrame) -> DataFrame:
    """Sum per (file, timestamp, region, variable). A group without any number sums to zero."""
    return (rows.groupBy("file_id", *KEY, "variable")
            .agg(F.coalesce(F.sum("value_mwh"), F.lit(0.0)).alias("value_mwh")))


def wide(rows: DataFrame, hourly: bool = False) -> DataFrame:
    """One row per (timestamp, region) with onshore, offshore and load columns.

    Duplicates across files add up. Where a key has any wind row, the missing wind kind is 0;
    where it has none, both kinds are NULL; load is NULL where no load row exists. Since
    the files only ever add, one hash aggregate gives the same as a sum per file, an outer
    join and a second sum.

    `hourly=True` averages the points of an hour within each file first, for sources with 15 or 30 minute points; it needs `file_id`.
    """
    if hourly:
        if "file_id" not in rows.columns:
            raise ValueError("hourly means are taken per file: file_id is missing")
        rows = (rows.withColumn("timestamp", hour_of(F.col("timestamp")))
                .groupBy("file_id", *KEY, "variable").agg(F.avg("value_mwh").alias("value_mwh")))
    kind = F.col("variable")
    def total(code: str) -> Column:
        return F.coalesce(F.sum(F.when(kind == code, F.col("value_mwh"))), F.lit(0.0))
    has_wind = F.count_if(kind.isin(ONSHORE, OFFSHORE)) > 0
    has_load = F.count_if(kind == LOAD) > 0
    return rows.groupBy(*KEY).agg(
        F.when(has_wind, total(ONSHORE)).alias("wind_onshore_mwh"),
        F.when(has_wind, total(OFFSHORE)).alias("wind_offshore_mwh"),
        F.when(has_load, total(LOAD)).alias("total_load_mwh"))


def generation_rows(rows: DataFrame) -> DataFrame:
    """Onshore and offshore of each file side by side, missing kind 0, load NULL."""
    per_file = sums_per_file(rows.where(F.col("variable").isin(ONSHORE, OFFSHORE)))
    def one(code: str, name: str) -> DataFrame:
        return per_file.where(F.col("variable") == code).select("file_id", *KEY, F.col("value_mwh").alias(name))
    joined = one(ONSHORE, "wind_onshore_mwh").join(one(OFFSHORE, "wind_offshore_mwh"), ["file_id", *KEY], "full_outer")
    return joined.select(
        "file_id", *KEY,
        F.coalesce("wind_onshore_mwh", F.lit(0.0)).alias("wind_onshore_mwh"),
        F.coalesce("wind_offshore_mwh", F.lit(0.0)).alias("wind_offshore_mwh"),
        F.lit(None).cast("double").alias("total_load_mwh"))


def load_rows(rows: DataFrame) -> DataFrame:
    """Load of each file in the five-column shape, wind NULL."""
    missing = F.lit(None).cast("double")
    return (sums_per_file(rows.where(F.col("variable") == LOAD))
            .select("file_id", *KEY, missing.alias("wind_onshore_mwh"), missing.alias("wind_offshore_mwh"),
                    F.col("value_mwh").alias("total_load_mwh")))


def stacked(rows: DataFrame) -> DataFrame:
    """Generation rows and load rows under one schema."""
    return generation_rows(rows).unionByName(load_rows(rows))


def with_weather(weather: DataFrame, energy: DataFrame) -> DataFrame:
    """Weather with load of its zone and wind generation of its control area.

    Load is published per zone, generation for some zones only per area: two left joins on
    keys that start with the timestamp. `generation_region` says which level was used.
    """
    load = energy.select(*KEY, "total_load_mwh")
    wind = energy.select("timestamp", F.col("region_id").alias("generation_region"),
                         "wind_onshore_mwh", "wind_offshore_mwh")
    return (weather.withColumn("generation_region", area_of(F.col("region_id")))
            .join(load, KEY, "left")
            .join(wind, ["timestamp", "generation_region"], "left")
            .select(*KEY, "generation_region", "wind_speed_mps", "wind_onshore_mwh", "wind_offshore_mwh",
                    "total_load_mwh"))
