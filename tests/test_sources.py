"""Readers, writers, gates and calendars."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from windrisk.functions import timefn
from windrisk.sources import calendar, files, gates, kafka, market_xml, sinks

OBS = "timestamp timestamp, region_id string, wind_speed_mps double"


@pytest.fixture()
def obs(spark):
    data = [(dt.datetime(2023, 12, 31, 23), "SE1", 4.0), (dt.datetime(2024, 1, 1, 0), "SE1", 5.0),
            (dt.datetime(2024, 1, 1, 0), "SE2", None)]
    return spark.createDataFrame(data, OBS)


def test_weather_grid_renames_time_and_skips_broken_files(spark, tmp_path):
    grid = spark.sql("SELECT timestamp'2024-01-01' AS valid_time, 60.0D AS latitude, 15.0D AS longitude, 3.0D AS u10, 4.0D AS v10")
    grid.coalesce(1).write.parquet(str(tmp_path / "a"))
    (tmp_path / "a" / "broken.parquet").write_bytes(b"not parquet at all")
    read = files.weather_grid(spark, str(tmp_path))
    assert read.columns == ["file_id", "timestamp", "latitude", "longitude", "u10", "v10"]
    assert read.count() == 1
    skipped = [r.file_id for r in files.skipped_files(spark, str(tmp_path)).collect()]
    assert len(skipped) == 1 and skipped[0].endswith("broken.parquet")


def test_old_time_name(spark):
    assert "timestamp" in files.rename_time(spark.sql("SELECT 1 AS time")).columns
    assert "timestamp" in files.rename_time(spark.sql("SELECT 1 AS valid_time")).columns


def test_csv_good_and_bad_lines(spark, tmp_path):
    for prefix, text in (("generation", "2024-01-01T00:00Z,SE,B19,10.5\n2024-01-01T00:00Z,SE,B18,oops\n"),
                         ("load", "2024-01-01T00:00:00Z,SE1,load_mwh,7\n")):
        (tmp_path / prefix).mkdir()
        (tmp_path / prefix / "x.csv").write_text("timestamp,region_id,variable,value_mwh\n" + text)
        (tmp_path / prefix / "note.txt").write_text("ignored")
    table = files.energy_csv(spark, str(tmp_path / "generation"), str(tmp_path / "load"))
    good = files.good_rows(table)
    assert rows(good.select("region_id", "variable", "value_mwh")) == [("SE", "B19", 10.5), ("SE1", "load_mwh", 7.0)]
    assert good.select("region_id").count() == 2
    bad = files.bad_rows(table)
    assert bad.count() == 1 and "oops" in bad.first()["_corrupt_record"]


def test_fallback_keeps_columns(spark, obs, tmp_path):
    obs.createOrReplaceTempView("weather_obs_test")
    path = str(tmp_path / "silver")
    assert files.weather_or_table(spark, path, "weather_obs_test").first().source == "table"
    obs.limit(0).write.parquet(path)
    assert files.weather_or_table(spark, path, "weather_obs_test").first().source == "table"
    obs.write.mode("overwrite").parquet(path)
    assert files.weather_or_table(spark, path, "weather_obs_test").first().source == "silver"
    spark.createDataFrame([], OBS).createOrReplaceTempView("weather_obs_empty")
    empty = files.weather_or_table(spark, str(tmp_path / "none"), "weather_obs_empty")
    assert empty.count() == 0 and empty.columns[:3] == ["timestamp", "region_id", "wind_speed_mps"]


def test_wind_alias(spark, obs, tmp_path):
    obs.withColumnRenamed("wind_speed_mps", "wind_speed").write.parquet(str(tmp_path / "s"))
    assert files.silver_weather(spark, str(tmp_path / "s")).columns == ["timestamp", "region_id", "wind_speed_mps"]


def test_gold_missing_is_none(spark, tmp_path):
    assert files.gold_forecasts(spark, str(tmp_path / "none")) is None
    assert files.empty_forecasts(spark).count() == 0


def test_jdbc_options_split_the_read():
    options = files.jdbc_options("jdbc:postgresql://db/grid", "weather_obs", "2019-01-01", "2025-01-01", 12)
    assert options["partitionColumn"] == "timestamp" and options["numPartitions"] == "12"


def test_years_prune(spark, obs, tmp_path):
    path = str(tmp_path / "years")
    sinks.write_by_year(obs, path)
    assert {p.name for p in (tmp_path / "years").glob("year=*")} == {"year=2023", "year=2024"}
    part = sinks.read_years(spark, path, dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1))
    assert part.count() == 2
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_append_skips_empty_frames(spark, obs, tmp_path):
    assert sinks.append_tables({"a": obs, "b": obs.limit(0)}, str(tmp_path)) == ["a"]
    assert sinks.append_tables({"a": obs}, str(tmp_path)) == ["a"]
    assert spark.read.parquet(str(tmp_path / "a")).count() == 6


def test_replace_table(spark, obs):
    assert sinks.replace_table(None, ["x"]) is None
    name = sinks.replace_table(obs, ["gold", "weather"])
    assert name == "gold_weather"
    sinks.replace_table(obs.limit(1), ["gold", "weather"])
    assert spark.table(name).count() == 1


def test_content_hash_ignores_order_but_sees_duplicates(spark, obs):
    digest = gates.content_hash(obs)
    assert gates.content_hash(obs.orderBy(F.desc("region_id")).select("wind_speed_mps", "timestamp", "region_id")) == digest
    assert gates.content_hash(obs.unionByName(obs)) != digest
    assert gates.content_hash(obs.unionByName(obs).unionByName(obs)) != digest
    assert gates.content_hash(obs.withColumn("region_id", F.lit("SE9"))) != digest
    assert gates.content_hash(obs.limit(0)).n_rows == 0


def test_write_if_changed(spark, obs, tmp_path):
    folder = str(tmp_path)
    assert sinks.write_if_changed(obs, folder, "t")
    assert not sinks.write_if_changed(obs.repartition(3), folder, "t")
    assert sinks.write_if_changed(obs.limit(1), folder, "t")
    assert sinks.write_if_changed(obs, folder, "t")
    assert not sinks.write_if_changed(None, folder, "t")
    assert spark.read.parquet(f"{folder}/t").count() == 3


def test_retrain_gate(spark, obs, tmp_path):
    folder = str(tmp_path)
    assert sinks.retrain_needed(obs, folder, "m")
    sinks.mark_trained(obs, folder, "m")
    assert sinks.retrain_needed(obs, folder, "m")  # no stored result yet
    sinks.overwrite_parquet(obs, f"{folder}/m")
    assert not sinks.retrain_needed(obs, folder, "m")
    assert sinks.retrain_needed(obs.limit(2), folder, "m")


def test_freshness(spark, obs, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    assert not gates.is_fresh(spark, target, [(source, "parquet")])
    obs.write.parquet(source)
    assert not gates.is_fresh(spark, target, [(source, "parquet")])
    obs.write.parquet(target)
    assert gates.is_fresh(spark, target, [(source, "parquet")])
    sinks.write_energy_csv(spark.sql("SELECT '2024-01-01T00:00Z' AS timestamp, 'SE' AS region_id, 'B19' AS variable, 1.0D AS value_mwh"),
                           str(tmp_path / "csv"))
    assert not gates.is_fresh(spark, target, [(source, "parquet"), (str(tmp_path / "csv"), "csv")])


def test_run_log_keeps_numbers_only(spark, tmp_path):
    path = str(tmp_path / "log")
    sinks.log_run(spark, path, "r", {"m": 5}, {"a": 1, "b": 2.5, "flag": True, "text": "x", "none": None, "list": [1]}, {"t": "hsgp"})
    got = {(r.kind, r.key): r.value for r in spark.read.parquet(path).collect()}
    assert got == {("param", "m"): None, ("metric", "a"): 1.0, ("metric", "b"): 2.5, ("metric", "flag"): 1.0, ("tag", "t"): None}


def test_missing_keys(spark):
    manifest = spark.createDataFrame([("a",), ("b",)], "key string")
    assert rows(gates.missing_keys(manifest, manifest.where("key = 'a'"))) == [("b",)]


def test_calendar(spark):
    start, end = dt.date(2023, 12, 15), dt.date(2024, 2, 1)
    assert calendar.month_range(start, end) == [dt.date(2023, 12, 1), dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    with pytest.raises(ValueError):
        calendar.month_range(end, start)
    assert calendar.month_range(end, start, strict=False) == []
    got = rows(calendar.months(spark, start, end))
    assert got == [(dt.date(2023, 12, 1), "202312010000", "202401010000", 31),
                   (dt.date(2024, 1, 1), "202401010000", "202402010000", 31),
                   (dt.date(2024, 2, 1), "202402010000", "202403010000", 29)]
    assert calendar.months(spark, end, start, strict=False).count() == 0


@pytest.mark.parametrize("text, want", [
    ("2024-01-01T00:00Z", dt.datetime(2024, 1, 1)), ("2024-01-01T00:00:30Z", dt.datetime(2024, 1, 1, 0, 0, 30)),
    ("2024-01-01T02:00:00+02:00", dt.datetime(2024, 1, 1)), ("2024-01-01 05:06:07", dt.datetime(2024, 1, 1, 5, 6, 7)),
    (" 2024-01-01T00:00Z ", dt.datetime(2024, 1, 1)), ("junk", None), ("2024-13-01T00:00Z", None), ("", None)])
def test_parse_iso(spark, text, want):
    assert spark.range(1).select(timefn.parse_iso(F.lit(text)).cast("timestamp_ntz")).first()[0] == want


DOC = """<?xml version="1.0"?><GL_MarketDocument xmlns="urn:doc:1">
<TimeSeries><MktPSRType><psrType> B19 </psrType></MktPSRType>
 <Period><timeInterval><start>2024-01-01T00:00Z</start></timeInterval><resolution>PT15M</resolution>
  <Point><position>1</position><quantity>1.5</quantity></Point><Point><position>3</position><quantity>2</quantity></Point>
  <Point><position>x</position><quantity>9</quantity></Point><Point><position>4</position></Point></Period>
 <Period><timeInterval><start>2024-01-02T00:00Z</start></timeInterval><resolution>PT30M</resolution>
  <Point><position>2</position><quantity>4</quantity></Point></Period></TimeSeries>
<TimeSeries><MktPSRType><psrType>B16</psrType></MktPSRType>
 <Period><timeInterval><start>2024-01-01T00:00Z</start></timeInterval><resolution>P1D</resolution>
  <Point><position>2</position><quantity>5</quantity></Point></Period></TimeSeries></GL_MarketDocument>"""
ACK = '<Acknowledgement_MarketDocument xmlns="urn:ack"><Reason><code>999</code><text>{}</text></Reason></Acknowledgement_MarketDocument>'


def test_market_xml(spark):
    docs = spark.createDataFrame([("SE", DOC), ("NO", ACK.format("No matching data found")), ("FI", "<broken"),
                                  ("DK1", "<Other/>")], "region_id string, xml string")
    got = market_xml.points(docs, "generation").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert rows(got) == [(dt.datetime(2024, 1, 1, 0, 0), "SE", "B19", 1.5), (dt.datetime(2024, 1, 1, 0, 30), "SE", "B19", 2.0),
                         (dt.datetime(2024, 1, 2, 0, 30), "SE", "B19", 4.0)]
    load = market_xml.points(docs, "load").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert load.count() == 4 and load.where("variable <> 'load_mwh'").count() == 0
    assert dt.datetime(2024, 1, 1, 1) in [r.timestamp for r in load.collect()]
    with pytest.raises(ValueError):
        market_xml.points(docs, "other")


def test_acknowledgements(spark):
    docs = spark.createDataFrame([("SE", DOC), ("NO", ACK.format("No Matching Data found")), ("FI", ACK.format("Bad token")),
                                  ("DK1", "<Acknowledgement_MarketDocument/>")], "region_id string, xml string")
    got = {r.region_id: (r.reason, r.is_error) for r in market_xml.acknowledgements(docs).collect()}
    assert got == {"NO": ("No Matching Data found", False), "FI": ("Bad token", True), "DK1": ("(no reason)", True)}


def test_kafka_options_and_payloads(spark, obs):
    assert kafka.source_options("b:9092", kafka.WEATHER_TOPIC)["subscribe"] == "weather-obs"
    messages = kafka.encode(obs).select("value", F.lit(0).alias("partition"), F.lit(7).cast("long").alias("offset"))
    back = kafka.decode(messages)
    assert rows(back.select("timestamp", "region_id", "wind_speed_mps")) == rows(obs)
