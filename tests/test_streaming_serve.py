"""Streams against their batch form, windows against a direct computation, and look-ups."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from windrisk.plans import serve
from windrisk.session import store
from windrisk.streaming import jobs

T0 = dt.datetime(2024, 1, 1)
OBS = "timestamp timestamp, region_id string, wind_speed_mps double, seq long"


def observations(hours=12, zones="ABC", seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for h in range(hours):
        for z in zones:
            for k in range(3):
                out.append((T0 + dt.timedelta(hours=h, minutes=15 * k), z, float(np.round(rng.normal(7, 2), 3)), len(out)))
    return out


def test_last_write_wins(spark):
    data = [(T0, "A", 1.0, 1), (T0, "A", 2.0, 2), (T0 + dt.timedelta(minutes=5), "B", 3.0, 3), (T0, None, 9.0, 4),
            (T0 + dt.timedelta(minutes=9), "B", None, 5)]
    got = jobs.hourly_snapshots(spark.createDataFrame(data, OBS), ("timestamp", "seq")).collect()
    assert len(got) == 1 and got[0].regions == {"A": 2.0, "B": None} and got[0].timestamp == T0


def direct_windows(data):
    """Six-hour windows by the hour over hourly last values; None rules as stated."""
    hours = {}
    for ts, z, v, seq in sorted(data, key=lambda r: (r[0], r[3])):
        hours.setdefault(ts.replace(minute=0), {})[z] = v
    out = {}
    for start in {h - dt.timedelta(hours=k) for h in hours for k in range(6)}:
        inside = [hours[h] for h in sorted(hours) if start <= h < start + dt.timedelta(hours=6)]
        zones = sorted(inside[0])
        values = [[s.get(z) for z in zones] for s in inside]
        if len(inside) < 2 or any(v is None for row in values for v in row):
            continue
        out[start] = (zones, np.corrcoef(np.array(values).T), np.mean(values, axis=0))
    return out


def check_events(events, want):
    got = {r.window_start: r for r in events.collect()}
    assert set(got) == set(want)
    for start, (zones, corr, means) in want.items():
        assert got[start].zone_ids == zones
        assert np.allclose(np.array(got[start].correlation_matrix), corr, atol=1e-9)
        assert [got[start].mean_wind_per_region[z] for z in zones] == pytest.approx(list(means))


def test_window_correlations(spark):
    data = [r for r in observations() if not (r[1] == "C" and r[0].hour == 8)]
    data += [(T0 + dt.timedelta(hours=11), "D", 1.0, 999)]
    snaps = jobs.hourly_snapshots(spark.createDataFrame(data, OBS), ("timestamp", "seq"))
    check_events(jobs.window_correlations(snaps), direct_windows(data))


def test_constant_zone_in_a_window_gives_null_not_an_error(spark):
    data = [(T0 + dt.timedelta(hours=h), z, 5.0 if z == "A" else float(h), h) for h in range(2) for z in "AB"]
    events = jobs.window_correlations(jobs.hourly_snapshots(spark.createDataFrame(data, OBS)))
    row = events.where(F.col("window_start") == F.lit(T0)).first()
    assert row.correlation_matrix == [[None, None], [None, 1.0]]
    assert jobs.early_warnings(events, -2.0).count() == 0


def test_early_warnings(spark):
    data = [(T0 + dt.timedelta(hours=h), z, h * s, h) for h in range(3) for z, s in (("A", 1.0), ("B", 2.0), ("C", 3.0))]
    events = jobs.window_correlations(jobs.hourly_snapshots(spark.createDataFrame(data, OBS)))
    assert jobs.early_warnings(events).count() == events.count() > 0
    other = [(t, z, -v if z == "C" else v, s) for t, z, v, s in data]
    events = jobs.window_correlations(jobs.hourly_snapshots(spark.createDataFrame(other, OBS)))
    assert jobs.early_warnings(events).count() == 0


def stream_of(spark, tmp_path, chunks, schema=OBS):
    """A file stream that sees one chunk per trigger, in order."""
    source = tmp_path / "source"
    for i, chunk in enumerate(chunks):
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(str(source))
    return jobs.file_stream(spark, str(source), spark.createDataFrame([], schema).schema, max_files=1)


def test_stream_equals_batch_across_triggers(spark, tmp_path):
    data = observations(16)
    chunks = [data[i:i + 36] for i in range(0, len(data), 36)]
    closing = [(T0 + dt.timedelta(hours=40), "A", 1.0, 9999)]  # pushes the watermark past all windows
    stream = stream_of(spark, tmp_path, [*chunks, closing])
    snaps = jobs.hourly_snapshots(stream, ("timestamp", "seq"))
    run = jobs.run_to_files(jobs.window_correlations(snaps), str(tmp_path / "out"), str(tmp_path / "check"))
    run.awaitTermination()
    check_events(spark.read.parquet(str(tmp_path / "out")), direct_windows(data))


def test_late_rows_are_dropped(spark, tmp_path):
    first = [(T0 + dt.timedelta(hours=5), "A", 1.0, 1), (T0 + dt.timedelta(hours=5), "B", 1.0, 2)]
    second = [(T0 + dt.timedelta(hours=9), "A", 2.0, 3)]
    late = [(T0 + dt.timedelta(hours=5, minutes=30), "A", 99.0, 4), (T0 + dt.timedelta(hours=12), "A", 3.0, 5)]
    # A row is late by the watermark of the trigger before, so one trigger lies in between.
    between = [(T0 + dt.timedelta(hours=9, minutes=10), "A", 2.0, 3)]
    stream = stream_of(spark, tmp_path, [first, second, between, late])
    flat = jobs.hourly_snapshots(stream, ("timestamp", "seq")).select(F.col("window.start").alias("hour"), "regions")
    run = jobs.run_to_files(flat, str(tmp_path / "out"), str(tmp_path / "check"))
    run.awaitTermination()
    got = {r.hour: r.regions for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[T0 + dt.timedelta(hours=5)] == {"A": 1.0, "B": 1.0}
    assert got[T0 + dt.timedelta(hours=9)] == {"A": 2.0}


def test_alert_stream(spark, tmp_path):
    schema = "region_id string, horizon_h int, p_shortfall double"
    stream = stream_of(spark, tmp_path, [[("SE1", 24, 0.95), ("SE2", 24, 0.5)], [("FI", 48, 0.9)]], schema)
    run = jobs.run_to_files(jobs.alert_stream(stream), str(tmp_path / "out"), str(tmp_path / "check"))
    run.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("region_id")) == [("FI",), ("SE1",)]


FORECASTS = [("SE1", 24, 0.1, 0.5, 2.1, 7.0, 12.3), ("SE2", 24, 0.2, 0.8, 1.9, 6.5, 11.0), ("DK1", 48, 0.15, 0.7, 2.5, 6.8, 11.5)]


@pytest.fixture()
def table(spark):
    df = spark.createDataFrame(FORECASTS, "region_id string, horizon_h int, " + ", ".join(f"{m} double" for m in serve.MEASURES))
    return df.withColumn("timestamp", F.lit(T0))


def test_forecast_lookup(spark, table):
    assert tuple(serve.forecast(spark, table, "se1").first()) == ("SE1", 24, 0.1, "ok")
    assert tuple(serve.forecast(spark, table, "SE4", 48).first()) == ("SE4", 48, 0.0, "stub")
    assert tuple(serve.forecast(spark, None, "SE1", 72).first()) == ("SE1", 72, 0.0, "stub")
    assert serve.forecast(spark, table.drop("p_shortfall"), "SE1").first().status == "stub"
    assert serve.forecast(spark, table.drop("horizon_h"), "DK1", 24).first().p_shortfall == 0.15


@pytest.mark.parametrize("region, horizon", [("XX1", 24), ("ZZ9", 24), ("SE1", 12), ("SE1", 36)])
def test_bad_arguments(spark, table, region, horizon):
    for call in (serve.forecast, serve.scenario):
        with pytest.raises(ValueError):
            call(spark, table, region, horizon)


def test_scenario_lookup(spark, table):
    assert tuple(serve.scenario(spark, table, "dk1", 48).first()) == ("DK1", 48, 0.15, 0.7, 2.5, 6.8, 11.5, "ok")
    assert tuple(serve.scenario(spark, table, "FI").first()) == ("FI", 24, None, None, None, None, None, "unavailable")
    partial = serve.scenario(spark, table.drop("wind_p10"), "SE1").first()
    assert partial.wind_p10 is None and partial.wind_p90 == 12.3 and partial.status == "ok"


def test_newest_row_wins(spark, table):
    newer = table.where("region_id = 'SE1'").withColumn("timestamp", F.lit(T0 + dt.timedelta(days=1))).withColumn("p_shortfall", F.lit(0.7))
    assert serve.forecast(spark, table.unionByName(newer), "SE1").first().p_shortfall == 0.7


def test_predicates_reach_the_scan(spark, table):
    stored = store(table)
    plan = serve.matching(stored, "SE1", 24)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(region_id,SE1)" in plan and "EqualTo(horizon_h,24)" in plan


def test_scenario_listing(spark, table):
    assert tuple(serve.scenario_summary(table, spark).first()) == (3, "ok")
    assert tuple(serve.scenario_summary(None, spark).first()) == (0, "unavailable")
    assert serve.scenario_summary(table.limit(0), spark).first().status == "unavailable"
    assert serve.scenarios(table).first().timestamp == "2024-01-01 00:00:00"
    record = serve.scenario_records(table.drop("wind_p50").where("region_id = 'SE1'")).first().record
    assert '"wind_p50":null' in record and '"p_shortfall":0.1' in record


def test_correlation_endpoint(spark):
    stub = serve.correlations(spark, None).first()
    assert stub.status == "stub" and stub.correlation_matrix == [] and len(stub.zone_ids) == 9
    matrix = spark.createDataFrame([("A", "A", 1.0), ("A", "B", 0.5), ("B", "A", 0.5), ("B", "B", 1.0)], "zone_a string, zone_b string, value double")
    served = serve.correlations(spark, matrix).first()
    assert served.zone_ids == ["A", "B"] and served.correlation_matrix == [[1.0, 0.5], [0.5, 1.0]] and served.status == "ok"
