"""The replayable topic, and state processors: restarts, late rows, end marks, episodes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from windrisk.session import work_path
from windrisk.sources import topic
from windrisk.streaming import jobs, state

T0 = dt.datetime(2024, 1, 1)
OBS = "timestamp timestamp, region_id string, wind_speed_mps double, seq long"
HOUR = dt.timedelta(hours=1)


def observations(n=60, seed=1):
    rng = random.Random(seed)
    return [(T0 + dt.timedelta(minutes=7 * i), rng.choice("ABC"), rng.choice([None, float(i)]), i) for i in range(n)]


def run(df, path, checkpoint):
    query = jobs.run_to_files(df, path, checkpoint)
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def test_topic_keeps_order_keys_and_offsets(spark, tmp_path):
    path = str(tmp_path / "topic")
    data = observations()
    for part in (data[:25], data[25:26], data[26:]):
        topic.append(spark.createDataFrame(part, OBS), path, "region_id")
    rows = topic.rows_of(topic.read(spark, path), OBS).collect()
    assert sorted((r.timestamp, r.region_id, r.wind_speed_mps, r.seq) for r in rows if r.wind_speed_mps is not None) == \
        sorted(d for d in data if d[2] is not None) and len(rows) == len(data)
    for p in {r.partition for r in rows}:
        mine = sorted(r.offset for r in rows if r.partition == p)
        assert mine == list(range(len(mine)))
    assert all(len({r.partition for r in rows if r.region_id == z}) == 1 for z in "ABC")


def test_an_empty_topic_reads_empty(spark, tmp_path):
    assert topic.read(spark, str(tmp_path / "none")).count() == 0


def test_restarted_reader_gives_each_row_once(spark, tmp_path):
    source, copy, checkpoint = (str(tmp_path / n) for n in ("source", "copy", "checkpoint"))
    data = observations()
    for part in (data[:10], data[10:40], data[40:]):
        topic.append(spark.createDataFrame(part, OBS), source, "region_id")
        rows = topic.rows_of(topic.stream(spark, source), OBS).drop("partition", "offset")
        topic.publish(rows, copy, checkpoint, "region_id", "copy").awaitTermination()
    assert sorted(r.seq for r in topic.rows_of(topic.read(spark, copy), OBS).collect()) == list(range(len(data)))


def test_a_batch_run_again_is_committed_once(spark, tmp_path):
    """The commit of a batch that failed after its log entry: the same writer and batch add nothing."""
    path = str(tmp_path / "topic")
    row = {"timestamp": T0.replace(tzinfo=dt.timezone.utc), "key": "A", "value": "{}"}
    writer = topic.TopicWriter(path, "q", 2)
    lost = writer.write(iter([row] * 3))  # a task whose batch never commits
    assert topic.Log(path).ends() == {} and lost.segments[0]["rows"] == 3
    for _ in range(2):
        writer.commit([writer.write(iter([row] * 5))], 0)
    writer.commit([writer.write(iter([row])), None], 1)
    assert sum(topic.Log(path).ends().values()) == 6 and topic.read(spark, path).count() == 6


def direct_hours(data):
    hours = {}
    for ts, zone, value, seq in sorted(data, key=lambda r: (r[0], r[3])):
        hours.setdefault(ts.replace(minute=0, second=0), {})[zone] = value
    return hours


def hours_of(spark, path):
    return {r.window.start: r.regions for r in path.collect()}


def test_hours_close_by_timers_and_the_end_mark_across_restarts(spark, tmp_path):
    source = str(tmp_path / "source")
    data = observations(80)
    out = None
    for part in (data[:30], data[30:55], data[55:], [(T0 + 40 * HOUR, None, None, 0)]):
        topic.append(spark.createDataFrame(part, OBS), source, "region_id")
        snaps = jobs.hourly_snapshots(topic.rows_of(topic.stream(spark, source), OBS), ("timestamp", "seq"))
        out = run(snaps, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        found = [r.window.start for r in out.collect()]
        assert len(found) == len(set(found))
    assert hours_of(spark, out) == direct_hours(data)


def test_rows_of_closed_hours_are_dropped_and_late_rows_of_open_hours_count(spark, tmp_path):
    source = str(tmp_path / "source")
    parts = [[(T0, "A", 1.0, 1), (T0 + HOUR, "A", 2.0, 2)], [(T0 + 3.2 * HOUR, "A", 3.0, 3)], [(T0 + 3.3 * HOUR, "A", 4.0, 4)],
             [(T0 + 0.5 * HOUR, "A", 99.0, 5), (T0 + 2.5 * HOUR, "A", 5.0, 6)], [(T0 + 40 * HOUR, None, None, 0)]]
    for part in parts:
        topic.append(spark.createDataFrame(part, OBS), source, "region_id")
        snaps = jobs.hourly_snapshots(topic.rows_of(topic.stream(spark, source), OBS), ("timestamp", "seq"))
        out = run(snaps, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = hours_of(spark, out)
    assert got == {T0: {"A": 1.0}, T0 + HOUR: {"A": 2.0}, T0 + 2 * HOUR: {"A": 5.0}, T0 + 3 * HOUR: {"A": 4.0}}


WARNED = "zones string, window_start timestamp, window_end timestamp, strength double"


def direct_episodes(windows):
    out = []
    for zones in sorted({w[0] for w in windows}):
        open_ = None
        for _, start, end, strength in sorted(w for w in windows if w[0] == zones):
            if open_ and start < open_[2]:
                open_ = (zones, open_[1], max(open_[2], end), max(open_[3], strength), open_[4] + 1)
            else:
                out += [open_] if open_ else []
                open_ = (zones, start, end, strength, 1)
        out.append(open_)
    return sorted(out)


@pytest.mark.parametrize("cuts", [(1000,), (3, 9, 14)])
def test_overlapping_warnings_become_episodes(spark, tmp_path, cuts):
    starts = [0, 1, 2, 8, 9, 20, 26, 27, 50]  # 20 and 26 touch, but do not overlap
    windows = [(z, T0 + s * HOUR, T0 + (s + 6) * HOUR, 0.5 + (s * 7 % 10) / 20) for s in starts for z in ("A,B", "A,C") if z == "A,B" or s % 2 == 0]
    windows.sort(key=lambda w: w[2])
    source, out, last = str(tmp_path / "source"), None, 0
    for cut in (*cuts, None):
        part = windows[last:cut] if cut else [(None, None, T0 + 500 * HOUR, None)] if last >= len(windows) else windows[last:]
        last = cut or len(windows)
        topic.append(spark.createDataFrame(part, WARNED), source, "zones", "window_end")
        found = jobs.warning_episodes(topic.rows_of(topic.stream(spark, source), WARNED).drop("partition", "offset"))
        out = run(found, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    if last >= len(windows):
        topic.append(spark.createDataFrame([(None, None, T0 + 500 * HOUR, None)], WARNED), source, "zones", "window_end")
        found = jobs.warning_episodes(topic.rows_of(topic.stream(spark, source), WARNED).drop("partition", "offset"))
        out = run(found, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert sorted(tuple(r) for r in out.select("zones", "episode_start", "episode_end", "peak", "windows").collect()) == direct_episodes(windows)
