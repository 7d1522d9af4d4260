"""What one task reads or holds stays the same however many rows there are."""

import datetime as dt
import glob

import pandas as pd
import pyarrow as pa

from conftest import TESTDATA
from windrisk.plans import adapters, catalog
from windrisk.sources import files, topic
from windrisk.streaming import jobs, state

SF = f"{TESTDATA}/sf0.001"
T0 = dt.datetime(2024, 1, 1)


def test_grid_files_are_of_bounded_size_and_hold_all_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "GRID_FILE_ROWS", 700)
    path, n = str(tmp_path / "grid"), adapters.grid(spark, SF).count()
    catalog._grid_files(spark, SF, path)
    sizes = [spark.read.parquet(f).count() for f in glob.glob(f"{path}/whole/*.parquet")]
    assert max(sizes) <= 700 and sum(sizes) == n and len(sizes) >= n // 700
    assert sorted(r.why for r in files.skipped_files(spark, path).collect()) == ["broken", "unreadable"]


def test_dealt_rows_get_more_tasks_as_they_grow(spark, monkeypatch):
    rows = adapters.grid(spark, SF)
    assert catalog._dealt(rows, 3).rdd.getNumPartitions() == 3
    monkeypatch.setattr(catalog, "GRID_PART_ROWS", 1000)
    assert catalog._dealt(rows, 3).rdd.getNumPartitions() == 3 + rows.count() // 1000 > 8
    assert catalog.QUERIES["k5_recomputed_means"](spark, SF).first()["again"] is False


def test_streams_before_their_topic_need_no_python(spark, tmp_path):
    """Hours and correlations are column functions; Python reads and writes the topic only."""
    rows = catalog._ordered_obs(spark, SF)
    rows.write.parquet(str(tmp_path / "rows"))
    stream = jobs.file_stream(spark, str(tmp_path / "rows"), rows.schema)
    plan = jobs.window_correlations(jobs.hourly_snapshots(stream, ("timestamp", "event_id")))._jdf.queryExecution().analyzed().toString()
    assert "EventTimeWatermark" in plan
    plan += jobs.window_correlations(jobs.hourly_snapshots(rows, ("timestamp", "event_id")))._jdf.queryExecution().executedPlan().toString()
    assert not [name for name in ("Python", "Pandas", "ArrowEval", "MapIn") if name in plan]


def test_a_writing_task_holds_one_batch(tmp_path, monkeypatch):
    """Batches come from a generator that sees how many earlier ones are still held."""
    monkeypatch.setattr(topic, "SEGMENT_ROWS", 10_000)
    alive, most = [], 0

    def batches():
        nonlocal most
        for i in range(40):
            batch = pa.table({"timestamp": pa.array([T0] * 1000, pa.timestamp("us", tz="UTC")), "key": ["A", "B"] * 500,
                              "value": [f"{i}-{j}-{'x' * 1000}" for j in range(1000)]}).to_batches()[0]
            alive.append(pa.total_allocated_bytes())
            most = max(most, alive[-1] - alive[0])
            yield batch
    path = str(tmp_path / "topic")
    writer = topic.TopicWriter(path, "q", 2)
    writer.commit([writer.write(batches())])
    segments = topic.Log(path).segments()
    assert sum(s["rows"] for s in segments) == 40_000 and max(s["rows"] for s in segments) == 10_000
    assert most < 16_000_000  # all batches are 40 MB, and Arrow keeps pages of two open segments
    for s in segments:
        values = [v for part in topic._slices(path, {}, topic.Log(path).ends()) if part.file == s["file"]
                  for b in topic._read(path, part) for v in b.column("value").to_pylist()]
        assert values == sorted(values, key=lambda v: tuple(map(int, v.split("-")[:2])))


def test_many_episodes_of_one_key_cost_one_state_entry_each():
    """Timers read their own episodes; the state of a key is never read whole for one of them."""
    calls = {"iterator": 0, "read": 0}

    class Handle:
        def __init__(self):
            self.state, self.timers = {}, set()

        def getMapState(self, name, key, value):
            return self

        def iterator(self):
            calls["iterator"] += 1
            return iter(list(self.state.items()))

        def containsKey(self, key):
            return key in self.state

        def getValue(self, key):
            calls["read"] += 1
            return self.state[key]

        def updateValue(self, key, value):
            self.state[key] = value

        def removeKey(self, key):
            self.state.pop(key, None)

        def registerTimer(self, at):
            self.timers.add(at)

    class Fired:
        def __init__(self, at):
            self.at = at

        def getExpiryTimeInMs(self):
            return self.at

    handle, episodes = Handle(), state.Episodes(dt.timedelta(hours=6))
    episodes.init(handle)
    starts = [T0 + dt.timedelta(hours=10 * i + j) for i in range(300) for j in (0, 1)]
    frame = pd.DataFrame({"window_start": starts, "window_end": [s + dt.timedelta(hours=6) for s in starts], "strength": 0.5})
    for part in (frame.iloc[::2], frame.iloc[1::2]):
        list(episodes.handleInputRows(("A,B",), iter([part.iloc[:100], part.iloc[100:]]), None))
    out = pd.concat([f for at in sorted(handle.timers) for f in episodes.handleExpiredTimer(("A,B",), None, Fired(at))])
    assert len(out) == 300 and set(out.windows) == {2} and not handle.state
    assert calls == {"iterator": 2, "read": 300}
