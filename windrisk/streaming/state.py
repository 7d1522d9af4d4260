"""A stateful processor with event-time timers: warnings joined into episodes that close themselves.

A bounded stream ends with an end mark: a row without zone, timed after all others. It only moves the watermark; timers then close
whatever is open, so every result comes from the stream itself. State lies in RocksDB with the checkpoint, so a restarted query
goes on where it stood.
"""

import datetime as dt
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def with_state(spark: SparkSession) -> SparkSession:
    """Timers and state variables need the RocksDB store; to be set before a query starts."""
    spark.conf.set(*STATE_STORE)
    return spark


def _naive(moment) -> dt.datetime:
    """Timestamps come as UTC, with or without a zone."""
    return pd.Timestamp(moment).to_pydatetime().replace(tzinfo=None)


def _millis(moment: dt.datetime) -> int:
    return int(moment.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def _merged(episodes: list[tuple]) -> list[tuple]:
    """(start, end, peak, windows) with overlapping ones joined."""
    out: list[tuple] = []
    for start, end, peak, n in sorted(episodes):
        if out and start < out[-1][1]:
            first, last, top, m = out[-1]
            out[-1] = (first, max(last, end), max(top, peak), m + n)
        else:
            out.append((start, end, peak, n))
    return out


class Episodes(StatefulProcessor):
    """Overlapping windows of one set of zones as one episode; given out when no window can overlap it any more."""

    def __init__(self, longest: dt.timedelta):
        self.longest = longest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # By the time of their timer, so that a timer reads its own episodes only.
        self.open = handle.getMapState("open", "fires long", "episodes string")

    def _fires(self, end: dt.datetime) -> int:
        return _millis(end + self.longest)

    def _by_timer(self, episodes: list[tuple]) -> dict[int, str]:
        out: dict[int, list] = {}
        for start, end, peak, n in episodes:
            out.setdefault(self._fires(end), []).append([start.isoformat(), end.isoformat(), peak, n])
        return {fires: json.dumps(found) for fires, found in out.items()}

    @staticmethod
    def _episodes(text: str) -> list[tuple]:
        return [(dt.datetime.fromisoformat(s), dt.datetime.fromisoformat(e), p, n) for s, e, p, n in json.loads(text)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is not None:
            before = {k[0]: v[0] for k, v in self.open.iterator()}
            merged = [e for text in before.values() for e in self._episodes(text)]
            # Frame by frame: what is held is the open episodes and one frame, not all rows of the key.
            for frame in rows:
                merged = _merged(merged + [(_naive(r.window_start), _naive(r.window_end), float(r.strength), 1) for r in frame.itertuples(index=False)])
            after = self._by_timer(merged)
            for fires in before.keys() - after.keys():
                self.open.removeKey((fires,))
            for fires, text in after.items():
                if before.get(fires) != text:
                    self.open.updateValue((fires,), (text,))
                    self.handle.registerTimer(fires)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        fires = (expiredTimerInfo.getExpiryTimeInMs(),)
        # No episode if it has grown since: then it has a later timer.
        if self.open.containsKey(fires):
            ended = self._episodes(self.open.getValue(fires)[0])
            self.open.removeKey(fires)
            yield pd.DataFrame(ended, columns=["episode_start", "episode_end", "peak", "windows"]).assign(zones=key[0])[
                ["zones", "episode_start", "episode_end", "peak", "windows"]]

    def close(self) -> None:
        pass


def episodes(warnings: DataFrame, longest: dt.timedelta) -> DataFrame:
    """(zones, episode_start, episode_end, peak, windows) of a stream of (zones, window_start, window_end, strength).

    Windows of at most `longest` that overlap make one episode; its peak is the greatest strength. An end mark has no zones.
    A warning may come up to an hour of event time after others, so that windows with one end need not come in one batch.
    """
    with_state(warnings.sparkSession)
    timed = warnings.withColumn("closes", F.col("window_end") - F.expr("INTERVAL '0.001' SECOND")).withWatermark("closes", "1 hour")
    return timed.groupBy("zones").transformWithStateInPandas(
        Episodes(longest), "zones string, episode_start timestamp, episode_end timestamp, peak double, windows long",
        outputMode="Append", timeMode="EventTime")
