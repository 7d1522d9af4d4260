"""A replayable topic in a folder: partitions, offsets, and a commit log, as a Spark data source and sink. No server.

    <path>/segments/<uuid>.parquet      rows (offset in segment, timestamp, key, value) of one partition, written by one task
    <path>/log/<n>.json                 one commit: writer, batch, and for each segment its partition, first offset and rows

A task writes segments; only the commit of its batch names them, so what a lost task or a failed batch left behind is never read.
A commit is one new file that must not exist yet. A batch that is run again after a failure finds its own commit in the log and adds
nothing. Offsets are counted by the log, so a reader that starts again from a checkpoint reads each row once, and a
reader from offset 0 sees the whole topic again in the same order per partition.

`path` is a file system that pyarrow knows (a mounted folder, file:// or an object store), not one that only Spark reads. One
writing query per topic at a time. Rows with one key go to one partition (crc32 of the key; NULL to partition 0).
"""

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

FORMAT = "replay_topic"
SCHEMA = "partition int, offset long, timestamp timestamp, key string, value string"
PARTITIONS = 4
SEGMENT_ROWS = 1 << 16
# Rows of a segment that a reading task holds at once.
READ_ROWS = 1 << 13
# Spark's JSON writer cuts timestamps to milliseconds unless told otherwise.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_SEGMENT = pa.schema([("timestamp", pa.timestamp("us", tz="UTC")), ("key", pa.string()), ("value", pa.string())])


class Log:
    """The commit log of one topic."""

    def __init__(self, path: str):
        self.files, self.root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        self.root = self.root.rstrip("/")

    def _names(self) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/log", allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name.endswith(".json"))

    def commits(self) -> list[dict]:
        out = []
        for name in self._names():
            with self.files.open_input_stream(f"{self.root}/log/{name}") as stream:
                out.append(json.loads(stream.read()))
        return out

    def segments(self) -> list[dict]:
        return [s for commit in self.commits() for s in commit["segments"]]

    def ends(self) -> dict[str, int]:
        """Offset after the last row of every partition."""
        out: dict[str, int] = {}
        for s in self.segments():
            out[str(s["partition"])] = s["first"] + s["rows"]
        return out

    def commit(self, writer: str, batch: int, written: list[dict]) -> bool:
        """Name the segments of a batch; False if the log has that batch already."""
        known = self.commits()
        if any(c["writer"] == writer and c["batch"] == batch for c in known):
            return False
        ends = self.ends()
        segments = []
        for s in sorted(written, key=lambda s: (s["partition"], s["file"])):
            first = ends.get(str(s["partition"]), 0)
            segments.append({**s, "first": first})
            ends[str(s["partition"])] = first + s["rows"]
        self.files.create_dir(f"{self.root}/log", recursive=True)
        name = f"{self.root}/log/{len(known):012d}.json"
        aside = f"{name}.{uuid.uuid4().hex}.tmp"
        # Written aside and moved, so that a reader never sees half a commit.
        with self.files.open_output_stream(aside) as stream:
            stream.write(json.dumps({"writer": writer, "batch": batch, "segments": segments}).encode())
        if self.files.get_file_info(name).type != fs.FileType.NotFound:
            raise RuntimeError(f"another writer has committed {name}")
        self.files.move(aside, name)
        return True


@dataclass
class Slice(InputPartition):
    """Rows `low` to `high` of a segment whose first row has offset `first`."""
    file: str
    partition: int
    first: int
    low: int
    high: int


@dataclass
class Written(WriterCommitMessage):
    segments: list


def _read(path: str, part: Slice) -> Iterator[pa.RecordBatch]:
    log, at = Log(path), 0
    with log.files.open_input_file(f"{log.root}/segments/{part.file}") as handle:
        for batch in pq.ParquetFile(handle).iter_batches(READ_ROWS, use_threads=False):
            kept = batch.slice(max(part.low - at, 0), max(min(part.high - at, batch.num_rows) - max(part.low - at, 0), 0))
            if n := kept.num_rows:
                start = part.first + max(part.low, at)
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(part.partition, pa.int32()), n), pa.array(range(start, start + n), pa.int64()),
                                                  *[kept.column(c) for c in _SEGMENT.names]], ["partition", "offset", *_SEGMENT.names])
            at += batch.num_rows


def _slices(path: str, start: dict[str, int], end: dict[str, int]) -> list[Slice]:
    out = []
    for s in Log(path).segments():
        name = str(s["partition"])
        low, high = max(start.get(name, 0), s["first"]), min(end.get(name, 0), s["first"] + s["rows"])
        if low < high:
            out.append(Slice(s["file"], s["partition"], s["first"], low - s["first"], high - s["first"]))
    return out


class TopicReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Slice]:
        # Spark wants one partition at least; an empty topic has one without rows.
        return _slices(self.path, {}, Log(self.path).ends()) or [Slice("", 0, 0, 0, 0)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if partition.file:
            yield from _read(self.path, partition)


class TopicStreamReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return Log(self.path).ends()

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return _slices(self.path, start, end)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        yield from _read(self.path, partition)

    def commit(self, end: dict) -> None:
        """The topic keeps its rows; other readers may still want them."""


class TopicWriter(DataSourceStreamArrowWriter, DataSourceArrowWriter):
    """Takes Arrow batches, or single rows. Each batch goes to the open segments at once, so a task never holds more than a batch."""

    def __init__(self, path: str, writer: str, partitions: int):
        self.path, self.writer, self.n = path, writer, partitions

    def _partition(self, key: str | None) -> int:
        return zlib.crc32(key.encode()) % self.n if key is not None else 0

    def _dealt(self, batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Table]]:
        """The rows of a batch by partition, in their order."""
        table = pa.table([batch.column(f.name).cast(f.type) for f in _SEGMENT], schema=_SEGMENT)
        keys = pc.dictionary_encode(table.column("key").combine_chunks(), null_encoding="encode")
        of_key = pa.array([self._partition(k) for k in keys.dictionary.to_pylist()], pa.int32())
        partition = of_key.take(keys.indices)
        for p in sorted(set(of_key.to_pylist())):
            yield p, table.filter(pc.equal(partition, p))

    def write(self, iterator: Iterator) -> Written:
        log = Log(self.path)
        log.files.create_dir(f"{log.root}/segments", recursive=True)
        opened: dict[int, tuple[str, pq.ParquetWriter]] = {}
        counts: dict[int, int] = {}
        done: list[dict] = []

        def close(p: int) -> None:
            name, segment = opened.pop(p)
            segment.close()
            done.append({"partition": p, "file": name, "rows": counts.pop(p)})

        for item in iterator:
            batch = item if isinstance(item, pa.RecordBatch) else pa.RecordBatch.from_pylist([item], schema=_SEGMENT)
            for p, rows in self._dealt(batch):
                while rows.num_rows:
                    if p not in opened:
                        name = f"{uuid.uuid4().hex}.parquet"
                        opened[p] = name, pq.ParquetWriter(f"{log.root}/segments/{name}", _SEGMENT, filesystem=log.files)
                    now = rows.slice(0, SEGMENT_ROWS - counts.get(p, 0))
                    opened[p][1].write_table(now)
                    counts[p] = counts.get(p, 0) + now.num_rows
                    if counts[p] >= SEGMENT_ROWS:
                        close(p)
                    rows = rows.slice(now.num_rows)
        for p in list(opened):
            close(p)
        return Written(done)

    def commit(self, messages, batchId: int = 0) -> None:
        Log(self.path).commit(self.writer, batchId, [s for m in messages if m is not None for s in m.segments])

    def abort(self, messages, batchId: int = 0) -> None:
        """Segments that no commit names are never read."""


class ReplayTopic(DataSource):
    """Options: path; for writing also writer (name of the query, needed to tell its batches) and partitions."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options["path"])

    def streamReader(self, schema) -> TopicStreamReader:
        return TopicStreamReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> TopicWriter:
        # Every batch write is a commit of its own.
        return TopicWriter(self.options["path"], uuid.uuid4().hex, int(self.options.get("partitions", PARTITIONS)))

    def streamWriter(self, schema, overwrite: bool) -> TopicWriter:
        return TopicWriter(self.options["path"], self.options["writer"], int(self.options.get("partitions", PARTITIONS)))


def register(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(ReplayTopic)
    return spark


def messages(rows: DataFrame, key: str, timestamp: str = "timestamp") -> DataFrame:
    """(timestamp, key, value) with the whole row as JSON."""
    return rows.select(F.col(timestamp).alias("timestamp"), F.col(key).cast("string").alias("key"), F.to_json(F.struct(*rows.columns), _JSON).alias("value"))


def rows_of(messages: DataFrame, schema: str) -> DataFrame:
    """The columns of the JSON payloads, with partition and offset."""
    return messages.select(F.from_json("value", schema, _JSON).alias("row"), "partition", "offset").select("row.*", "partition", "offset")


def append(rows: DataFrame, path: str, key: str, timestamp: str = "timestamp") -> None:
    """Add the rows of a table in one commit."""
    register(rows.sparkSession)
    messages(rows, key, timestamp).write.format(FORMAT).mode("append").option("path", path).save()


def read(spark: SparkSession, path: str) -> DataFrame:
    return register(spark).read.format(FORMAT).option("path", path).load()


def stream(spark: SparkSession, path: str) -> DataFrame:
    # With it, a run to the end of the topic adds the batch without data in which an end mark closes open windows. The setting warns
    # of sources whose end offset moves under a running query; the log only grows, and the offset is taken once.
    spark.conf.set("spark.sql.streaming.triggerAvailableNowWrapper.enabled", "true")
    return register(spark).readStream.format(FORMAT).option("path", path).load()


def publish(rows: DataFrame, path: str, checkpoint: str, key: str, writer: str, timestamp: str = "timestamp"):
    """Append a stream to a topic until its input is used up; each batch is committed once, whatever fails between."""
    register(rows.sparkSession)
    return (messages(rows, key, timestamp).writeStream.format(FORMAT).option("path", path).option("writer", writer)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
