"""Weather grids in the classic binary format (CDF-1, CDF-2 and CDF-5), read in slices by Spark tasks and written one file per group.

A file is a header (dimensions, attributes, variables) and big-endian arrays; variables along the unlimited dimension are interleaved
record by record. The driver lists names and sizes only. A task takes pieces of files of at most SPLIT_BYTES; it reads a file's header and its times,
then only the bytes of the wanted variables at the wanted times of its piece, a few megabytes at once.

`path` is a folder (searched to the bottom) of a file system that pyarrow knows. Time is `valid_time`, `time` or `timestamp`, in units of "<unit> since
<date>"; cells are `latitude` by `longitude`. Packed values (scale_factor, add_offset) are unpacked; _FillValue, missing_value and NaN are NULL.

Defined results: a file that is no grid, is cut off, or has other dimensions gives no rows at all and is listed with the reason by
`grid_report`; failing storage fails the task instead. A variable that a file does not have is NULL. No files, or files without times, give no rows.
"""

import datetime as dt
import math
import re
import struct
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from windrisk.sources.files import TIME_COLUMNS

FORMAT = "binary_grid"
SPLIT_BYTES, READ_BYTES, HEAD_BYTES = 64 << 20, 8 << 20, 1 << 16
# Fixed values of the format: element types by code, the tags of the header lists, seconds of the time units.
TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: "u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
DIMENSIONS, VARIABLES, ATTRIBUTES = 10, 11, 12
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
_SINCE = re.compile(r"\s*(\w+?)s?\s+since\s+(\d+)-(\d+)-(\d+)(?:[T ]+(\d+):(\d+)(?::(\d+))?)?")
_BROKEN = (ValueError, KeyError, IndexError, OverflowError, struct.error)


@dataclass
class Variable:
    dims: list[int]
    attributes: dict
    kind: np.dtype
    begin: int
    is_record: bool


def _padded(n: int) -> int:
    return n + -n % 4


class GridFile:
    """Header of one open file, and reads of times and values."""

    def __init__(self, stream, size: int):
        self.stream, self.size = stream, size
        self.head, self.at = stream.read(HEAD_BYTES), 0
        magic = self._take(4)
        if magic[:3] != b"CDF" or magic[3] not in (1, 2, 5):
            raise ValueError("no classic grid file")
        self.wide, self.far = magic[3] == 5, magic[3] != 1
        stored = self._take(8 if self.wide else 4)
        self.dims = [(self._name(), self._count()) for _ in range(self._list(DIMENSIONS))]
        self._attributes()
        self.variables = {}
        sizes = []
        for _ in range(self._list(VARIABLES)):
            name = self._name()
            dims = [self._count() for _ in range(self._count())]
            attributes = self._attributes()
            kind = np.dtype(TYPES[self._int(4)])
            self._count()  # The stored size is of no use for large variables.
            v = Variable(dims, attributes, kind, self._int(8 if self.far else 4), bool(dims) and self.dims[dims[0]][1] == 0)
            self.variables[name] = v
            if v.is_record:
                sizes.append(self._bytes(v))
        # A single record variable is not padded.
        self.record = sizes[0] if len(sizes) == 1 else sum(map(_padded, sizes))
        unknown = stored == b"\xff" * len(stored)
        first = min((v.begin for v in self.variables.values() if v.is_record), default=size)
        self.records = (size - first) // self.record if unknown and self.record else 0 if unknown else int.from_bytes(stored, "big")
        self._whole()

    def _take(self, n: int) -> bytes:
        if n < 0 or self.at + n > self.size:
            raise ValueError("header cut off")
        while self.at + n > len(self.head):
            more = self.stream.read(max(len(self.head), self.at + n - len(self.head)))
            if not more:
                raise ValueError("header cut off")
            self.head += more
        self.at += n
        return self.head[self.at - n:self.at]

    def _int(self, n: int) -> int:
        return int.from_bytes(self._take(n), "big")

    def _count(self) -> int:
        return self._int(8 if self.wide else 4)

    def _name(self) -> str:
        n = self._count()
        return self._take(_padded(n))[:n].decode()

    def _list(self, tag: int) -> int:
        found, n = self._int(4), self._count()
        if found not in (0, tag) or (found == 0 and n):
            raise ValueError("broken header")
        return n

    def _attributes(self) -> dict:
        out = {}
        for _ in range(self._list(ATTRIBUTES)):
            name, kind, n = self._name(), np.dtype(TYPES[self._int(4)]), self._count()
            raw = self._take(_padded(n * kind.itemsize))[:n * kind.itemsize]
            out[name] = raw.rstrip(b"\0").decode() if kind.kind == "S" else np.frombuffer(raw, kind)
        return out

    def _bytes(self, v: Variable) -> int:
        """Bytes of one step along the first dimension, if that is unlimited, else of the whole variable."""
        return math.prod(self.dims[d][1] for d in v.dims[v.is_record:]) * v.kind.itemsize

    def _whole(self) -> None:
        for v in self.variables.values():
            steps = self.records if v.is_record else 1
            if steps and v.begin + (steps - 1) * self.record + self._bytes(v) > self.size:
                raise ValueError("data cut off")

    def read(self, v: Variable, low: int, high: int) -> np.ndarray:
        """Steps [low, high) along the first dimension, as stored: (steps, values of a step)."""
        inner = math.prod(self.dims[d][1] for d in v.dims[1:])
        step = inner * v.kind.itemsize
        if v.is_record and self.record != step:
            parts = [self._at(v.begin + i * self.record, step) for i in range(low, high)]
            raw = b"".join(parts)
        else:
            raw = self._at(v.begin + low * step, (high - low) * step)
        return np.frombuffer(raw, v.kind).reshape(high - low, inner)

    def _at(self, position: int, n: int) -> bytes:
        self.stream.seek(position)
        raw = self.stream.read(n)
        if len(raw) != n:
            raise OSError(f"{n} bytes wanted, {len(raw)} read")
        return raw

    def values(self, v: Variable, low: int, high: int) -> np.ndarray:
        """Unpacked doubles, NaN where there is none."""
        raw = self.read(v, low, high)
        out = raw.astype(np.float64)
        for name in ("_FillValue", "missing_value"):
            if name in v.attributes:
                out[raw == v.attributes[name][0]] = np.nan
        return out * float(v.attributes.get("scale_factor", [1.0])[0]) + float(v.attributes.get("add_offset", [0.0])[0])

    def axes(self) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
        """Dimensions of a cube of values, times (microseconds since 1970), latitudes and longitudes."""
        name = next((n for n in TIME_COLUMNS if n in self.variables), None)
        if name is None or not {"latitude", "longitude"} <= set(self.variables):
            raise ValueError("no time, latitude or longitude")
        sides = [self.variables[n] for n in (name, "latitude", "longitude")]
        if any(len(v.dims) != 1 for v in sides):
            raise ValueError("time, latitude and longitude need one dimension each")
        n = [self.records if v.is_record else self.dims[v.dims[0]][1] for v in sides]
        time, lat, lon = (self.values(v, 0, k).ravel() for v, k in zip(sides, n))
        since = _SINCE.match(sides[0].attributes.get("units", ""))
        if not since:
            raise ValueError("unknown time unit")
        unit, *parts = since.groups()
        start = dt.datetime(*[int(p or 0) for p in parts], tzinfo=dt.UTC)
        micros = np.rint(time * UNITS[unit.lower()] * 1e6).astype(np.int64) + int(start.timestamp()) * 1_000_000
        return [v.dims[0] for v in sides], micros, lat, lon

    def rows(self, names: Sequence[str], piece: int, pieces: int, low: int | None, high: int | None) -> Iterator[list[np.ndarray]]:
        """Columns time, latitude, longitude and values of one piece of the file, for times in [low, high)."""
        dims, times, lat, lon = self.axes()
        wanted = [self.variables.get(n) for n in names]
        if any(v is not None and v.dims != dims for v in wanted):
            raise ValueError("values need the dimensions time, latitude, longitude")
        n, cells = len(times), len(lat) * len(lon)
        own = np.arange(n * piece // pieces, n * (piece + 1) // pieces)
        own = own[((low is None) | (times[own] >= (low or 0))) & ((high is None) | (times[own] < (high or 0)))]
        if not len(own) or not cells:
            return
        # Runs of neighbouring steps, each read at once up to READ_BYTES.
        most = max(1, READ_BYTES // (8 * cells))
        for run in np.split(own, np.flatnonzero(np.diff(own) != 1) + 1):
            for a in range(int(run[0]), int(run[-1]) + 1, most):
                b = min(a + most, int(run[-1]) + 1)
                cubes = [np.full(((b - a), cells), np.nan) if v is None else self.values(v, a, b) for v in wanted]
                yield [np.repeat(times[a:b], cells), np.tile(np.repeat(lat, len(lon)), b - a), np.tile(lon, (b - a) * len(lat)), *[c.ravel() for c in cubes]]


@dataclass
class Pieces(InputPartition):
    """(file, piece, pieces) of one task."""
    of: list


def _file_system(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class GridReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.report = options["path"], options.get("report") == "true"
        self.names = [n for n in options.get("variables", "u10,v10").split(",") if n]
        self.suffix, self.split = options.get("suffix", ".nc"), int(options.get("splitbytes", SPLIT_BYTES))
        self.low, self.high = (int(options[k]) if k in options else None for k in ("low", "high"))

    def partitions(self) -> list[Pieces]:
        files, root = _file_system(self.path)
        found = files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        tasks, held, size = [], [], 0
        for f in sorted((f for f in found if f.type == fs.FileType.File and f.path.endswith(self.suffix)), key=lambda f: f.path):
            pieces = 1 if self.report else max(1, -(-f.size // self.split))
            for piece in range(pieces):
                if held and size + f.size // pieces > self.split:
                    tasks.append(Pieces(held))
                    held, size = [], 0
                held.append((f.path, piece, pieces))
                size += f.size // pieces
        return [*tasks, Pieces(held)]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        files, _ = _file_system(self.path)
        for name, piece, pieces in partition.of:
            size = files.get_file_info(name).size
            with files.open_input_file(name) as stream:
                if self.report:
                    yield self._reported(name, stream, size)
                    continue
                try:
                    grid = GridFile(stream, size)
                    for time, *numbers in grid.rows(self.names, piece, pieces, self.low, self.high):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(time)), pa.array(time, pa.timestamp("us", tz="UTC")), *[pa.array(c, from_pandas=True) for c in numbers]],
                            names=["file_id", "timestamp", "latitude", "longitude", *self.names])
                except _BROKEN:
                    continue  # Raised by header and axes only, before the first rows; see grid_report.

    def _reported(self, name: str, stream, size: int) -> pa.RecordBatch:
        why, n_times, n_cells = None, 0, 0
        try:
            grid = GridFile(stream, size)
            next(grid.rows(self.names, 0, 1, 0, 0), None)
            _, times, lat, lon = grid.axes()
            n_times, n_cells = len(times), len(lat) * len(lon)
        except _BROKEN as fault:
            why = str(fault) or type(fault).__name__
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n_times], pa.int64()), pa.array([n_cells], pa.int64()), pa.array([why], pa.string())],
                                          names=["file_id", "n_times", "n_cells", "why"])


class BinaryGrid(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        if self.options.get("report") == "true":
            return "file_id string, n_times long, n_cells long, why string"
        names = [n for n in self.options.get("variables", "u10,v10").split(",") if n]
        return ", ".join(["file_id string, timestamp timestamp, latitude double, longitude double", *[f"`{n}` double" for n in names]])

    def reader(self, schema) -> GridReader:
        return GridReader(self.options)


def _micros(time: dt.datetime) -> int:
    return int((time if time.tzinfo else time.replace(tzinfo=dt.UTC)).timestamp() * 1_000_000)


def binary_grid(spark: SparkSession, path: str, variables: Sequence[str] = ("u10", "v10"), start: dt.datetime | None = None,
                end: dt.datetime | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The long grid (file_id, timestamp, latitude, longitude, values) of all files under a folder, for times in [start, end)."""
    spark.dataSource.register(BinaryGrid)
    reader = spark.read.format(FORMAT).option("variables", ",".join(variables)).option("splitbytes", split_bytes)
    for key, time in (("low", start), ("high", end)):
        if time is not None:
            reader = reader.option(key, _micros(time))
    return reader.load(path)


def grid_report(spark: SparkSession, path: str, variables: Sequence[str] = ("u10", "v10")) -> DataFrame:
    """(file_id, n_times, n_cells, why) of all files; `why` is NULL for those that are read."""
    spark.dataSource.register(BinaryGrid)
    return spark.read.format(FORMAT).option("report", "true").option("variables", ",".join(variables)).load(path)


def _text(value: str) -> bytes:
    raw = value.encode()
    return struct.pack(">i", len(raw)) + raw + b"\0" * (-len(raw) % 4)


def _attribute(name: str, value: str | float) -> bytes:
    return _text(name) + (struct.pack(">i", 2) + _text(value) if isinstance(value, str) else struct.pack(">iid", 6, 1, value))


def encoded(times: np.ndarray, lat: np.ndarray, lon: np.ndarray, cubes: dict[str, np.ndarray]) -> bytes:
    """A file (CDF-2) of doubles; times in microseconds since 1970 along the unlimited dimension, cubes of (time, latitude, longitude)."""
    fill = 9.969209968386869e36
    axes = {"time": ([0], {"units": "seconds since 1970-01-01 00:00:00"}, 8), "latitude": ([1], {}, 8 * len(lat)), "longitude": ([2], {}, 8 * len(lon))}
    all_of = axes | {name: ([0, 1, 2], {"_FillValue": fill}, 8 * len(lat) * len(lon)) for name in cubes}

    def header(begins: dict[str, int]) -> bytes:
        out = b"CDF\x02" + struct.pack(">i", len(times)) + struct.pack(">ii", DIMENSIONS, 3)
        out += b"".join(_text(n) + struct.pack(">i", k) for n, k in (("time", 0), ("latitude", len(lat)), ("longitude", len(lon))))
        out += struct.pack(">iiii", 0, 0, VARIABLES, len(all_of))
        for name, (dims, attributes, size) in all_of.items():
            out += _text(name) + struct.pack(f">i{len(dims)}i", len(dims), *dims)
            out += struct.pack(">ii", ATTRIBUTES if attributes else 0, len(attributes)) + b"".join(_attribute(*a) for a in attributes.items())
            out += struct.pack(">iiq", 6, min(size, 2**31 - 4), begins.get(name, 0))
        return out

    at = len(header({}))
    begins = {"latitude": at, "longitude": at + 8 * len(lat), "time": at + 8 * (len(lat) + len(lon))}
    at = begins["time"] + 8
    for name in cubes:
        begins[name] = at
        at += 8 * len(lat) * len(lon)
    filled = [np.where(np.isnan(c), fill, c).astype(">f8").reshape(len(times), -1) for c in cubes.values()]
    records = np.hstack([(np.asarray(times) / 1e6).astype(">f8").reshape(-1, 1), *filled]).astype(">f8")
    return header(begins) + lat.astype(">f8").tobytes() + lon.astype(">f8").tobytes() + records.tobytes()


def write_binary_grid(df: DataFrame, path: str, file_col: str, variables: Sequence[str] = ("u10", "v10")) -> DataFrame:
    """Write one file per value of `file_col`, spanning its times and cells; (file, n_bytes) of the files written, already done.

    A file is made by one task, which holds its cube: choose `file_col` so that a file is one month or year. Several rows
    of a cell and time: the last of them in the order of their values. Rows with NULL time or place are left out.
    """
    names = list(variables)

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.dropna(subset=["micros", "latitude", "longitude"]).sort_values(names)
        (times, t), (lat, i), (lon, j) = (np.unique(rows[c].to_numpy(), return_inverse=True) for c in ("micros", "latitude", "longitude"))
        cubes = {}
        for name in names:
            cubes[name] = np.full((len(times), len(lat), len(lon)), np.nan)
            cubes[name][t, i, j] = rows[name].to_numpy(dtype=float)
        raw = encoded(times, lat.astype(float), lon.astype(float), cubes)
        files, root = _file_system(path)
        files.create_dir(root, recursive=True)
        target = f"{root.rstrip('/')}/{key[0]}.nc"
        # Written aside and moved, so that a task that runs twice leaves one whole file.
        with files.open_output_stream(aside := f"{target}.{uuid.uuid4().hex}.tmp") as stream:
            stream.write(raw)
        files.move(aside, target)
        return pd.DataFrame({"file": [target], "n_bytes": [len(raw)]})

    rows = df.selectExpr(f"CAST(`{file_col}` AS STRING) AS file", "unix_micros(CAST(timestamp AS TIMESTAMP)) AS micros", "latitude", "longitude",
                         *[f"`{n}`" for n in names]).where("file IS NOT NULL")
    done = rows.groupBy("file").applyInPandas(write, "file string, n_bytes long")
    return df.sparkSession.createDataFrame(done.toArrow(), done.schema)
