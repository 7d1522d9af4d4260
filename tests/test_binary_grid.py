"""Binary grids: round trips, packed and interleaved variables, pruned reads, slices, broken files."""

import datetime as dt
import io
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from windrisk.sources import binary_grid as bg

HOUR = dt.timedelta(hours=1)
START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def long_grid(spark):
    data = [(f"f{m}", START + (24 * 31 * m + h) * HOUR, 55.0 + i, 10.0 + j, float(h + i) / 3, None if (h + j) % 7 == 0 else float(h * j) - 0.1)
            for m in range(3) for h in range(24) for i in range(3) for j in range(4)]
    return spark.createDataFrame(data, "month string, timestamp timestamp, latitude double, longitude double, u10 double, v10 double").cache()


@pytest.fixture(scope="module")
def folder(long_grid, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("grids"))
    assert bg.write_binary_grid(long_grid, path, "month").count() == 3
    return path


def test_round_trip_whole_and_in_slices(spark, long_grid, folder):
    want = rows(long_grid.drop("month"))
    for split in (bg.SPLIT_BYTES, 700):
        read = bg.binary_grid(spark, folder, split_bytes=split)
        assert rows(read.drop("file_id")) == want
        assert read.select("file_id").distinct().count() == 3
    assert bg.binary_grid(spark, folder, split_bytes=700).rdd.getNumPartitions() > 3


def test_times_and_variables_are_pruned(spark, long_grid, folder):
    read = bg.binary_grid(spark, folder, ("v10",), START + 2 * HOUR, START + 5 * HOUR)
    assert read.columns == ["file_id", "timestamp", "latitude", "longitude", "v10"]
    want = long_grid.where((F.col("timestamp") >= F.lit(START + 2 * HOUR)) & (F.col("timestamp") < F.lit(START + 5 * HOUR)))
    assert rows(read.select("timestamp", "latitude", "longitude", "v10")) == rows(want.select("timestamp", "latitude", "longitude", "v10"))

    class Counted(io.BytesIO):
        n = 0

        def read(self, *size):
            out = super().read(*size)
            self.n += len(out)
            return out
    lat = lon = np.arange(50.0)
    hours = np.arange(100) * 3_600_000_000
    cube = np.arange(100 * 50 * 50, dtype=float).reshape(100, 50, 50)
    raw = bg.encoded(hours, lat, lon, {"u10": cube, "v10": -cube})
    stream = Counted(raw)
    got = list(bg.GridFile(stream, len(raw)).rows(["v10"], 0, 1, int(hours[10]), int(hours[13])))
    assert np.array_equal(np.concatenate([g[3] for g in got]), -cube[10:13].ravel())
    assert stream.n < bg.HEAD_BYTES + 100 * 8 + 3 * 50 * 50 * 8 + 2000


def classic(version=1, records=2, streaming=False, wide=False):
    """A hand-made file: packed shorts of two cells along an unlimited `valid_time` in hours since 1900, fixed latitude and longitude."""
    count = ">q" if version == 5 else ">i"
    n = lambda *v: b"".join(struct.pack(count, x) for x in v)
    text = lambda s: n(len(s)) + s.encode() + b"\0" * (-len(s) % 4)
    i4 = lambda *v: struct.pack(f">{len(v)}i", *v)
    offset = ">i" if version == 1 else ">q"
    units = "hours since 1900-01-01 00:00:00.0"
    packed = (i4(12) + n(3) + text("scale_factor") + i4(6) + n(1) + struct.pack(">d", 0.5) + text("add_offset") + i4(6) + n(1) + struct.pack(">d", 10.0)
              + text("_FillValue") + i4(3) + n(1) + struct.pack(">hh", -32767, 0))
    none = i4(0) + n(0)
    named = i4(12) + n(1) + text("units") + i4(2) + text(units)

    def header(begin):
        out = b"CDF" + bytes([version]) + (b"\xff" * len(n(0)) if streaming else n(records))
        out += i4(10) + n(3) + text("valid_time") + n(0) + text("latitude") + n(1) + text("longitude") + n(3) + none + i4(11) + n(4)
        for name, dims, attributes, kind, size, at in (("latitude", [1], none, 5, 4, 0), ("longitude", [2], none, 5, 12, 4),
                                                       ("valid_time", [0], named, 4, 4, 16), ("u10", [0, 1, 2], packed, 3, 8, 20)):
            out += text(name) + n(len(dims)) + n(*dims) + attributes + i4(kind) + n(size) + struct.pack(offset, begin + at)
        return out
    begin = len(header(0))
    body = struct.pack(">ffff", 60.0, 1.0, 2.0, 3.0)
    for r in range(records):
        body += struct.pack(">i", 1_087_000 + r) + struct.pack(">hhhh", r, -32767, 4, 0)
    return header(begin) + body


@pytest.mark.parametrize("version, streaming", [(1, False), (2, False), (5, False), (1, True)])
def test_packed_interleaved_records_of_every_version(version, streaming):
    raw = classic(version, streaming=streaming)
    [(time, lat, lon, u10, v10)] = bg.GridFile(io.BytesIO(raw), len(raw)).rows(["u10", "v10"], 0, 1, None, None)
    first = dt.datetime(1900, 1, 1) + 1_087_000 * HOUR
    assert [dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(t)) for t in time[::3]] == [first, first + HOUR]
    assert lat.tolist() == [60.0] * 6 and lon.tolist() == [1.0, 2.0, 3.0] * 2
    assert np.array_equal(u10, [10.0, np.nan, 12.0, 10.5, np.nan, 12.0], equal_nan=True) and np.isnan(v10).all()


def test_broken_files_are_skipped_whole_and_reported(spark, tmp_path):
    good = classic()
    bad = {"cut": good[:-3], "head": good[:60], "other": b"HDF and more", "none": b"", "count": good[:8] + b"\x7f" * 8 + good[16:],
           "unit": good.replace(b"hours since", b"weeks since"), "nolat": good.replace(b"latitude", b"altitude")}
    for name, raw in {"good": good, "empty": classic(records=0), **bad}.items():
        (tmp_path / f"{name}.nc").write_bytes(raw)
    (tmp_path / "note.txt").write_bytes(b"no grid file")
    assert bg.binary_grid(spark, str(tmp_path)).select("u10").count() == 6
    report = {r.file_id.rsplit("/", 1)[1][:-3]: r for r in bg.grid_report(spark, str(tmp_path)).collect()}
    assert {n for n, r in report.items() if r.why} == set(bad) and set(report) == {"good", "empty", *bad}
    assert (report["good"].n_times, report["good"].n_cells, report["empty"].n_times) == (2, 3, 0)
    assert bg.binary_grid(spark, str(tmp_path / "nothing")).count() == 0
