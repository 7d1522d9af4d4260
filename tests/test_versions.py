"""Committed versions: isolation of readers, failed and competing writes, the hash tree, and what counts as a change."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from conftest import rows
from windrisk.sources import gates, versions

SCHEMA = "timestamp timestamp, region_id string, wind_speed_mps double"


def at(day, hour=0, year=2024):
    return dt.datetime(year, 1, 1) + dt.timedelta(days=day, hours=hour)


@pytest.fixture()
def hours(spark):
    data = [(at(d, h, y), z, float(d * h + y)) for y in (2023, 2024) for d in (0, 40, 90) for h in range(24) for z in ("SE1", "SE2")]
    return spark.createDataFrame([*data, (None, "SE1", 1.0)], SCHEMA).cache()


def parts_written(path):
    return {f.split("/data/")[1] for f in glob.glob(f"{path}/data/*/*/*")}


def test_one_changed_hour_rewrites_one_part(spark, hours, tmp_path):
    path = str(tmp_path / "t")
    assert versions.newest(spark, path) == -1
    assert versions.commit(hours, path) == 0
    first = parts_written(path)
    assert len(first) == 7
    assert versions.commit(hours.repartition(3).select("wind_speed_mps", "timestamp", "region_id").select(*hours.columns), path) is None
    hour = (F.col("timestamp") == F.lit(at(40, 5))) & (F.col("region_id") == "SE2")
    edited = hours.withColumn("wind_speed_mps", F.when(hour, -1.0).otherwise(F.col("wind_speed_mps")))
    assert versions.commit(edited, path) == 1
    assert len(parts_written(path) - first) == 1
    change = versions.changes(spark, path, 0, 1).collect()
    assert [(c.year, c.slot, c.kind, c.first, c.last, c.n_rows) for c in change] == [(2024, 1, "changed", at(40, 0), at(40, 23), 48)]
    assert rows(versions.read(spark, path)) == rows(edited) and rows(versions.read(spark, path, 0)) == rows(hours)


def test_added_and_removed_parts(spark, hours, tmp_path):
    path = str(tmp_path / "t")
    versions.commit(hours.where("year(timestamp) = 2023"), path)
    versions.commit(hours.where("year(timestamp) = 2024 OR month(timestamp) > 1"), path)
    got = sorted((c.year, c.slot, c.kind, c.n_rows, c.n_rows_before) for c in versions.changes(spark, path, 0, 1).collect())
    assert got == [(2023, 0, "removed", 0, 48)] + [(2024, s, "added", 48, 0) for s in (0, 1, 2)]
    assert versions.changes(spark, path, 1, 1).count() == 0
    tree = {(n.level, n.year, n.slot): n for n in versions.tree_of(spark, path, 1).collect()}
    leaves = [n for (level, year, _), n in tree.items() if level == 2 and year == 2024]
    assert tree[1, 2024, None].total == sum(n.total for n in leaves) and tree[0, None, None].n_rows == 240


def test_a_write_that_fails_half_way_leaves_the_old_version(spark, hours, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.commit(hours, path)
    before = versions.read(spark, path)
    broken = hours.withColumn("wind_speed_mps", F.col("wind_speed_mps") + 1.0)

    def fails(self, version, content):
        raise OSError("lost before the pointer")
    with monkeypatch.context() as m:
        m.setattr(versions._Pointers, "publish", fails)
        with pytest.raises(OSError):
            versions.commit(broken, path)
    assert len(glob.glob(f"{path}/data/*")) == 2
    assert versions.newest(spark, path) == 0 and rows(versions.read(spark, path)) == rows(hours) == rows(before)
    assert versions.commit(broken, path) == 1
    # The reader that was planned before the overwrite still sees its version.
    assert rows(before) == rows(hours) and rows(versions.read(spark, path)) == rows(broken)


def test_a_competing_writer_is_refused(spark, hours, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.commit(hours, path)
    publish = versions._Pointers.publish

    def late(self, version, content):
        monkeypatch.setattr(versions._Pointers, "publish", publish)
        versions.commit(hours.limit(3), path)
        publish(self, version, content)
    monkeypatch.setattr(versions._Pointers, "publish", late)
    with pytest.raises(RuntimeError):
        versions.commit(hours.limit(5), path)
    assert versions.newest(spark, path) == 1 and versions.read(spark, path).count() == 3


def test_rename_never_replaces_a_pointer(spark, tmp_path):
    pointers = versions._Pointers(spark, str(tmp_path))
    pointers.publish(0, {"a": 1})
    with pytest.raises(RuntimeError):
        pointers.publish(0, {"a": 2})
    assert pointers.read(0) == {"a": 1} and pointers.newest() == 0


def test_ranges_open_only_their_parts(spark, hours, tmp_path):
    path = str(tmp_path / "t")
    versions.commit(hours, path)
    some = versions.read(spark, path, start=at(40, 3), end=at(40, 6))
    assert some.count() == 6 and len({f.rsplit("/", 1)[0] for f in some.inputFiles()}) == 1
    assert versions.read(spark, path, start=at(500)).count() == 0


def test_empty_schema_slots_and_copies(spark, hours, tmp_path):
    path = str(tmp_path / "t")
    assert versions.commit(hours.limit(0), path) == 0
    assert versions.commit(hours.limit(0), path) is None and versions.read(spark, path).columns == hours.columns
    assert versions.commit(hours, path) == 1
    assert versions.commit(hours.withColumn("year", F.lit(5)), path) == 2
    assert versions.read(spark, path).agg(F.sum("year")).first()[0] == 5 * hours.count()
    with pytest.raises(ValueError):
        versions.commit(hours, path, slot_days=2)
    with pytest.raises(FileNotFoundError):
        versions.read(spark, str(tmp_path / "none"))


def test_large_parts_are_dealt_to_several_files_also_if_all_rows_are_equal(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "PART_FILE_ROWS", 500)
    same = spark.range(2000, numPartitions=4).select(F.lit(at(1)).alias("timestamp"), F.lit("SE1").alias("region_id"), F.lit(1.0).alias("wind_speed_mps"))
    # Tasks of a few rows would be put together again, by size.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        versions.commit(same, str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = versions.read(spark, str(tmp_path / "t"))
    assert got.count() == 2000 and len(got.inputFiles()) > 1


def test_significant_digits(spark):
    def digest(*values):
        return gates.content_hash(spark.createDataFrame([(v,) for v in values], "x double"))
    base = digest(1e-9, 10.0, -0.3, 0.0, None)
    assert digest(1.00000000000003e-9, 9.999999999999998, -0.30000000000000004, -0.0, None) == base
    assert digest(1.001e-9, 10.0, -0.3, 0.0, None) != base
    assert digest(1e-9, 10.0, 0.3, 0.0, None) != base and digest(1e-9, 1.0, -0.3, 0.0, None) != base
    assert digest(1e-9, 10.0, -0.3, None, None) != base
    assert len({str(digest(x)) for x in (float("nan"), float("inf"), float("-inf"), 1e-310, 1.7e308, 0.0, None)}) == 7
