"""Committed versions of a table, with a hash tree that tells which parts of it have changed.

    <path>/data/<commit>/__year=../__slot=../   rows of the parts that a commit has written
    <path>/trees/<commit>/                      Parquet: one node per row (root, year, part), parts with their folder
    <path>/versions/<n>.json                    the pointer: commit, schema, slot length, root digest

A part is one slot of `slot_days` days of a year. Its digest is the order-free content hash of its rows; digests of a year and of the
root are those of all rows below, which counts, xors and sums give without reading the rows again. A commit compares its tree
with that of the newest version from the root down, writes the parts that differ, and names the old folders of all others.

The pointer is written aside and renamed to a name that must not exist, as checkpoint logs do. So a reader sees the old or the new version and
nothing between; a write that fails leaves the old one; of two writers at once, the later one is refused. Folders that
no version names are never read. On stores without an atomic rename, keep to one writer per table.

Defined results: rows without timestamp form the part of year 0. The same rows again are no new version. An empty table is a version without
parts. Another schema rewrites all parts; another slot length is refused. Floating numbers count to SIGNIFICANT digits (`gates`).
"""

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrisk.session import small_side, store
from windrisk.sources import gates

SLOT_DAYS = 31
PART_FILE_ROWS = 2_000_000
YEAR, SLOT = "__year", "__slot"
ROOT_LEVEL, YEAR_LEVEL, PART_LEVEL = 0, 1, 2


class _Pointers:
    """The pointer files, through the file system that Spark itself uses for the path."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self.jvm, conf = context._jvm, context._jsc.hadoopConfiguration()
        self.folder = f"{path.rstrip('/')}/versions"
        self.fs = self._path(self.folder).getFileSystem(conf)
        self.names = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def newest(self) -> int:
        """Number of the newest version, -1 before the first."""
        if not self.fs.exists(self._path(self.folder)):
            return -1
        found = [s.getPath().getName() for s in self.fs.listStatus(self._path(self.folder))]
        return max((int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit()), default=-1)

    def read(self, version: int) -> dict:
        stream = self.fs.open(self._path(f"{self.folder}/{version:012d}.json"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, version: int, content: dict) -> None:
        self.fs.mkdirs(self._path(self.folder))
        aside = self._path(f"{self.folder}/.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(aside, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        target = self._path(f"{self.folder}/{version:012d}.json")
        if self.fs.exists(target):
            raise RuntimeError(f"another writer has committed version {version}")
        # Without an overwrite option the rename fails if the name has been taken meanwhile.
        no_options = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        self.names.rename(aside, target, no_options)


def _slotted(df: DataFrame, time_col: str, slot_days: int) -> DataFrame:
    ts = F.col(f"`{time_col}`")
    slot = F.floor((F.dayofyear(ts) - 1) / F.lit(slot_days)).cast("int")
    return df.withColumns({YEAR: F.coalesce(F.year(ts), F.lit(0)), SLOT: F.coalesce(slot, F.lit(0))})


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    """Nodes above others: all parts of a digest add up."""
    return rows.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), F.bit_xor("xor").alias("xor"), F.sum("total").cast("decimal(38,0)").alias("total"),
                                   F.min("first").alias("first"), F.max("last").alias("last"))


def hash_tree(slotted: DataFrame, columns: list[str], time_col: str) -> DataFrame:
    """(level, year, slot, n_rows, xor, total, first, last) of every node. One pass over the rows, summed before the shuffle."""
    row = gates.row_hash(slotted, columns)
    ts = F.col(f"`{time_col}`").cast("timestamp")
    parts = slotted.select(F.col(YEAR).alias("year"), F.col(SLOT).alias("slot"), row.alias("xor"), row.cast("decimal(38,0)").alias("total"),
                           F.lit(1).cast("long").alias("n_rows"), ts.alias("first"), ts.alias("last"))
    parts = store(_sums(parts, "year", "slot"), "tree-parts")
    none = F.lit(None).cast("int")
    years = _sums(parts, "year").select(F.lit(YEAR_LEVEL).alias("level"), "year", none.alias("slot"), "n_rows", "xor", "total", "first", "last")
    root = _sums(parts.withColumn("all", F.lit(1)), "all").select(F.lit(ROOT_LEVEL).alias("level"), none.alias("year"), none.alias("slot"),
                                                                 "n_rows", "xor", "total", "first", "last")
    return parts.select(F.lit(PART_LEVEL).alias("level"), "*").unionByName(years).unionByName(root)


def _digest_of_root(tree: DataFrame) -> str:
    root = tree.where(F.col("level") == ROOT_LEVEL).first()
    return str(gates.ContentHash(root.n_rows, root.xor, int(root.total))) if root else str(gates.ContentHash(0, 0, 0))


def _differing(new: DataFrame, old: DataFrame, level: int, keys: list[str]) -> DataFrame:
    """Nodes of one level that only one tree has or that differ: keys and both sides' rows, first and last."""
    values = ["n_rows", "xor", "total", "first", "last"]

    def side(tree, mark):
        return tree.where(F.col("level") == level).select(*keys, *[F.col(v).alias(f"{mark}_{v}") for v in values])

    same = F.col("new_n_rows").eqNullSafe(F.col("old_n_rows")) & F.col("new_xor").eqNullSafe(F.col("old_xor")) & F.col("new_total").eqNullSafe(F.col("old_total"))
    return side(new, "new").join(side(old, "old"), keys, "full").where(~same)


def compare(new: DataFrame, old: DataFrame) -> DataFrame:
    """(year, slot, kind, first, last, n_rows, n_rows_before) of parts that differ, looked for only in years that differ."""
    years = small_side(_differing(new, old, YEAR_LEVEL, ["year"]).select("year"))
    within = [t.where(F.col("level") == PART_LEVEL).join(years, "year", "left_semi") for t in (new, old)]
    kind = F.when(F.col("old_n_rows").isNull(), "added").when(F.col("new_n_rows").isNull(), "removed").otherwise("changed")
    return _differing(*within, PART_LEVEL, ["year", "slot"]).select(
        "year", "slot", kind.alias("kind"), F.least("new_first", "old_first").alias("first"), F.greatest("new_last", "old_last").alias("last"),
        F.coalesce("new_n_rows", F.lit(0)).alias("n_rows"), F.coalesce("old_n_rows", F.lit(0)).alias("n_rows_before"))


def newest(spark: SparkSession, path: str) -> int:
    """Number of the newest committed version, -1 if there is none."""
    return _Pointers(spark, path).newest()


def tree_of(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The stored hash tree of a version."""
    return spark.read.parquet(f"{path.rstrip('/')}/trees/{_Pointers(spark, path).read(version)['commit']}")


def changes(spark: SparkSession, path: str, old: int, new: int) -> DataFrame:
    """What `compare` gives between two versions. Equal roots settle it without a look at the trees."""
    pointers = _Pointers(spark, path)
    left, right = pointers.read(new), pointers.read(old)
    found = compare(tree_of(spark, path, new), tree_of(spark, path, old))
    return found.limit(0) if left["root"] == right["root"] and left["schema"] == right["schema"] else found


def commit(df: DataFrame, path: str, time_col: str = "timestamp", slot_days: int = SLOT_DAYS) -> int | None:
    """Make `df` the table's newest version and write its changed parts; None if nothing has changed.

    The rows are computed once, into the work folder. Parts of many rows are dealt to several tasks by their counted size.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    pointers = _Pointers(spark, path)
    version = pointers.newest()
    known = pointers.read(version) if version >= 0 else None
    if known and known["slot_days"] != slot_days:
        raise ValueError(f"the table has slots of {known['slot_days']} days")
    staged = store(_slotted(df, time_col, slot_days), "versioned")
    tree = store(hash_tree(staged, sorted(df.columns), time_col), "hash-tree")
    root, schema, name = _digest_of_root(tree), df.schema.json(), uuid.uuid4().hex
    old = None
    if known and json.loads(known["schema"]) == json.loads(schema):
        if known["root"] == root:
            return None
        old = tree_of(spark, path, version)
    parts = tree.where(F.col("level") == PART_LEVEL)
    written = parts.select("year", "slot", "n_rows") if old is None else (
        compare(tree, old).where(F.col("kind") != "removed").select("year", "slot", "n_rows"))
    written = store(written.withColumn("files", F.ceil(F.col("n_rows") / F.lit(PART_FILE_ROWS))).drop("n_rows"), "written-parts")
    _write_parts(staged, written, time_col, f"{path}/data/{name}")
    fresh = written.select("year", "slot", F.lit(name).alias("new_folder"))
    nodes = tree.join(small_side(fresh), ["year", "slot"], "left")
    if old is None:
        nodes = nodes.withColumnRenamed("new_folder", "folder")
    else:
        before = old.where(F.col("level") == PART_LEVEL).select("year", "slot", F.col("folder").alias("old_folder"))
        nodes = nodes.join(small_side(before), ["year", "slot"], "left").withColumn(
            "folder", F.coalesce("new_folder", "old_folder")).drop("new_folder", "old_folder")
    nodes.write.parquet(f"{path}/trees/{name}")
    pointers.publish(version + 1, {"commit": name, "schema": schema, "slot_days": slot_days, "root": root, "parent": version})
    return version + 1


def _write_parts(staged: DataFrame, written: DataFrame, time_col: str, folder: str) -> None:
    """Rows of the named parts, each part dealt to as many tasks as it needs files."""
    sizes = small_side(written.select(F.col("year").alias(YEAR), F.col("slot").alias(SLOT), "files"))
    # Numbered, not hashed: equal rows would all go to one file.
    numbered = staged.withColumn("__row", F.monotonically_increasing_id())
    dealt = numbered.join(sizes, [YEAR, SLOT]).withColumn("__row", F.pmod("__row", "files")).drop("files")
    dealt = dealt.repartition(YEAR, SLOT, "__row").drop("__row")
    dealt.sortWithinPartitions(YEAR, SLOT, F.col(f"`{time_col}`")).write.partitionBy(YEAR, SLOT).parquet(folder)


def read(spark: SparkSession, path: str, version: int | None = None, start: datetime | None = None, end: datetime | None = None,
         time_col: str = "timestamp") -> DataFrame:
    """Rows of a version (the newest by default), of [start, end) if given; parts outside are not opened.

    What the driver gets is one folder name per part, as from any listing of a table.
    """
    path = path.rstrip("/")
    pointers = _Pointers(spark, path)
    version = pointers.newest() if version is None else version
    if version < 0:
        raise FileNotFoundError(f"no version is committed at {path}")
    known = pointers.read(version)
    schema = T.StructType.fromJson(json.loads(known["schema"]))
    parts = tree_of(spark, path, version).where(F.col("level") == PART_LEVEL)
    if start is not None:
        parts = parts.where(F.col("last") >= F.lit(start))
    if end is not None:
        parts = parts.where(F.col("first") < F.lit(end))
    folders = [f"{path}/data/{p.folder}/{YEAR}={p.year}/{SLOT}={p.slot}" for p in parts.select("folder", "year", "slot").toLocalIterator()]
    rows = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    if start is not None:
        rows = rows.where(F.col(f"`{time_col}`") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col(f"`{time_col}`") < F.lit(end))
    return rows
