"""Incremental model fit: sums per file, kept in a ledger, added when a file comes and subtracted when it goes.

The statistics of the model are sums over observations, so those of a table are the sum of those of its files. The ledger keeps, per
file and zone, the trigonometric sums of `hsgp.zone_sums` (some thirty numbers, whatever the rows), and the totals per zone. An update
reads only files that are new or changed; a replaced or withdrawn file is subtracted by its own stored sums.

Sums depend on the basis interval in time, so the interval is versioned: it is chosen with room ahead of the data, and when data leave it, or
fill too little of it, a new version is begun and all files are read once more. Zones need no version: sums are kept by zone, and
coordinates are given when the model is put together.

Folder: `sums`, `totals` and `files`, each with one partition per update, and `commits`, one row per update with the interval. The
commit is written last, as one file, so an update that fails half-way leaves the ledger as it was. One writer per ledger.

Defined results: rows with a NULL or NaN in any column count nothing. A file is the set of rows with its file_id, in any order; equal
(zone, time) rows in several files all count, so files should share none, as the partitions of a snapshot table do. A ledger without
rows has no model (None).
"""

import uuid
from dataclasses import asdict, dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrisk.functions.timefn import not_nan
from windrisk.operators import features as feat
from windrisk.operators import hsgp
from windrisk.schemas import TEMPORAL_SCALE_H
from windrisk.session import small_side, store
from windrisk.sources.gates import path_exists

# Room ahead of the data as a share of their span; share of the interval below which it is chosen anew.
AHEAD, LEAST_FILL = 0.5, 0.25
# Totals are summed again from the files after this many updates, so rounding does not build up.
REBUILD = 50
HOUR_US = 3_600_000_000


@dataclass(frozen=True)
class Commit:
    """State of the ledger after an update; `low_us` to `high_us` is what the interval of the version covers."""
    batch: int
    tag: str
    version: int
    since_rebuild: int
    m_temporal: int
    scale_h: float
    low_us: int
    high_us: int

    def domain(self) -> hsgp.Domain:
        """Interval in scaled hours since `low_us`; the spatial half is filled in with the zones."""
        center, length = hsgp.interval(0.0, (self.high_us - self.low_us) / HOUR_US / self.scale_h)
        return hsgp.Domain(hsgp.M_SPATIAL, self.m_temporal, 0.0, 1.0, center, length)


@dataclass(frozen=True)
class Update:
    """What an update did."""
    added: int
    replaced: int
    withdrawn: int
    new_version: bool


COMMIT = "batch int, tag string, version int, since_rebuild int, m_temporal int, scale_h double, low_us long, high_us long"


def last_commit(spark: SparkSession, folder: str) -> Commit | None:
    if not path_exists(spark, f"{folder}/commits"):
        return None
    row = spark.read.schema(COMMIT).parquet(f"{folder}/commits").orderBy(F.desc("batch")).first()
    return Commit(**{f.name: row[f.name] for f in fields(Commit)}) if row else None


def digests(rows: DataFrame) -> DataFrame:
    """(file_id, digest): row-order-free content of each file."""
    hashed = _usable(rows).select("file_id", F.xxhash64("timestamp", "region_id", "y").alias("h"))
    parts = hashed.groupBy("file_id").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"),
                                          F.sum(F.col("h").cast("decimal(38,0)")).alias("s"))
    return parts.select("file_id", F.concat_ws("-", *[F.col(c).cast("string") for c in ("n", "x", "s")]).alias("digest"))


def _usable(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("file_id").cast("string").alias("file_id"), F.col("timestamp").cast("timestamp").alias("timestamp"), "region_id",
                       not_nan(F.col("wind_speed_mps").cast("double")).alias("y")).dropna()


def _part(spark: SparkSession, folder: str, name: str, tag: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}/tag={tag}")


def _added(tables: list[tuple[int, DataFrame]]) -> DataFrame:
    """Signed sum of sum tables by zone; a zone whose rows are all gone leaves."""
    names = [c for c in tables[0][1].columns if c not in ("region_id", "file_id")]
    stacked = None
    for sign, table in tables:
        signed = table.select("region_id", *[(F.lit(sign) * F.col(c)).alias(c) for c in names])
        stacked = signed if stacked is None else stacked.unionByName(signed)
    return stacked.groupBy("region_id").agg(*[F.sum(c).alias(c) for c in names]).where(F.col("n") > 0)


def _stored_sums(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Sums of the given (file_id, tag)."""
    wanted = small_side(files.select("file_id", "tag"))
    return spark.read.parquet(f"{folder}/sums").join(wanted, ["file_id", "tag"], "left_semi").drop("tag")


def update(rows: DataFrame, folder: str, listing: DataFrame | None = None, m_temporal: int = hsgp.M_TEMPORAL,
           scale_h: float = TEMPORAL_SCALE_H, ahead: float = AHEAD) -> Update:
    """Bring the ledger in `folder` up to the files of `rows` (file_id, timestamp, region_id, wind_speed_mps).

    `listing` (file_id, digest) names the files that there are, with anything that changes when a file does, such as its modification
    time; by default the rows are hashed. With a listing, only rows of changed files are read. `m_temporal` and `scale_h` other
    than those of the ledger begin a new version.
    """
    spark, last = rows.sparkSession, last_commit(rows.sparkSession, folder)
    seen = digests(rows) if listing is None else listing.select(F.col("file_id").cast("string").alias("file_id"), F.col("digest").cast("string").alias("digest"))
    if last is not None:
        known = spark.read.parquet(f"{folder}/files").where(F.col("tag") == last.tag).drop("tag").withColumnRenamed("sums_tag", "tag")
    else:
        known = spark.createDataFrame([], "file_id string, digest string, low_us long, high_us long, tag string")
    both = store(known.withColumnRenamed("digest", "old").join(seen.dropna().groupBy("file_id").agg(F.max("digest").alias("digest")), "file_id", "full_outer").withColumn(
        "kind", F.when(F.col("old").isNull(), "added").when(F.col("digest").isNull(), "withdrawn")
        .when(F.col("old") != F.col("digest"), "replaced").otherwise("same")), "compared")
    counts = {r.kind: r["count"] for r in both.groupBy("kind").count().collect()}
    same_basis = last is not None and (last.m_temporal, last.scale_h) == (m_temporal, scale_h)
    if same_basis and set(counts) <= {"same"}:
        return Update(0, 0, 0, False)

    def spans_of(files: DataFrame) -> DataFrame:
        ours = _usable(rows).join(small_side(files.select("file_id")), "file_id", "left_semi")
        return ours.groupBy("file_id").agg(F.min(F.unix_micros("timestamp")).alias("low_us"), F.max(F.unix_micros("timestamp")).alias("high_us"))

    changed = both.where(F.col("kind").isin("added", "replaced")).select("file_id", "digest")
    unchanged = both.where(F.col("kind") == "same").select("file_id", "digest", "low_us", "high_us", "tag")
    spans = store(changed.join(spans_of(changed), "file_id", "left"), "spans")
    ends = unchanged.select("low_us", "high_us").unionByName(spans.select("low_us", "high_us")).agg(F.min("low_us").alias("low"), F.max("high_us").alias("high")).first()
    tag = f"t{uuid.uuid4().hex}"
    commit, new_version = _next(last, same_basis, tag, ends.low, ends.high, m_temporal, scale_h, ahead)

    if new_version:
        again = unchanged.select("file_id", "digest", "low_us", "high_us")
        spans, unchanged = spans.unionByName(again), unchanged.where(F.lit(False))
    origin = F.lit(commit.low_us)
    x_t = (F.unix_micros("timestamp") - origin) / F.lit(float(HOUR_US)) / F.lit(scale_h)
    fresh = _usable(rows).join(small_side(spans.select("file_id")), "file_id", "left_semi").withColumn("x_t", x_t)
    hsgp.zone_sums(fresh, commit.domain(), by=("file_id", "region_id")).write.parquet(f"{folder}/sums/tag={tag}")
    live = unchanged.withColumnRenamed("tag", "sums_tag").unionByName(spans.withColumn("sums_tag", F.lit(tag)))
    live.write.parquet(f"{folder}/files/tag={tag}")
    new = (1, _part(spark, folder, "sums", tag))
    if new_version:
        totals = _added([new])
    elif commit.since_rebuild == 0:
        totals = _added([new, (1, _stored_sums(spark, folder, unchanged))])
    else:
        gone = both.where(F.col("kind").isin("replaced", "withdrawn"))
        totals = _added([(1, _part(spark, folder, "totals", last.tag)), new, (-1, _stored_sums(spark, folder, gone))])
    totals.write.parquet(f"{folder}/totals/tag={tag}")
    spark.createDataFrame([tuple(asdict(commit).values())], COMMIT).coalesce(1).write.mode("append").parquet(f"{folder}/commits")
    return Update(counts.get("added", 0), counts.get("replaced", 0), counts.get("withdrawn", 0), new_version)


def _next(last: Commit | None, same_basis: bool, tag: str, low: int | None, high: int | None, m_temporal: int, scale_h: float,
          ahead: float) -> tuple[Commit, bool]:
    """The commit after `last` for data from `low` to `high`, and whether it begins a version."""
    batch = 0 if last is None else last.batch + 1
    if same_basis:
        inside = low is None or (low >= last.low_us and high <= last.high_us)
        filled = low is None or high - low >= LEAST_FILL * (last.high_us - last.low_us) / (1.0 + ahead)
        if inside and filled:
            return Commit(batch, tag, last.version, (last.since_rebuild + 1) % REBUILD, m_temporal, scale_h, last.low_us, last.high_us), False
    low, high = low or 0, high or 0
    version = 0 if last is None else last.version + 1
    return Commit(batch, tag, version, 0, m_temporal, scale_h, low, high + int(ahead * (high - low))), True


def zone_totals(spark: SparkSession, folder: str, m_spatial: int = hsgp.M_SPATIAL) -> tuple[DataFrame, hsgp.Domain, DataFrame] | None:
    """Zone sums with x_s, the basis domain in hours since the first row (as `features` counts them), and the zone index."""
    last = last_commit(spark, folder)
    if last is None:
        return None
    totals = _part(spark, folder, "totals", last.tag)
    index = feat.zone_index(totals)
    sums = store(totals.join(index, "region_id").withColumn("x_s", feat.spatial_coordinate()).drop("region_id", "zone_idx", "n_zones"), "totals")
    ends = sums.agg(F.min("x_s").alias("low"), F.max("x_s").alias("high")).first()
    if ends.low is None:
        return None
    first = _part(spark, folder, "files", last.tag).agg(F.min("low_us")).first()[0]
    whole = last.domain()
    shift = (first - last.low_us) / HOUR_US / last.scale_h
    domain = hsgp.Domain(m_spatial, last.m_temporal, *hsgp.interval(ends.low, ends.high), whole.center_t - shift, whole.length_t)
    return sums, domain, index


def fit(spark: SparkSession, folder: str, m_spatial: int = hsgp.M_SPATIAL) -> tuple[hsgp.Fit, DataFrame] | None:
    """The model and its zone index, from the totals alone; None without enough rows."""
    found = zone_totals(spark, folder, m_spatial)
    if found is None:
        return None
    sums, domain, index = found
    model = hsgp.fit_of(hsgp.expand_sums(sums, domain), domain)
    return (model, index) if model.n >= hsgp.MIN_ROWS else None
