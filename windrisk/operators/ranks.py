"""Exact order statistics, quantiles and ranks inside groups of any size.

A group may hold a third of all rows, so no group is ever sorted whole in one task. Where
every group is known to be small the plain aggregates are used. Beyond that each group is cut
at sampled quantiles of its own values and counted, which tells exactly which bucket holds a
wanted rank; only the values of that bucket are looked at again, and cut again until a task can
order what is left. All passes are aggregates that combine before the shuffle.

Both ways follow one rule: rows with a missing key, a NULL or a NaN value are left out before
anything is counted, and infinite values count as the largest or smallest ones.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrisk.schemas import QUANTILES
from windrisk.session import keep, small_side

# Groups up to this size may be held in memory by an aggregate.
IN_MEMORY_ROWS = 50_000
# A bracket is cut into so many buckets of about equal counts.
BUCKETS = 64
# Buckets are cut again while one holds more rows than a task should order.
BUCKET_ROWS = 1_000_000
RANK_BUCKETS = 64
# Ranks are counted in buckets of about so many rows.
RANK_BUCKET_ROWS = 100_000
SKETCH_ACCURACY = 10_000
# A group's cut points are RANK_BUCKETS numbers, so this bounds the broadcast to a few MB.
CUT_GROUPS = 10_000

Rank = Callable[[Column], Column]


@dataclass(frozen=True)
class Pick:
    """Wanted order statistics `<name>_lo` and `<name>_hi` at two near 0-based ascending ranks, given n."""
    name: str
    low: Rank
    high: Rank


def _values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys and value; rows with a missing key, a NULL or a NaN are left out."""
    return _ranked_rows(df, keys, value).select(*keys, F.col(value).cast("double").alias("v"))


def _ranked_rows(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.dropna(subset=[*keys, value]).where(~F.isnan(F.col(value).cast("double")))


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def _sizes(rows: DataFrame, keys: Sequence[str], extra: Sequence[Column] = ()) -> tuple[DataFrame, int]:
    """Size and range of every group, and the size of the largest one."""
    sizes = keep(rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"), *extra))
    return sizes, sizes.agg(F.max("n")).first()[0] or 0


def _bucket(v: Column, n_cuts: int, cuts: str = "cuts") -> Column:
    """Twice the number of ascending cuts below `v`, plus one on a cut: a cut value is a bucket of its own. Found by halving."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n_cuts.bit_length()))])
    def step(found: Column, size: Column) -> Column:
        return found + F.when(F.get(F.col(cuts), found + size - 1) < v, size).otherwise(F.lit(0))
    def doubled(below: Column) -> Column:
        return 2 * below + F.when(F.get(F.col(cuts), below) == v, F.lit(1)).otherwise(F.lit(0))
    # Never NULL, or joins by bucket would compute it twice, to look for NULLs first.
    return F.coalesce(F.reduce(steps, F.lit(0), step, doubled), F.lit(0))


def _narrowed(rows: DataFrame, by: Sequence[str], keys: Sequence[str], brackets: DataFrame) -> DataFrame:
    """Brackets reduced to the bucket, or the few buckets, that hold their ranks.

    `by` is the key of a histogram: the group as long as all its brackets are the same,
    then group and pick. Buckets end at sampled quantiles of the bracket, so each holds about
    an equal share of its rows however the values are spread; a value more frequent than that has a
    bucket to itself or nearly so. Buckets follow the value, so the counts are exact; the
    new ends are values that occur.
    """
    bounds = small_side(brackets.groupBy(*by).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    within = (rows.join(bounds, list(keys)).where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))).select(*by, "v"))
    fractions = [i / BUCKETS for i in range(1, BUCKETS)]
    cuts = small_side(within.groupBy(*by).agg(F.percentile_approx("v", fractions, SKETCH_ACCURACY).alias("cuts")), CUT_GROUPS)
    histogram = (within.join(cuts, list(by)).groupBy(*by, _bucket(F.col("v"), len(fractions)).alias("bucket"))
                 .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("first"), F.max("v").alias("last")))
    running = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    placed = histogram.withColumn("upto", F.sum("c").over(running))
    start, end = F.col("below") + F.col("upto") - F.col("c"), F.col("below") + F.col("upto")
    return (placed.join(brackets.drop("lo", "hi"), list(by))
            .where((end > F.col("low")) & (start <= F.col("high")))
            .groupBy(*keys, "pick", "low", "high")
            .agg(F.min("first").alias("lo"), F.max("last").alias("hi"),
                 F.min(start).alias("below"), F.sum("c").alias("inside")))


def _picked(rows: DataFrame, keys: Sequence[str], sizes: DataFrame, picks: Sequence[Pick]) -> DataFrame:
    """(keys, pick columns) without ever ordering a whole group."""
    n = F.col("n")
    wanted = F.array(*[F.struct(F.lit(i).alias("pick"), p.low(n).cast("bigint").alias("low"), p.high(n).cast("bigint").alias("high"))
                       for i, p in enumerate(picks)])
    brackets = (sizes.select(*keys, F.col("least").alias("lo"), F.col("most").alias("hi"), F.lit(0).cast("bigint").alias("below"),
                             n.alias("inside"), F.explode(wanted).alias("w"))
                .select(*keys, "lo", "hi", "below", "inside", "w.*"))
    by = list(keys)
    widest = None
    while widest is None or widest > BUCKET_ROWS:
        # Every cut leaves a small share of the rows or a single value, so this ends.
        brackets = keep(_narrowed(rows, by, keys, brackets))
        by = [*keys, "pick"]
        widest = brackets.agg(F.max(F.when(F.col("lo") < F.col("hi"), F.col("inside")))).first()[0] or 0
    # The shuffle key holds the value, so a hot group spreads over all tasks; equal values fold.
    inside = (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))
    counts = (rows.join(small_side(brackets), list(keys)).where(inside)
              .groupBy(*keys, "pick", "low", "high", "below", "v").agg(F.count(F.lit(1)).alias("c")))
    running = Window.partitionBy(*keys, "pick").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = (counts.withColumn("end", F.col("below") + F.sum("c").over(running))
              .withColumn("start", F.col("end") - F.col("c")))
    def at(i: int, rank: str) -> Column:
        here = (F.col("pick") == i) & (F.col("start") <= F.col(rank)) & (F.col(rank) < F.col("end"))
        return F.max(F.when(here, F.col("v")))
    return placed.groupBy(*keys).agg(*[e for i, p in enumerate(picks) for e in (
        at(i, "low").alias(f"{p.name}_lo"), at(i, "high").alias(f"{p.name}_hi"))])


def pick_ranks(df: DataFrame, keys: Sequence[str], value: str, picks: Sequence[Pick],
               in_memory_rows: int = IN_MEMORY_ROWS) -> DataFrame:
    """One row per group: its size `n` and the values at the wanted ranks."""
    rows = _values(df, keys, value)
    sizes, largest = _sizes(rows, keys)
    if largest > in_memory_rows:
        return _picked(rows, keys, sizes, picks).join(sizes.select(*keys, "n"), list(keys))
    ordered = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("v")).alias("vs"))
    def at(rank: Rank) -> Column:
        return F.element_at("vs", (rank(F.col("n")) + 1).cast("int"))
    return ordered.select(*keys, "n", *[e for p in picks for e in (
        at(p.low).alias(f"{p.name}_lo"), at(p.high).alias(f"{p.name}_hi"))])


def quantile_label(q: float, prefix: str = "p") -> str:
    return f"{prefix}{round(q * 100)}"


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float] = QUANTILES,
              prefix: str = "p", in_memory_rows: int = IN_MEMORY_ROWS,
              extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per probability (`p10`, `p50`, ...).

    `extra` names further aggregates of the value, here called `v`; they ride along on a
    pass that is made anyway.
    """
    rows = _values(df, keys, value)
    names = [quantile_label(q, prefix) for q in probabilities]
    if len(set(names)) < len(names):
        raise ValueError(f"probabilities {list(probabilities)} share a label: {names}")
    more = [column.alias(name) for name, column in (extra or {}).items()]
    more_names = list(extra or {})
    sizes, largest = _sizes(rows, keys, more)
    def position(q: float) -> Column:
        return (F.col("n") - 1) * F.lit(float(q))
    def at(q: float, rounded) -> Rank:
        return lambda n: rounded((n - 1) * F.lit(float(q)))
    picks = [Pick(name, at(q, F.floor), at(q, F.ceil)) for q, name in zip(probabilities, names)]
    if largest <= in_memory_rows:
        ordered = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("v")).alias("vs"), *more)
        ends = ordered.select(*keys, "n", *[F.element_at("vs", (rank(F.col("n")) + 1).cast("int")).alias(f"{p.name}_{side}")
                                            for p in picks for side, rank in (("lo", p.low), ("hi", p.high))], *more_names)
    else:
        ends = _picked(rows, keys, sizes, picks).join(sizes.select(*keys, "n", *more_names), list(keys))
    def blended(q: float, name: str) -> Column:
        low, high, spot = F.col(f"{name}_lo"), F.col(f"{name}_hi"), position(q)
        part = spot - F.floor(spot)
        return F.when((part == 0) | (low == high), low).otherwise((F.lit(1.0) - part) * low + part * high).alias(name)
    return ends.select(*keys, *[blended(q, name) for q, name in zip(probabilities, names)], *more_names)


def kth_largest(df: DataFrame, keys: Sequence[str], value: str, fraction: float, name: str = "cutoff",
                in_memory_rows: int = IN_MEMORY_ROWS) -> DataFrame:
    """Per group the k-th largest value with k = max(1, ceil(fraction * n)), and n."""
    def rank(n: Column) -> Column:
        return n - F.greatest(F.lit(1), F.ceil(F.lit(float(fraction)) * n))
    found = pick_ranks(df, keys, value, [Pick(name, rank, rank)], in_memory_rows)
    return found.select(*keys, "n", F.col(f"{name}_lo").alias(name))


def _placed(rows: DataFrame, keys: Sequence[str], value: str, largest: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their `_bucket`, and per bucket its size `_inside`, the rows below it `_shift`, and the group's size `n`.

    Each group is cut at approximate quantiles, so a bucket between cuts holds a small share of it; equal values share a
    bucket, and those on a cut, among them all frequent ones, have it to themselves. The counts are exact.
    """
    buckets = max(RANK_BUCKETS, -(-largest // RANK_BUCKET_ROWS))
    fractions = [i / buckets for i in range(1, buckets)]
    cuts = small_side(rows.groupBy(*keys).agg(F.percentile_approx(value, fractions, SKETCH_ACCURACY).alias("_cuts")), CUT_GROUPS)
    placed = rows.join(cuts, list(keys)).withColumn("_bucket", _bucket(F.col(value), len(fractions), "_cuts")).drop("_cuts")
    below = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (placed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_inside"))
              .withColumn("_shift", F.coalesce(F.sum("_inside").over(below), F.lit(0)))
              .withColumn("n", F.sum("_inside").over(Window.partitionBy(*keys))))
    return placed, small_side(shifts)


def average_ranks(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values of each group with their 1-based rank; equal values share their mean rank.

    Equal values fold before the shuffle; ranks are counted inside a bucket and shifted by the sizes of the
    buckets below, so no task orders a whole group.
    """
    rows = _values(df, keys, value)
    placed, shifts = _placed(rows, keys, "v", largest_group(rows, keys))
    counts = placed.groupBy(*keys, "_bucket", "v").agg(F.count(F.lit(1)).alias("c"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return (counts.withColumn("upto", F.sum("c").over(inside))
            .join(shifts, [*keys, "_bucket"])
            .select(*keys, F.col("v").alias(value),
                    (F.col("_shift") + F.col("upto") - F.col("c") + (F.col("c") + 1) / 2.0).alias("rank"),
                    "n"))


def with_average_ranks(df: DataFrame, keys: Sequence[str], value: str, in_memory_rows: int = IN_MEMORY_ROWS) -> DataFrame:
    """`df` with the average rank of the value in its group, and the group's size `n`; rows without key or number are left out.

    Rows of large groups are ordered bucket by bucket and shuffled once, without a join with their ranks. Rows on a cut need no order: all
    have the mean rank of their bucket, so they stay apart by the task that read them.
    """
    df = _ranked_rows(df, keys, value)
    largest = largest_group(df, keys)
    def mean_rank(order: Window) -> Column:
        # The first and the last rank of equal values.
        return (F.rank().over(order) + F.count(F.lit(1)).over(order)) / 2.0
    if largest > in_memory_rows:
        placed, shifts = _placed(df, keys, value, largest)
        on_cut = F.col("_bucket") % 2 == 1
        rows = placed.join(shifts, [*keys, "_bucket"]).withColumn("_task", F.when(on_cut, F.spark_partition_id()).otherwise(F.lit(-1)))
        inside = mean_rank(Window.partitionBy(*keys, "_bucket", "_task").orderBy(value))
        rank = F.col("_shift") + F.when(on_cut, (F.col("_inside") + 1) / 2.0).otherwise(inside)
        return rows.select(*df.columns, rank.alias("rank"), "n")
    group = Window.partitionBy(*keys)
    return df.select("*", mean_rank(group.orderBy(value)).alias("rank"), F.count(F.lit(1)).over(group).alias("n"))
