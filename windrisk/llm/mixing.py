"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets fill like water: a share of all words goes to the sources by weight, no source above `max_epochs` times
its size, and what is cut off is shared again by weight until none is above. With ratio = cap / weight the
capped sources are those with the smallest ratios, so running sums over the source table, one row per source, give
the level directly.

Complete epochs come first: a source with target t and size s gives every document floor(t / s) times. The rest of
the budget goes to documents in order of exponential keys -ln(u) / quality, u a hash of the id, so a document is drawn early
with chance in proportion to its quality; sizes are prefix-summed until the budget is met. The document that
crosses the budget gives the words that are missing.

The prefix sum does not sort a source in one task. Keys are cut into slots of equal chance, slots summed (with
partial sums first), and slots prefix-summed; documents of slots wholly inside or outside of the budget are settled by
that, and only the slot in which the budget ends is ordered. The number of slots follows from the counted rows.

Defined results: NULL text has size 0 and takes 0. NULL sources form one source, last in order. NULL ids draw like the
empty text. Documents of one key and id are taken in the order of their text hashes. Repeated rows count as documents of their
own; which of them is taken first is not fixed, what they take together is. A source without words has target 0; an empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrisk.llm.common import n_words, small_or_shuffled, stored, table

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MAX_EPOCHS, SEED = 1.5, 2, "mix"
SLOT_ROWS = 20_000
SYMBOLS = r"[#*$%&|<>]"


def quality(text: Column, words: Column) -> Column:
    """Quality weight in (0, 1]: 1 without symbols, less the more of them a word carries."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(4.0) * symbols / F.greatest(words, F.lit(1)))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) from 52 bits of SHA-256 of id and seed."""
    digest = F.sha2(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")), 256)
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """`source`, `size` (words) -> one row per source with `source_size`, `source_docs`, `target`.

    The windows run over the source table, which has one row per source however many documents there are.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    caps = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    filled = (caps.withColumn("place", F.row_number().over(by_ratio)).withColumn("capped_before", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
              .withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
              .withColumn("level", (F.sum("source_size").over(whole) * F.lit(share) - F.col("capped_before")) / F.col("weight_left")))
    # The level holds from the first source on that is not capped at it.
    free = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))).over(whole)
    target = F.when(free.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), free["level"] * F.col("weight")))
    return filled.withColumn("target", target).select("source", "source_size", "source_docs", "target")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        quality_col: str | None = None, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """One row per document: id, text_hash (xxhash64), source, size, source_size, target, key, taken (words, repeats counted).

    `quality_col` names a column of positive weights; by default `quality` of the text.
    """
    text = F.col(text_col)
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text).alias("size"), F.xxhash64(text).alias("text_hash"),
                        (F.col(quality_col).cast("double") if quality_col else quality(text, n_words(text))).alias("quality"))
    worth = F.when(F.col("quality") > 0, F.col("quality")).otherwise(F.lit(1e-9))
    keyed = stored(sized.select("id", "text_hash", "source", "size", (-F.log(uniform(F.col("id"), seed)) / worth).alias("key"),
                                F.monotonically_increasing_id().alias("row")), "mix-keys")
    middle = keyed.groupBy(F.col("source").alias("ms")).agg(F.percentile_approx("key", 0.5).alias("middle"))
    targets = stored(source_targets(keyed, weights, share, max_epochs).join(middle, F.col("source").eqNullSafe(F.col("ms"))).drop("ms"),
                     "mix-targets")
    largest = targets.agg(F.max("source_docs")).first()[0] or 0
    slots = max(64, -(-largest // SLOT_ROWS) * 8)
    budgets = targets.select(
        F.col("source").alias("s"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).alias("epochs"),
    ).withColumn("left", (F.floor(F.col("target")) - F.col("epochs") * F.col("source_size")).cast("long"))

    # Half of a source's keys lie below its middle key, whatever the scale of the quality weights.
    scales = small_or_shuffled(targets.select(F.col("source").alias("ms"), "middle"), 64)
    slot = F.floor((F.lit(1.0) - F.exp(-F.col("key") * F.lit(0.6931471805599453) / F.col("middle"))) * slots).cast("int")
    slotted = keyed.join(scales, F.col("source").eqNullSafe(F.col("ms"))).withColumn("slot", slot).drop("ms", "middle")
    by_slot = Window.partitionBy("s").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    summed = (slotted.groupBy(F.col("source").alias("s"), "slot").agg(F.sum("size").alias("slot_size"))
              .withColumn("before", F.coalesce(F.sum("slot_size").over(by_slot), F.lit(0))))
    # One row per source and slot: the slots that a budget reaches at all, and where it ends.
    plan = (summed.withColumnRenamed("s", "ss").join(budgets, F.col("ss").eqNullSafe(F.col("s")))
            .select("ss", "slot", "before", "slot_size", "source_size", "target", "epochs", "left"))
    plan = stored(plan, "mix-plan").withColumnRenamed("slot", "plan_slot")
    placed = slotted.join(plan, F.col("source").eqNullSafe(F.col("ss")) & (F.col("slot") == F.col("plan_slot")))
    room = F.col("left") - F.col("before")
    ends = (room > 0) & (room < F.col("slot_size"))
    settled = placed.where(~ends).withColumn("drawn", F.when(room > 0, F.col("size")).otherwise(F.lit(0)))
    in_slot = Window.partitionBy("source").orderBy("key", "id", "text_hash", "row").rowsBetween(Window.unboundedPreceding, -1)
    cut = (placed.where(ends).withColumn("ahead", F.coalesce(F.sum("size").over(in_slot), F.lit(0)))
           .withColumn("drawn", F.least(F.col("size"), F.greatest(F.lit(0), room - F.col("ahead")))).drop("ahead"))
    return settled.unionByName(cut).select(
        "id", "text_hash", "row", "source", "size", "source_size", "target", "key",
        (F.col("epochs") * F.col("size") + F.col("drawn")).cast("long").alias("taken"))


def op7_epoch_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, size,
         -ln((CAST('0x' || substr(sha256(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
           / (1.0 / (1.0 + 4.0 * symbols / greatest(size, 1))) AS key
  FROM (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
               coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0) AS symbols FROM documents)),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0 * sum(size) AS cap,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM s WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1), 1e300) * weight) AS target
  FROM l),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
r AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, floor(b.target) - b.epochs * b.source_size AS room,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + least(size, greatest(0, room - ahead)) AS BIGINT) AS taken FROM r
"""
