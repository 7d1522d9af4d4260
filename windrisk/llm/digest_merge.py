"""Exact deduplication by a tree-merge of sorted digest runs.

Level 0: every input partition deals its digests into a run of its own, one row for each distinct text.
Then runs merge in binomial rounds: run r of a round meets the runs with the same `r >> bits`, so a round
merges 2**bits runs, and after log(runs) / bits rounds one logical run is left. All levels are grouped
aggregates, so a task pre-merges what it holds before it sends anything: a text with a billion copies sends
one row for each task and round. The aggregate keeps an ordered struct, for which Spark plans sort
aggregates: the runs are sorted by digest and merged in that order. No run lies in one task: the rows of
a run are spread by digest.

Verified: two rows merge only if SHA-256, length in bytes and an independent 64-bit hash of the normalised
text all agree. Only these headers move; texts stay where they are.

Defined results: a NULL text counts as empty. A NULL id loses against every id. Of rows with equal id and
equal text (repeated rows) exactly one is kept. An empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrisk.llm.common import lower_ascii, stored, table

RUNS, FAN_IN_BITS = 1024, 5
_KEY = ["sha", "size", "check"]


def normalised(text: Column) -> Column:
    return lower_ascii(F.coalesce(text, F.lit("")))


def headers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, row (unique), SHA-256, bytes and check hash of the normalised text."""
    text = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    return text.select("id", F.monotonically_increasing_id().alias("row"),
                       F.unhex(F.sha2("norm", 256)).alias("sha"), F.octet_length("norm").cast("long").alias("size"),
                       F.xxhash64("norm").alias("check"))


def merge_runs(heads: DataFrame, smallest: bool = True, runs: int = RUNS, bits: int = FAN_IN_BITS) -> DataFrame:
    """One row per distinct text: key columns, `best` = struct(id, row) of the survivor, `n` = number of rows.

    The survivor has the smallest id (the largest if `smallest` is false); a NULL id only survives among NULL ids.
    """
    # NULLs sort first in a struct; a leading flag puts them where they lose.
    pick = F.min if smallest else F.max
    flag = F.col("id").isNull() if smallest else F.col("id").isNotNull()
    level = heads.select(F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"), *_KEY,
                         F.struct(flag.alias("flag"), "id", "row").alias("best"), F.lit(1).cast("long").alias("n"))
    level = level.groupBy("run", *_KEY).agg(pick("best").alias("best"), F.sum("n").alias("n"))
    while runs > 1:
        runs = (runs + (1 << bits) - 1) >> bits
        level = (level.withColumn("run", F.shiftright("run", bits)).groupBy("run", *_KEY)
                 .agg(pick("best").alias("best"), F.sum("n").alias("n")))
    return level.drop("run")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", smallest: bool = True,
                 runs: int = RUNS, bits: int = FAN_IN_BITS) -> DataFrame:
    """One row per input row: id, sha (binary), check, keep_id, group_size, kept.

    Both sides of the last join are stored tables, so that AQE can split a text that a third of all rows share.
    """
    heads = stored(headers(docs, id_col, text_col), "headers")
    survivors = stored(merge_runs(heads, smallest, runs, bits), "survivors")
    joined = heads.join(survivors.withColumnsRenamed({k: f"s_{k}" for k in _KEY}),
                        (F.col("sha") == F.col("s_sha")) & (F.col("size") == F.col("s_size"))
                        & (F.col("check") == F.col("s_check")))
    return joined.select("id", "sha", "check", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
                         (F.col("row") == F.col("best.row")).alias("kept"))


def op3_tree_merge_dedup(spark, sf_dir):
    groups = exact_groups(table(spark, sf_dir, "documents"), smallest=False)
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                         F.lower(F.hex("sha")).alias("text_sha256"))


OP3_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
