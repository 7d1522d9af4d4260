"""What the corpus operators share: table access, words, stored intermediate tables, checked broadcasts.

Every operator takes a DataFrame and the names of the columns it reads, selects those under names of its
own, and so never meets further columns, whatever they are called.
"""

import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrisk.session import configure, store

# The words of a text are the longest runs without these characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_BYTES = 8 << 20

Query = Callable[[SparkSession, str], DataFrame]
_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        base = os.path.join(tempfile.mkdtemp(prefix="windrisk-code-"), "windrisk-code")
        context.addPyFile(shutil.make_archive(base, "zip", root, "windrisk"))
        _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; 0 for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lost executors cost no recompute."""
    return store(df, f"llm-{name}")


def small_or_shuffled(stored_table: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a stored table whose counted rows fit `max_bytes`; a larger one is left to a shuffle join."""
    most = max_bytes // row_bytes
    if stored_table.limit(most + 1).count() <= most:
        return F.broadcast(stored_table)
    return stored_table
