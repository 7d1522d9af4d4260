"""Run gates: is there anything new to do?"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Our choice: significant digits of floating numbers that make a difference to a table's content.
SIGNIFICANT = 10


@dataclass(frozen=True)
class ContentHash:
    """Row-order-free fingerprint of a table."""
    n_rows: int
    xor: int
    total: int

    def __str__(self) -> str:
        return f"{self.n_rows}-{self.xor & 0xFFFFFFFFFFFFFFFF:016x}-{self.total}"


def _significant(number: Column) -> list[Column]:
    """A floating number as columns to hash: its leading SIGNIFICANT digits and its exponent; zero, NaN and sizes beyond 1e290 or below 1e-290 as they are."""
    x = number.cast("double")
    size = F.abs(x)
    # log10 alone can be off by one next to a power of ten; the digits tell.
    guess = F.when((size > 1e-290) & (size < 1e290), F.floor(F.log10(size)))
    digits = F.round(x * F.pow(F.lit(10.0), -guess) * F.lit(10.0 ** (SIGNIFICANT - 1)))
    over, under = F.abs(digits) >= 10.0 ** SIGNIFICANT, F.abs(digits) < 10.0 ** (SIGNIFICANT - 1)
    exact = F.when(over, F.round(digits / 10.0)).when(under, F.round(digits * 10.0)).otherwise(digits).cast("long")
    exponent = guess + F.when(over, 1).when(under, -1).otherwise(0)
    return [exact, exponent, F.when(guess.isNull(), x + F.lit(0.0))]


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """64-bit hash of a row's columns in the given order."""
    kinds = dict(df.dtypes)
    parts = [p for c in columns for p in (_significant(F.col(f"`{c}`")) if kinds[c] in ("double", "float") else [F.col(f"`{c}`")])]
    return F.xxhash64(*parts)


def hash_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, xor and sum of the row hashes: one pass, map-side combined, no sort.

    Columns are hashed in the given order, so reordering those of the table changes nothing.
    Xor alone would miss pairs of equal rows; the sum does not. Floating numbers count to SIGNIFICANT digits, whatever their
    size: the last bits of a recomputed sum depend on the order of its rows.
    """
    return df.select(row_hash(df, columns).alias("h")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.bit_xor("h").alias("xor"),
        F.sum(F.col("h").cast("decimal(38,0)")).alias("total"))


def content_hash(df: DataFrame, columns: Sequence[str] | None = None) -> ContentHash:
    row = hash_columns(df, sorted(df.columns) if columns is None else columns).first()
    return ContentHash(row.n_rows, row.xor or 0, int(row.total or 0))


def newest_file(spark: SparkSession, path: str, file_format: str = "parquet", pattern: str | None = None):
    """Latest modification time among the files of a path, or None if there are none. Files are listed, never opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", pattern or f"*.{file_format}*")
    try:
        return reader.load(path).select(F.max("modificationTime")).first()[0]
    except AnalysisException:
        return None


def is_fresh(spark: SparkSession, target: str, sources: Sequence[tuple[str, str]]) -> bool:
    """True if the target is at least as new as every source file. Anything unreadable means False.

    `sources` are (path, format) pairs.
    """
    done = newest_file(spark, target)
    times = [newest_file(spark, path, file_format) for path, file_format in sources]
    known = [t for t in times if t is not None]
    return done is not None and bool(known) and done >= max(known)


def missing_keys(manifest: DataFrame, existing: DataFrame, key: str = "key") -> DataFrame:
    """Work items that are not there yet."""
    return manifest.join(existing.select(key), key, "left_anti")


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if a readable Parquet table stands at the path."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False
