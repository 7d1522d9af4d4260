"""The corpus pipeline: five filtering and preparing stages over whole tables.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept; results are written as Parquet to the
shared folder and read again. All but the last return the columns of `documents`.

Rows are told apart by id and text, so rows without an id or with one id and several texts are treated each by its own decision.
Repeated rows fold in the exact stage. Rows that the mix takes twice come out twice. Empty tables pass through.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrisk.llm import circulant, digest_merge, mixing, piece_bpe, toxic
from windrisk.llm.common import ship_code, small_or_shuffled, stored, table

#: An id and a hash.
DROPPED_BYTES = 16


def _named(decisions: DataFrame, name: str) -> DataFrame:
    """Decisions, stored, under column names that no document column has."""
    return stored(decisions.select(*[F.col(c).alias(f"__p_{c}") for c in decisions.columns]), name)


def _rows_of(docs: DataFrame, decisions: DataFrame, how: str) -> DataFrame:
    """Rows of `docs` that have a decision with their id and text hash, or none if `how` is left_anti."""
    match = F.xxhash64(docs["text"]).eqNullSafe(F.col("__p_text_hash")) & docs["doc_id"].eqNullSafe(F.col("__p_id"))
    return docs.join(decisions, match, how)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 and more go."""
    model = toxic.learn(docs, table(spark, sf_dir, "labels"))
    return toxic.scored(docs, model).where("score < 0.5").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the one with the largest id stays."""
    ship_code(spark)
    # Those that go are few, so that the texts mostly need no shuffle. Of repeated rows one is kept, and then they all stay for now.
    pairs = digest_merge.exact_groups(docs, smallest=False).groupBy("id", "check").agg(F.max("kept").alias("kept"))
    dropped = small_or_shuffled(_named(pairs.where("NOT kept").select("id", "check"), "exact-dropped"), DROPPED_BYTES)
    text = digest_merge.normalised(docs["text"])
    rows = docs.join(dropped, (F.xxhash64(text) == F.col("__p_check")) & docs["doc_id"].eqNullSafe(F.col("__p_id")), "left_anti")
    # Only repeated rows, or texts that differ in case under one id, have more than one row left for an id and a digest.
    unique = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    return rows if unique else rows.withColumn("__p_own", F.sha2(text, 256)).dropDuplicates(["doc_id", "__p_own"]).drop("__p_own")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    ship_code(spark)
    # Rows of one id and text are kept or dropped together; those dropped are few, so that the texts mostly need no shuffle.
    dropped = _named(circulant.near_groups(docs).where("NOT kept").select("id", "text_hash"), "near-dropped")
    return _rows_of(docs, small_or_shuffled(dropped, DROPPED_BYTES), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one that a source's budget ends in comes whole."""
    ship_code(spark)
    taken = mixing.mix(docs).where("taken > 0").select("id", "text_hash", F.ceil(F.col("taken") / F.col("size")).cast("int").alias("copies"))
    rows = _rows_of(docs, _named(taken.distinct(), "mix-taken"), "inner")
    return rows.withColumn("__p_copy", F.explode(F.sequence(F.lit(1), F.col("__p_copies")))).select(*[docs[c] for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of the text that they decode to."""
    ship_code(spark)
    return piece_bpe.pieces(docs, outputs=("ids", "n_tokens", "decoded_sha256")).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("MinHash near-dedup", near_dedup),
          ("mixing sources to target weights", mix_sources), ("SentencePiece encoding and decoding", encode)]

#: The learned scores and the similarity graph cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
    return docs
