"""Line deduplication by a log-template tree.

Every line with a word is parsed to a leaf of fixed depth: number of tokens, then its DEPTH leading tokens. Tokens with digits, addresses
and links are variable from the start (`<*>`). Within a leaf a position is fixed for a token if enough documents have
that token there; other positions are variable. A line with enough fixed positions (SIMILAR of its tokens) gets the template of its fixed
tokens, any other line is its own template. Templates that recur in enough documents are dropped from all of them.

Enough is one rule: `least_docs` documents for a line of at most LONG tokens, which may recur by chance, and `long_docs` different texts for a longer
one, which does not. Rows of equal text are one text there, or else copies of a document would lose all their long lines.

The tree is never held in one place: leaves, positions and templates are keys of grouped aggregates. Equal lines fold into one row
before anything else, so a line in a third of all documents is one row for each task; positions are only looked at in leaves of several
different lines. What is stored for a line is its leaf and key; texts are read again for samples of the lines and for the result.

Defined results: NULL and empty texts have no lines and stay as they are (NULL as NULL). Lines without a word are never dropped and do
not count. A text of which all lines are dropped becomes empty. Lines of one document count once for it; repeated rows (same
id and text) count as one document and get equal results.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrisk.llm.common import stored, table

DEPTH, SIMILAR, LEAST_DOCS = 3, 0.6, 10
LONG, LONG_DOCS = 20, 2
VARIABLE = "<*>"
_VARIABLE = re.compile(r"\d|://|@.+\.|^www\.")
_MAYBE = re.compile(r"[\d@]").search


def masked(line: str) -> list[str]:
    # Most lines have nothing that makes any token variable.
    if not (_MAYBE(line) or "://" in line or "www." in line):
        return line.split()
    return [VARIABLE if _VARIABLE.search(token) else token for token in line.split()]


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


def _leaf(tokens: list[str]) -> int:
    """Hash of the leaf; odd for long lines."""
    return _hash(f"{len(tokens)} {' '.join(tokens[:DEPTH])}") & ~1 | (len(tokens) > LONG)


def _counted(rows: DataFrame, *keys: str) -> DataFrame:
    """`keys`, docs, sample: documents of distinct rows with `leaf`, `id`, `text_hash`, `line`; equal texts are one for long lines.

    The sample is the text with the smallest hash, in plain columns until the end: the least of structs would sort all rows.
    """
    texts = rows.groupBy(*keys, "text_hash").agg(F.count("*").alias("n"), F.min("id").alias("id"), F.min("line").alias("line"))
    docs = F.when(_is_long(), F.count("*")).otherwise(F.sum("n"))
    return texts.groupBy(*keys).agg(docs.alias("docs"), F.min("text_hash").alias("text_hash"), F.min_by("id", "text_hash").alias("id"),
                                    F.min_by("line", "text_hash").alias("line")).select(*keys, "docs", F.struct("id", "text_hash", "line").alias("sample"))


def _is_long():
    return F.col("leaf").bitwiseAND(1) == 1


def parsed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text_hash, and for each line its leaf and key (0 for lines without a word). Texts stay where they are."""
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([*source.schema.fields[:2], T.StructField("leaves", longs), T.StructField("keys", longs)])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, keys = [], []
            for text in batch.column("text"):
                tokens = [masked(line) for line in (text.as_py() or "").split("\n")]
                leaves.append([_leaf(t) if t else 0 for t in tokens])
                keys.append([_hash(" ".join(t)) if t else 0 for t in tokens])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(leaves, kind), pa.array(keys, kind)], names=schema.names)

    return source.mapInArrow(parse, schema)


def _with_texts(docs: DataFrame, side: DataFrame, how: str, id_col: str, text_col: str) -> DataFrame:
    """`id`, `text` joined with a table by `s_id` and `s_hash`; what is joined grows with the corpus, so both sides are shuffled."""
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    match = F.col("text_hash").eqNullSafe(F.col("s_hash")) & F.col("id").eqNullSafe(F.col("s_id"))
    return texts.hint("merge").join(side, match, how).drop("text_hash", "s_hash", "s_id")


def _tokens(samples: DataFrame) -> DataFrame:
    """(leaf, key, docs, length, pos, token) of the sample lines of each text."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[], [], [], [], [], []]
            for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist()):
                lines = text.as_py().split("\n")
                for item in wanted:
                    tokens = masked(lines[item["line"]])
                    n = len(tokens)
                    for column, values in zip(columns, ([item["leaf"]] * n, [item["key"]] * n, [item["docs"]] * n, [n] * n, range(n), map(_hash, tokens))):
                        column.extend(values)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["leaf", "key", "docs", "length", "pos", "token"])

    return samples.mapInArrow(explode, "leaf long, key long, docs long, length long, pos long, token long")


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_docs: int = LEAST_DOCS,
                    similar: float = SIMILAR, long_docs: int = LONG_DOCS) -> DataFrame:
    """(s_id, s_hash, lines): by id and hash of a text the numbers of its lines that belong to recurring templates."""
    enough = F.when(_is_long(), F.lit(long_docs)).otherwise(F.lit(least_docs))
    lines = stored(parsed(docs, id_col, text_col), "parsed-lines").select(
        "id", "text_hash", F.posexplode(F.arrays_zip("leaves", "keys")).alias("line", "at")).select(
        "id", "text_hash", "line", F.col("at.leaves").alias("leaf"), F.col("at.keys").alias("key")).where("key <> 0")
    once = stored(lines.groupBy("leaf", "key", "id", "text_hash").agg(F.min("line").alias("line")), "lines-once")
    kinds = stored(_counted(once, "leaf", "key"), "line-kinds")
    several = kinds.groupBy("leaf").agg(F.sum("docs").alias("n"), F.count("*").alias("kinds")).where((F.col("n") >= enough) & (F.col("kinds") > 1))
    samples = kinds.join(several.select("leaf"), "leaf").groupBy(F.col("sample.id").alias("s_id"), F.col("sample.text_hash").alias("s_hash")).agg(
        F.collect_list(F.struct(F.col("sample.line").alias("line"), "leaf", "key", "docs")).alias("wanted"))
    sampled = _with_texts(docs, stored(samples, "line-samples"), "inner", id_col, text_col)
    # Repeated rows give their tokens once.
    tokens = stored(_tokens(sampled.select("text", "wanted")).distinct(), "line-tokens")
    fixed = tokens.groupBy("leaf", "pos", "token").agg(F.sum("docs").alias("n")).where(F.col("n") >= enough).drop("n")
    templates = stored(tokens.join(fixed, ["leaf", "pos", "token"]).groupBy("leaf", "key").agg(
        F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("fixed"), F.first("length").alias("length"))
        .where(F.size("fixed") >= F.col("length") * similar).select("leaf", "key", F.xxhash64("leaf", "fixed").alias("template")), "line-templates")
    shared = once.join(templates, ["leaf", "key"]).groupBy("leaf", "template", "id", "text_hash").agg(F.min("line").alias("line"))
    shared = _counted(shared, "leaf", "template").where(F.col("docs") >= enough).select("leaf", "template")
    dropped = stored(kinds.where(F.col("docs") >= enough).select("leaf", "key")
                     .union(templates.join(shared, ["leaf", "template"]).select("leaf", "key")).distinct(), "lines-dropped")
    return lines.join(dropped, ["leaf", "key"]).groupBy(F.col("id").alias("s_id"), F.col("text_hash").alias("s_hash")).agg(
        F.collect_set("line").alias("lines"))


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_docs: int = LEAST_DOCS,
                   similar: float = SIMILAR, long_docs: int = LONG_DOCS) -> DataFrame:
    """Per row: id, n_lines (with a word), n_dropped, text without the dropped lines."""
    found = stored(recurring_lines(docs, id_col, text_col, least_docs, similar, long_docs), "lines-of-rows")
    joined = _with_texts(docs, found, "left", id_col, text_col)
    schema = T.StructType([joined.schema["id"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
                           T.StructField("text", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, numbers, sizes = [], [], []
            for text, gone in zip(batch.column("text"), batch.column("lines").to_pylist()):
                text, gone = text.as_py(), set(gone or ())
                lines = (text or "").split("\n")
                sizes.append(sum(1 for line in lines if line and not line.isspace()))
                numbers.append(len(gone))
                kept.append("\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else text)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(numbers, pa.int64()), pa.array(kept, pa.string())],
                                             names=schema.names)

    return joined.mapInArrow(cut, schema)


def op6_line_templates(spark, sf_dir):
    found = drop_recurring(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
