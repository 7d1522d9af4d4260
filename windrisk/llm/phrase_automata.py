"""Substring dedup: recurring phrases of WINDOW words, found again by sharded Aho-Corasick automata.

A word goes if a window of WINDOW words that covers it starts with the same words in a document of a smaller id.

1. Equal texts fold into one row with their smallest id; a copy with a larger id loses every word that a window covers.
2. Each window has a minimizer: the least hash of the GRAM-word sequences in it. Equal windows have equal minimizers, so only windows
   whose minimizer stands in two or more documents can recur. A text names few minimizers, so little is shuffled.
3. Those windows are cut out as pieces: runs of windows with the same minimizer, as words. Equal pieces fold before they move, with
   the smallest and largest id that has them; a passage that a third of all documents share is one piece for each task.
4. Pieces go to shards by minimizer. A shard confirms recurring windows word by word, compiles them into an automaton with the
   smallest id of each, and streams its pieces through it: every occurrence, with the id it repeats.
5. Occurrences go back to their documents, and the words are taken out.

A minimizer with more than SHARD_WINDOWS different windows is no shard: its pieces are cut into single windows first, which
spread by their own hash. No shard holds more than a few times SHARD_WINDOWS windows.

Defined results: NULL or blank text has no words. A NULL id counts as larger than every id, so such rows take nothing from each
other. Rows with one id, repeated or with different texts, take nothing from each other. Very long texts are one row; their pieces
are cut every PIECE_WINDOWS windows. An empty table gives an empty result.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrisk.llm.common import stored, table
from windrisk.llm.shingles import _MULTIPLIER, mix64, word_hashes
from windrisk.session import discard

WINDOW, GRAM = 13, 8
PIECE_WINDOWS = 64
SHARD_WINDOWS = 1 << 15
LAST = (1 << 63) - 1


def _minimizers(text: str | None, window: int, gram: int) -> np.ndarray:
    """Minimizer of every window of a text, in order; words are told apart by case."""
    words = word_hashes(text, lower=False)
    n = len(words) - gram + 1
    if len(words) < window:
        return words[:0].view(np.int64)
    rolled = np.full(n, np.uint64(gram))
    with np.errstate(over="ignore"):
        for i in range(gram):
            rolled = rolled * _MULTIPLIER + words[i:n + i]
        rolled = mix64(rolled)
    span = window - gram + 1
    return np.minimum.reduce([rolled[i:n - span + 1 + i] for i in range(span)]).view(np.int64)


def folded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, own, sha) of every row, and one row (r, doc, sha, text) per distinct text with the smallest id that has it."""
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), own.alias("own"), F.unhex(F.sha2(text, 256)).alias("sha"), text.alias("text"))
    texts = rows.groupBy("sha").agg(F.min("own").alias("doc"), F.first("text").alias("text"))
    return rows.select("id", "own", "sha"), stored(texts.withColumn("r", F.monotonically_increasing_id()), "phrase-texts")


def recurring_grams(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(r, grams): minimizers of a text that stand in documents of different ids."""
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(_minimizers(t.as_py(), window, gram)) for t in batch.column("text")]
            sizes = [len(f) for f in found]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(found) if found else np.zeros(0, dtype=np.int64), pa.int64()),
                pa.array(np.repeat(batch.column("r").to_numpy(), sizes), pa.int64()),
                pa.array(np.repeat(batch.column("doc").to_numpy(), sizes), pa.int64())], names=["gram", "r", "doc"])

    grams = stored(texts.select("r", "doc", "text").mapInArrow(spell, "gram long, r long, doc long"), "phrase-grams")
    several = stored(grams.groupBy("gram").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                     .where(F.col("first") < F.col("last")).select("gram"), "phrase-several")
    found = stored(grams.join(several, "gram", "left_semi").groupBy("r").agg(F.collect_list("gram").alias("grams")), "phrase-recurring")
    discard(grams, several)
    return found


def pieces_of(texts: DataFrame, grams: DataFrame, window: int = WINDOW, gram: int = GRAM, longest: int = PIECE_WINDOWS) -> DataFrame:
    """(gram, r, doc, pos, n, words): runs of `n` windows from word `pos` on that share a recurring minimizer."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r, doc, text, known in zip(*[batch.column(c) for c in ("r", "doc", "text", "grams")]):
                text = text.as_py()
                of_window = _minimizers(text, window, gram)
                new = np.concatenate([[True], of_window[1:] != of_window[:-1]])
                starts = np.flatnonzero(new)
                ends = np.append(starts[1:], len(of_window))
                use = np.isin(of_window[starts], np.asarray(known.values, dtype=np.int64))
                words = text.encode().split()
                for a, b in zip(starts[use].tolist(), ends[use].tolist()):
                    for pos in range(a, b, longest):
                        n = min(longest, b - pos)
                        out.append((int(of_window[a]), r.as_py(), doc.as_py(), pos, n, b" ".join(words[pos:pos + n + window - 1]).decode()))
                if len(out) >= 1 << 15:
                    yield _pieces(out)
                    out = []
            yield _pieces(out)

    return texts.join(grams, "r").select("r", "doc", "text", "grams").mapInArrow(cut, "gram long, r long, doc long, pos int, n int, words string")


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["gram", "r", "doc", "pos", "n", "words"])


def _single_windows(pieces: DataFrame, window: int) -> DataFrame:
    """Pieces cut into their windows, each under a key of its own."""
    word = F.split("words", " ")
    part = lambda i: F.struct(i.cast("int").alias("at"), F.array_join(F.slice(word, i + 1, F.lit(window)), " ").alias("words"))
    each = F.explode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), part)).alias("w")
    return pieces.select("r", "doc", "pos", each).select(
        F.xxhash64("w.words").alias("gram"), "r", "doc", (F.col("pos") + F.col("w.at")).alias("pos"), F.lit(1).alias("n"), F.col("w.words").alias("words"))


def _keys() -> list[Column]:
    return [F.xxhash64("words").alias("k1"), F.xxhash64(F.lit("second"), "words").alias("k2")]


def _distinct(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("gram", "n", "words").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))


def occurrences(distinct: DataFrame, shards: int, window: int = WINDOW) -> DataFrame:
    """(k1, k2, repeats): for each window of a piece the smallest id of a document where it starts, NULL if in one document only."""
    def search(shard: pa.Table) -> pa.Table:
        import ahocorasick
        numbers: dict[str, int] = {}
        texts = [tuple(numbers.setdefault(w, len(numbers)) for w in words.split(" ")) for words in shard.column("words").to_pylist()]
        first, last = shard.column("first").to_pylist(), shard.column("last").to_pylist()
        seen: dict[tuple, list[int]] = {}
        for text, low, high in zip(texts, first, last):
            for i in range(len(text) - window + 1):
                ends = seen.setdefault(text[i:i + window], [low, high])
                if low < ends[0]:
                    ends[0] = low
                if high > ends[1]:
                    ends[1] = high
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for phrase, (low, high) in seen.items():
            if low < high:
                automaton.add_word(phrase, low)
        rows, repeats = [], []
        if len(automaton):
            seen.clear()
            automaton.make_automaton()
            for i, text in enumerate(texts):
                found: list[int | None] = [None] * (len(text) - window + 1)
                for end, low in automaton.iter(text):
                    found[end - window + 1] = low
                if any(low is not None and low < last[i] for low in found):
                    rows.append(i)
                    repeats.append(found)
        taken = shard.take(pa.array(rows, pa.int64()))
        return pa.table({"k1": taken.column("k1"), "k2": taken.column("k2"), "repeats": pa.array(repeats, pa.list_(pa.int64()))})

    shard = F.pmod(F.xxhash64("gram"), F.lit(shards)).alias("shard")
    rows = distinct.select(shard, *_keys(), "first", "last", "words")
    return rows.groupBy("shard").applyInArrow(search, "k1 long, k2 long, repeats array<long>")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                    shard_windows: int = SHARD_WINDOWS, longest: int = PIECE_WINDOWS, digest: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept): every row with the words that stay, joined by one space.

    `digest` gives the SHA-256 of `kept` in its place, so that no text moves after the words are out.
    """
    heads, texts = folded(docs, id_col, text_col)
    pieces = stored(pieces_of(texts, recurring_grams(texts, window, gram), window, gram, longest), "phrase-pieces")
    distinct = stored(_distinct(pieces), "phrase-distinct")
    by_gram = distinct.groupBy("gram").agg(F.sum("n").alias("windows"))
    crowded = stored(by_gram.where(F.col("windows") > shard_windows).select("gram"), "phrase-crowded")
    if not crowded.isEmpty():
        single = _single_windows(pieces.join(crowded, "gram", "left_semi"), window)
        whole = pieces, distinct
        pieces = stored(pieces.join(crowded, "gram", "left_anti").select(*single.columns).unionByName(single), "phrase-pieces")
        distinct = stored(_distinct(pieces), "phrase-distinct")
        discard(*whole)
    total = distinct.agg(F.sum("n")).first()[0] or 0
    found = stored(occurrences(distinct, 1 + 2 * total // shard_windows, window), "phrase-found")
    discard(distinct)

    hits = pieces.select("r", "doc", "pos", *_keys()).join(found, ["k1", "k2"])
    repeated = F.filter(F.transform("repeats", lambda low, i: F.when(low < F.col("doc"), F.col("pos") + i)), lambda p: p.isNotNull())
    starts = stored(hits.select("r", repeated.alias("starts")).where(F.size("starts") > 0)
                    .groupBy("r").agg(F.flatten(F.collect_list("starts")).alias("starts")), "phrase-starts")
    discard(pieces, found)
    shown = (lambda words: hashlib.sha256(words).hexdigest()) if digest else bytes.decode

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, removed, kept = [], [], []
            for text, starts in zip(batch.column("text"), batch.column("starts")):
                words = text.as_py().encode().split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                if starts.is_valid:
                    at = np.asarray(starts.values, dtype=np.int64)
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + window, -1)
                gone = np.cumsum(gone)[:len(words)] > 0
                numbers.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(shown(b" ".join(w for w, g in zip(words, gone.tolist()) if not g)))
            yield pa.RecordBatch.from_arrays([
                batch.column("sha"), batch.column("doc"), pa.array(numbers, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["sha", "doc", "n_words", "n_removed", "kept"])

    judged = (texts.join(starts, "r", "left").select("sha", "doc", "text", "starts")
              .mapInArrow(take_out, "sha binary, doc long, n_words long, n_removed long, kept string"))
    copy = (F.col("own") > F.col("doc")) & (F.col("n_words") >= window)
    return heads.join(judged, "sha").select(
        "id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(shown(b""))).otherwise(F.col("kept")).alias("kept"))


def op12_phrase_automata(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents"), digest=True).withColumnsRenamed({"id": "doc_id", "kept": "kept_sha256"})


OP12_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS own,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
places AS (SELECT r, own, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
windows AS (SELECT r, own, i, array_to_string(w[i:i + 12], ' ') AS s FROM places),
earliest AS (SELECT s, min(own) AS low FROM windows GROUP BY s),
covered AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM windows JOIN earliest USING (s) WHERE low < own),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN covered USING (r, p) GROUP BY r),
gone AS (SELECT r, count(*) AS n FROM covered GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(gone.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN gone USING (r)
"""
