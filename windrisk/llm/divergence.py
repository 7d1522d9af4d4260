"""Source divergence audit: exact frequency filter, then a recount through sharded minimal perfect hashes.

First pass: documents with a term, per language, summed up in the tasks; terms in fewer than LEAST_DOCS documents go. The kept terms
are dealt into shards of about SHARD_TERMS terms, and each shard becomes a minimal perfect hash in a task of its own: levels of
bits in which a term that falls on a place alone sets it, the others go down a level; a term's slot is the rank of its bit.
The terms lie behind the bits in slot order, and a slot counts for a word only if its stored term is that word.

Second pass: each task adds to dense slots, one array for each group and shard, and sends what is not zero. Hashes whose
counted bytes fit BROADCAST_BYTES are sent out all together over the documents. Larger vocabularies are sent out in rounds of that size,
over word counts that were summed up by group beforehand, so the documents are not read once a round.

Probabilities are long division in 64-bit integers, exact up to 9e15 words. Distances of sources are summed in tiles of terms and
blocks of sources: terms that neither source has add the same number each and are counted, not visited.

Defined results: NULL text, lang and source are ''. Rows are documents, so repeated rows count each. Groups without terms have
zero counts. A language without kept terms has pairs of value 0 and no term rows; one with a single source has no pair. Very long
texts are read whole. An empty table gives an empty result.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrisk.llm.common import BROADCAST_BYTES, stored, table
from windrisk.llm.shingles import mix64

# Fixed values of the contract.
LEAST_DOCS, SMOOTHING, SCALE, TOP_TERMS = 30, 5, 1_000_000_000, 50
SHARD_TERMS = 1 << 15
HELD_TERMS = 1 << 19  # distinct words that a task holds before it sends them
HELD_SLOTS = 1 << 22  # dense slots that a task holds before it sends them
TILE_TERMS, BLOCK_SOURCES = 4096, 64
LEVELS = 32
SEED = 42

# Letters and all bytes of further characters are parts of terms; A-Z are lower-cased, all else parts them.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split() if text else []


def _hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t, SEED) for t in terms), dtype=np.uint64, count=len(terms))


def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(hashes + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0..n-1 of the terms of one shard, with the terms stored to verify a hit."""

    def __init__(self, sizes: list[int], bits: bytes, blob: bytes):
        self.sizes, self.blob = sizes, blob
        words = np.frombuffer(bits, dtype=np.uint64)
        self.cuts = np.cumsum([0, *[(s + 63) // 64 for s in sizes]])
        self.words = words
        self.rank = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)
        self.n = blob.count(b"\n") + 1 if blob else 0
        ends = np.flatnonzero(np.frombuffer(blob + b"\n", dtype=np.uint8) == 0x0A) if self.n else np.zeros(0, dtype=np.int64)
        self.ends = ends
        self.starts = np.concatenate([[0], ends[:-1] + 1]) if self.n else ends
        # Terms whose 64-bit hashes are equal find no place of their own in any level.
        placed = int(np.bitwise_count(words).sum())
        self.rest = {self.term(s): s for s in range(placed, self.n)}

    def term(self, slot: int) -> bytes:
        return self.blob[self.starts[slot]:self.ends[slot]]

    @staticmethod
    def build(terms: list[bytes]) -> tuple[list[int], bytes, bytes]:
        """Sizes of the levels, their bits, and the terms in slot order joined by newlines (which no term holds)."""
        hashes, left = _hashes(terms), np.arange(len(terms))
        sizes, words, order = [], [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = 64 * ((2 * len(left) + 63) // 64)
            place = _place(hashes[left], level, size)
            alone = np.bincount(place, minlength=size)[place] == 1
            bits = np.zeros(size, dtype=np.uint8)
            bits[place[alone]] = 1
            sizes.append(size)
            words.append(np.packbits(bits, bitorder="little").view(np.uint64))
            order.append(left[alone][np.argsort(place[alone])])
            left = left[~alone]
        slots = np.concatenate([*order, left]) if sizes else left
        bits = np.concatenate(words).tobytes() if words else b""
        return sizes, bits, b"\n".join(terms[i] for i in slots)

    def slots(self, terms: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """Slot of every term, -1 if the shard has no such term."""
        found = np.full(len(terms), -1, dtype=np.int64)
        left = np.arange(len(terms))
        for level, size in enumerate(self.sizes):
            place = _place(hashes[left], level, size)
            word, bit = self.cuts[level] + (place >> 6), (place & 63).astype(np.uint64)
            value = self.words[word]
            hit = (value >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1)))
            found[left[hit]] = (self.rank[word] + below)[hit]
            left = left[~hit]
        for i in np.flatnonzero(found >= 0).tolist():
            if self.term(found[i]) != terms[i]:
                found[i] = -1
        if self.rest:
            for i in np.flatnonzero(found < 0).tolist():
                found[i] = self.rest.get(terms[i], -1)
        return found


def _texts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


def kept_terms(texts: DataFrame, least_docs: int = LEAST_DOCS, held: int = HELD_TERMS) -> DataFrame:
    """(lang, term) of terms in at least `least_docs` documents of the language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def sent():
            for lang, counter in seen.items():
                keys = list(counter)
                for a in range(0, len(keys), 1 << 16):
                    part = keys[a:a + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array([k.decode() for k in part]),
                                                      pa.array([counter[k] for k in part], pa.int64())], names=["lang", "term", "n"])
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                seen.setdefault(lang, Counter()).update(set(terms_of(text.as_py())))
                if sum(map(len, seen.values())) > held:
                    yield from sent()
        yield from sent()

    counted = texts.select("lang", "text").mapInArrow(count, "lang string, term string, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least_docs).select("lang", "term")


def perfect_hashes(vocabulary: DataFrame, sizes: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """(lang, shard, shards, sizes, bits, blob): one minimal perfect hash for every shard of a language's terms."""
    shards = F.ceil(F.col("v") / F.lit(shard_terms)).cast("int")
    dealt = (vocabulary.join(F.broadcast(sizes) if sizes.limit(10_001).count() <= 10_000 else sizes, "lang").withColumn("shards", shards)
             .withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards").cast("long")).cast("int")).select("lang", "shard", "shards", "term"))

    def build(part: pa.Table) -> pa.Table:
        sizes, bits, blob = PerfectHash.build([t.encode() for t in part.column("term").to_pylist()])
        return pa.table({"lang": part.column("lang").slice(0, 1), "shard": part.column("shard").slice(0, 1), "shards": part.column("shards").slice(0, 1),
                         "sizes": pa.array([sizes], pa.list_(pa.int64())), "bits": pa.array([bits], pa.binary()), "blob": pa.array([blob], pa.binary())})

    return dealt.groupBy("lang", "shard").applyInArrow(build, "lang string, shard int, shards int, sizes array<long>, bits binary, blob binary")


def _recount(rows: DataFrame, sent_hashes, held: int) -> DataFrame:
    """(lang, source, shard, slot, n) by dense slots; rows carry a text, or a term and its number."""
    whole = "text" in rows.columns

    def recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[int, PerfectHash]] = {}
        shards: dict[str, int] = {}
        for lang, shard, n, sizes, bits, blob in sent_hashes.value:
            known.setdefault(lang, {})[shard] = PerfectHash(sizes, bits, blob)
            shards[lang] = n
        dense: dict[tuple[str, str, int], np.ndarray] = {}

        def add(lang: str, source: str, counter: Counter) -> None:
            terms = list(counter)
            hashes, numbers = _hashes(terms), np.fromiter(counter.values(), dtype=np.int64, count=len(terms))
            shard = hashes.view(np.int64) % shards[lang]
            for s in np.unique(shard).tolist():
                if s in known[lang]:
                    mine = np.flatnonzero(shard == s)
                    slots = known[lang][s].slots([terms[i] for i in mine.tolist()], hashes[mine])
                    hit = slots >= 0
                    place = dense.get((lang, source, s))
                    if place is None:
                        place = dense[lang, source, s] = np.zeros(known[lang][s].n, dtype=np.int64)
                    np.add.at(place, slots[hit], numbers[mine][hit])

        def sent():
            for (lang, source, s), place in dense.items():
                slots = np.flatnonzero(place)
                m = len(slots)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * m, pa.string()), pa.array([source] * m, pa.string()), pa.array(np.full(m, s), pa.int32()),
                     pa.array(slots, pa.int32()), pa.array(place[slots], pa.int64())], names=["lang", "source", "shard", "slot", "n"])
            dense.clear()

        for batch in batches:
            keys = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
            inside: dict[tuple[str, str], list[int]] = {}
            for i, key in enumerate(keys):
                if key[0] in known:
                    inside.setdefault(key, []).append(i)
            words = batch.column("text" if whole else "term")
            numbers = None if whole else batch.column("n").to_pylist()
            for (lang, source), members in inside.items():
                counter: Counter = Counter()
                for i in members:
                    if whole:
                        counter.update(terms_of(words[i].as_py()))
                    else:
                        counter[words[i].as_py().encode()] += numbers[i]
                    if len(counter) > HELD_TERMS:
                        add(lang, source, counter)
                        counter = Counter()
                add(lang, source, counter)
                if sum(map(len, dense.values())) > held:
                    yield from sent()
        yield from sent()

    return rows.mapInArrow(recount, "lang string, source string, shard int, slot int, n long")


def _word_counts(texts: DataFrame, held: int = HELD_TERMS) -> DataFrame:
    """(lang, source, term, n), summed up in the tasks and then by Spark."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def sent():
            keys = list(seen)
            for a in range(0, len(keys), 1 << 16):
                part = keys[a:a + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in part]), pa.array([k[1] for k in part]), pa.array([k[2].decode() for k in part]),
                     pa.array([seen[k] for k in part], pa.int64())], names=["lang", "source", "term", "n"])
            seen.clear()

        for batch in batches:
            for lang, source, text in zip(*[batch.column(c).to_pylist() for c in ("lang", "source", "text")]):
                for term, n in Counter(terms_of(text)).items():
                    seen[lang, source, term] += n
                if len(seen) > held:
                    yield from sent()
        yield from sent()

    return (texts.mapInArrow(count, "lang string, source string, term string, n long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n")))


def slot_counts(texts: DataFrame, hashes: DataFrame, max_bytes: int = BROADCAST_BYTES, held: int = HELD_SLOTS) -> DataFrame:
    """(lang, source, shard, slot, n) of all kept terms that a group has."""
    context = texts.sparkSession.sparkContext
    size = F.octet_length("bits") + F.octet_length("blob") + 64
    total = hashes.agg(F.sum(size)).first()[0] or 0

    def send(part: DataFrame):
        return context.broadcast([(r.lang, r.shard, r.shards, list(r.sizes), bytes(r.bits), bytes(r.blob)) for r in part.collect()])

    if total <= max_bytes:
        counted = _recount(texts, send(hashes), held)
    else:
        # Hashing deals shards into rounds evenly; twice as many rounds as needed keep each under the bound in practice.
        rounds = int(np.ceil(2.0 * total / max_bytes))
        words = stored(_word_counts(texts), "divergence-words")
        in_round = F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds))
        counted = None
        for r in range(rounds):
            part = _recount(words, send(hashes.where(in_round == r)), held)
            counted = part if counted is None else counted.unionByName(part)
    return counted.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))


def _share(count: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 v)) in three steps of 1000 each, so that 64 bits hold every product."""
    top, bottom = count + SMOOTHING, total + v * SMOOTHING
    out = F.lit(0).cast("long")
    for _ in range(3):
        out, top = out * 1000 + F.call_function("div", top * 1000, bottom), (top * 1000) % bottom
    return out + 1


def _distances(present: DataFrame, groups: DataFrame, tiles: DataFrame, tile_terms: int, block: int) -> DataFrame:
    """(lang, a, b, extra) for sources a < b of a language: what terms that either has add beyond the distance of two zero counts."""
    places = present.select("lang", "shard", F.floor(F.col("slot") / F.lit(tile_terms)).cast("int").alias("tile"), "slot", "a", "p", "p0", "blocks")
    # Every source stands in every tile of its language, also without a term there.
    marks = tiles.join(groups, "lang").select("lang", "shard", "tile", F.lit(-1).alias("slot"), "a", F.col("p0").alias("p"), "p0", "blocks")
    own = F.floor(F.col("a") / F.lit(block)).cast("int")
    rows = (places.unionByName(marks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
            .select("lang", "shard", "tile", "low", "high", "own", "a", "slot", "p", "p0"))

    def measure(key, frame: pd.DataFrame) -> pd.DataFrame:
        low, high = key[3], key[4]
        mark = frame["slot"].to_numpy() < 0
        slots, where = np.unique(frame.loc[~mark, "slot"].to_numpy(), return_inverse=True)

        def matrix(own):
            sources = frame[mark & (frame["own"].to_numpy() == own)].sort_values("a")
            ids, base = sources["a"].to_numpy(), sources["p0"].to_numpy()
            values = np.tile(base, (len(slots), 1))
            mine = (~mark) & (frame["own"].to_numpy() == own)
            values[where[mine[~mark]], np.searchsorted(ids, frame.loc[mine, "a"].to_numpy())] = frame.loc[mine, "p"].to_numpy()
            return ids, base, values

        first, second = matrix(low), matrix(high)
        parts = []
        for i, a in enumerate(first[0].tolist()):
            extra = np.abs(first[2][:, i, None] - second[2]).sum(axis=0) - len(slots) * np.abs(first[1][i] - second[1])
            later = second[0] > a
            parts.append(pd.DataFrame({"a": a, "b": second[0][later], "extra": extra[later]}))
        out = pd.concat(parts) if parts else pd.DataFrame({"a": [], "b": [], "extra": []})
        return out.assign(lang=key[0])[["lang", "a", "b", "extra"]].astype({"a": "int32", "b": "int32", "extra": "int64"})

    summed = rows.groupBy("lang", "shard", "tile", "low", "high").applyInPandas(measure, "lang string, a int, b int, extra long")
    return summed.groupBy("lang", "a", "b").agg(F.sum("extra").alias("extra"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS,
          top_terms: int = TOP_TERMS, shard_terms: int = SHARD_TERMS, max_bytes: int = BROADCAST_BYTES, held: int = HELD_SLOTS,
          tile_terms: int = TILE_TERMS, block: int = BLOCK_SOURCES) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the language's other sources, and the terms that a source has too often."""
    texts = _texts(docs, text_col, lang_col, source_col)
    vocabulary = stored(kept_terms(texts, least_docs), "divergence-terms")
    sizes = stored(vocabulary.groupBy("lang").agg(F.count("*").alias("v")), "divergence-sizes")
    hashes = stored(perfect_hashes(vocabulary, sizes, shard_terms), "divergence-hashes")
    counts = stored(slot_counts(texts, hashes, max_bytes, held), "divergence-counts")

    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = Window.partitionBy("lang")
    groups = (texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
              .fillna(0, ["total", "v"]))
    groups = (groups.withColumn("a", F.row_number().over(by_lang.orderBy("source")).cast("int") - 1)
              .withColumn("blocks", F.ceil(F.count("*").over(by_lang) / F.lit(block)).cast("int"))
              .withColumn("lang_total", F.sum("total").over(by_lang))
              .withColumn("p0", F.when(F.col("v") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.greatest("v", F.lit(1))))))
    groups = stored(groups, "divergence-groups")

    few = groups.limit(10_001).count() <= 10_000
    side = F.broadcast(groups) if few else groups
    present = counts.join(side, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")))

    tiles = hashes.select("lang", "shard", F.explode(F.sequence(F.lit(0), F.floor(
        (F.size(F.split(F.decode("blob", "UTF-8"), "\n")) - 1) / F.lit(tile_terms)).cast("int"))).alias("tile"))
    extras = _distances(present, side.where("v > 0"), tiles, tile_terms, block)
    one = groups.select("lang", "source", "a", "v", F.col("p0"))
    two = groups.select("lang", F.col("source").alias("item"), F.col("a").alias("b"), F.col("p0").alias("q0"))
    pairs = (one.join(two, "lang").where("a < b").join(extras, ["lang", "a", "b"], "left")
             .withColumn("value", F.coalesce(F.col("v") * F.abs(F.col("p0") - F.col("q0")), F.lit(0)) + F.coalesce("extra", F.lit(0))))
    both = pairs.select("lang", "source", "item", "value").unionByName(
        pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))

    # The sum over a group's parts comes first, so that a term's language count is one row for each term.
    names = hashes.select("lang", "shard", F.posexplode(F.split(F.decode("blob", "UTF-8"), "\n")).alias("slot", "item"))
    overall = counts.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("lang_n")).join(names, ["lang", "shard", "slot"])
    excess = (present.join(overall, ["lang", "shard", "slot"])
              .withColumn("value", F.col("p") - _share(F.col("lang_n"), F.col("lang_total"), F.col("v"))).where("value > 0"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: (rows.withColumn("rank", F.row_number().over(order))
                                 .select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank"))
    return ranked(both, "pair").unionByName(ranked(excess, "term").where(F.col("rank") <= top_terms))


def op13_hash_recount(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, s.v, sum(coalesce(n.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM g JOIN kept k USING (lang) JOIN sizes s USING (lang) LEFT JOIN n USING (lang, source, term)),
p AS (
  SELECT lang, source, term, n, (1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v))::BIGINT AS p FROM dense),
q AS (
  SELECT lang, term, (1 + (1000000000::HUGEINT * (sum(n) + 5)) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * any_value(v)))::BIGINT AS q
  FROM dense GROUP BY lang, term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
found AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(apart.value, 0)::BIGINT AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN apart ON apart.lang = x.lang AND apart.source = x.source AND apart.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 50
"""
