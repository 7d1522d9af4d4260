"""Language identification by interpolated Kneser-Ney character models.

Text is lower-cased, runs of anything but letters become one space, and five-character grams are taken from it, four spaces
in front. A character is its code point folded to 12 bits, so a gram is a 60-bit number: dropping the last character is a
shift, dropping the first one a mask. Only the grams of the highest order are counted in the corpus, over all
training texts; every lower order follows from the table of distinct grams, as Kneser-Ney asks: how many different characters
precede a gram. Discounts come from the counts of counts of each order.

The models are sorted arrays of hashes: per language and order the grams, as 60-bit numbers that no two different grams share, with their
counts, and the contexts with totals and numbers of followers. They are kept as a stored table, whole, for any number of languages. Scoring loads shares
of it of at most MODEL_BYTES: languages are put together up to that size, and a language beyond it is cut by the pair of characters before the
last one. All that the probability of a gram needs, in all orders, has the same pair, so a share settles its grams alone; grams of one and two characters go
with every share of their language. One share means one pass over the documents without a shuffle; with more, each pass gives sums for
its languages and grams, which are added up by document. Sums are whole numbers (2**-FIXED bits), so that any number of shares gives the same rows.

The language of lowest cross-entropy per character wins. Rejection is calibrated on all training texts: a text is marked as
rejected if its cross-entropy lies further above the mean of the winning language's training texts than Z_REJECT deviations.

Defined results: a NULL text or one without letters is `und` with score 0. Training rows with NULL text, NULL language or no
letter teach nothing. Ties go to the language first by code point. Without any training row every text is `und`. Repeated rows
count as often as they occur. Texts of any length are scored whole. An empty table gives no rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrisk.llm.common import remainder, stored, table
from windrisk.session import small_side

ORDER, CHAR_BITS = 5, 12
CHAR_MASK = (1 << CHAR_BITS) - 1
PAIR_MASK = (1 << (2 * CHAR_BITS)) - 1
# What a pass sends out: arrays of this many bytes, ROW_BYTES for an entry.
MODEL_BYTES, ROW_BYTES = 128 << 20, 24
FIXED = 20
Z_REJECT = 8.0
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str | None) -> str:
    """Lower-cased letters with single spaces between words; empty if there is no letter."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip() if text else ""


def grams(cleaned: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All grams of non-empty cleaned texts, one after the other, and where each text begins."""
    pad = " " * (ORDER - 1)
    joined = "".join(f"{pad}{t} " for t in cleaned)
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    points = (points ^ (points >> np.uint32(CHAR_BITS))).astype(np.uint64) & np.uint64(CHAR_MASK)
    packed = np.zeros(len(points) - ORDER + 1, dtype=np.uint64)
    for i in range(ORDER):
        packed = (packed << np.uint64(CHAR_BITS)) | points[i:len(points) - ORDER + 1 + i]
    sizes = np.array([len(t) + 1 for t in cleaned])
    starts = np.concatenate([[0], np.cumsum(sizes + ORDER - 1)[:-1]])
    # Grams that would reach into the next text are left out.
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    return packed[at], np.concatenate([[0], np.cumsum(sizes)[:-1]])


def _pieces(texts: list[str], most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) + ORDER
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def gram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) of the highest order over all rows with a language; a task sums up before it sends."""
    source = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def fold(lang, keys, counts):
            if lang in held:
                keys, counts = np.concatenate([held[lang][0], keys]), np.concatenate([held[lang][1], counts])
                keys, at = np.unique(keys, return_inverse=True)
                counts = np.bincount(at, weights=counts).astype(np.int64)
            held[lang] = keys, counts

        def out(lang):
            keys, counts = held.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(counts)],
                                              names=["lang", "gram", "n"])

        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if cleaned := letters(text):
                    by_lang.setdefault(lang, []).append(cleaned)
            for lang, texts in by_lang.items():
                for a, b in _pieces(texts):
                    keys, counts = np.unique(grams(texts[a:b])[0], return_counts=True)
                    fold(lang, keys, counts)
                if len(held[lang][0]) > 1 << 20:
                    yield out(lang)
        for lang in list(held):
            yield out(lang)

    return source.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Models:
    """Stored entries (lang, order, kind, key, n, m, pair) of all languages, their discounts, and the shares to score them in."""
    entries: DataFrame
    discounts: dict[str, dict[int, float]]
    shares: list[tuple[list[str], int]]

    def load(self, langs: list[str], parts: int, part: int) -> dict[str, "KneserNey"]:
        """Arrays of one share of some languages; the bytes of what comes to the driver are bounded by the way shares are made."""
        mine = self.entries.where(F.col("lang").isin(langs))
        if parts > 1:
            mine = mine.where((F.col("order") <= 2) | (_part(F.col("pair"), parts) == part))
        rows = mine.select("lang", "order", "kind", "key", "n", "m").toArrow().to_pandas()
        return {lang: KneserNey({c: own[c].to_numpy() for c in ("order", "kind", "key", "n", "m")}, self.discounts.get(lang, {}))
                for lang, own in sorted(rows.groupby("lang"))}


def _part(pair, parts: int):
    """Part of a pair of characters, for a column."""
    return F.shiftrightunsigned(pair * F.lit(2654435761), 16) % parts


def _parts(packed: np.ndarray, parts: int) -> np.ndarray:
    """The same for the pairs of grams of the highest order."""
    pair = (packed >> np.uint64(CHAR_BITS)) & np.uint64(PAIR_MASK)
    return ((pair * np.uint64(2654435761)) >> np.uint64(16)) % np.uint64(parts)


def _shares(sizes: list[tuple[str, int, int]], model_bytes: int) -> list[tuple[list[str], int]]:
    """Languages with their entries of up to two characters and of more -> (languages, number of parts) of each share."""
    most = max(1, model_bytes // ROW_BYTES)
    shares, held, size = [], [], 0
    for lang, low, high in sorted(sizes):
        if low + high > most:
            shares.append(([lang], -(-high // max(1, most - low, most // 2))))
            continue
        if size + low + high > most:
            shares.append((held, 1))
            held, size = [], 0
        held, size = [*held, lang], size + low + high
    return [*shares, (held, 1)] if held else shares


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", model_bytes: int = MODEL_BYTES) -> Models:
    """Models of all languages, as a stored table. The driver receives a few numbers per language."""
    top = stored(gram_counts(docs, text_col, lang_col), "grams")
    tables = {ORDER: top}
    for order in range(ORDER - 1, 0, -1):
        # Continuation counts: in how many distinct grams one order higher a gram is the end.
        keep = F.lit((1 << (CHAR_BITS * order)) - 1)
        tables[order] = stored(tables[order + 1].groupBy("lang", F.col("gram").bitwiseAND(keep).alias("gram"))
                               .agg(F.count("*").alias("n")), f"grams-{order}")
    context = F.shiftrightunsigned("gram", CHAR_BITS)
    entries, few = None, None
    for order, grams_of in tables.items():
        at = F.lit(order).alias("order")
        own = grams_of.select("lang", at, F.lit(0).alias("kind"), F.col("gram").alias("key"), "n", F.lit(1).cast("long").alias("m"),
                              context.bitwiseAND(F.lit(PAIR_MASK)).alias("pair"))
        before = grams_of.groupBy("lang", context.alias("key")).agg(F.sum("n").alias("n"), F.count("*").alias("m")).select(
            "lang", at, F.lit(1).alias("kind"), "key", "n", "m", F.col("key").bitwiseAND(F.lit(PAIR_MASK)).alias("pair"))
        rare = grams_of.where("n <= 2").groupBy("lang", at, "n").agg(F.count("*").alias("grams"))
        entries = own.unionByName(before) if entries is None else entries.unionByName(own).unionByName(before)
        few = rare if few is None else few.unionByName(rare)
    entries = stored(entries, "kneser-ney")
    seen: dict[str, dict[int, dict[int, int]]] = {}
    for r in few.collect():
        seen.setdefault(r.lang, {}).setdefault(r.order, {})[r.n] = r.grams
    discounts = {lang: {order: c[1] / (c[1] + 2.0 * c[2]) for order, c in orders.items() if len(c) == 2} for lang, orders in seen.items()}
    is_low = F.col("order") <= 2
    sizes = entries.groupBy("lang").agg(F.count_if(is_low).alias("low"), F.count_if(~is_low).alias("high")).collect()
    return Models(entries, discounts, _shares([(r.lang, r.low, r.high) for r in sizes], model_bytes))


class KneserNey:
    """Sorted arrays of one language, or of its share."""

    def __init__(self, rows: dict[str, np.ndarray], discount: dict[int, float]):
        self.grams, self.contexts = {}, {}
        self.discount = {order: discount.get(order, 0.5) for order in range(1, ORDER + 1)}
        for order in range(1, ORDER + 1):
            for kind, into in ((0, self.grams), (1, self.contexts)):
                at = np.flatnonzero((rows["order"] == order) & (rows["kind"] == kind))
                at = at[np.argsort(rows["key"][at])]
                into[order] = rows["key"][at].astype(np.uint64), rows["n"][at].astype(np.float64), rows["m"][at].astype(np.float64)
        self.characters = max(1, len(self.grams[1][0])) + 1

    @staticmethod
    def _find(table: tuple[np.ndarray, ...], keys: np.ndarray) -> tuple[np.ndarray, ...]:
        known = table[0]
        if not len(known):
            return np.zeros(len(keys)), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        hit = known[at] == keys
        return np.where(hit, table[1][at], 0.0), np.where(hit, table[2][at], 0.0)

    def bits(self, packed: np.ndarray) -> np.ndarray:
        """-log2 p of the last character of each gram, given the characters before it, in steps of 2**-FIXED."""
        p = np.full(len(packed), 1.0 / self.characters)
        for order in range(1, ORDER + 1):
            keys = packed & np.uint64((1 << (CHAR_BITS * order)) - 1)
            count, _ = self._find(self.grams[order], keys)
            total, followers = self._find(self.contexts[order], keys >> np.uint64(CHAR_BITS))
            d = self.discount[order]
            seen = total > 0
            safe = np.where(seen, total, 1.0)
            p = np.where(seen, np.maximum(count - d, 0.0) / safe + d * followers / safe * p, p)
        return np.rint(-np.log2(np.maximum(p, 1e-12)) * (1 << FIXED)).astype(np.int64)


_BEST = "array<struct<total:bigint,lang:string>>"


def _pass(source: DataFrame, models: dict[str, KneserNey], parts: int = 1, part: int = 0) -> DataFrame:
    """`id, text_hash, text` -> id, text_hash, characters, grams, and the sums of the two best languages, over the grams of one part."""
    shared = source.sparkSession.sparkContext.broadcast(models)
    schema = T.StructType([*source.schema.fields[:2], T.StructField("characters", T.LongType()), T.StructField("grams", T.LongType()),
                           T.StructField("best", T.DataType.fromDDL(_BEST))])
    kind = pa.list_(pa.struct([("total", pa.int64()), ("lang", pa.string())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        names = list(models)
        for batch in batches:
            texts = [letters(t) for t in batch.column("text").to_pylist()]
            for a, b in _pieces(texts):
                some = texts[a:b]
                full = [i for i, t in enumerate(some) if t]
                best, sizes = [[] for _ in some], [0] * len(some)
                if full and names:
                    packed, starts = grams([some[i] for i in full])
                    distinct, at = np.unique(packed, return_inverse=True)
                    mine = np.arange(len(distinct)) if parts == 1 else np.flatnonzero(_parts(distinct, parts) == part)
                    sums = np.zeros((len(names), len(starts)), np.int64)
                    for k, name in enumerate(names):
                        bits = np.zeros(len(distinct), np.int64)
                        bits[mine] = models[name].bits(distinct[mine])
                        sums[k] = np.add.reduceat(bits[at], starts)
                    # Names are in order, and so are equal sums.
                    first = np.argsort(sums, axis=0, kind="stable")[:2]
                    for k, (i, n) in enumerate(zip(full, np.diff(np.append(starts, len(packed))))):
                        best[i] = [{"total": int(sums[f, k]), "lang": names[f]} for f in first[:, k]]
                        sizes[i] = int(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), batch.column("text_hash").slice(a, b - a), pa.array([len(t) for t in some], pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(best, kind)], names=[f.name for f in schema.fields])

    return source.mapInArrow(score, schema)


def _all_passes(source: DataFrame, models: Models) -> DataFrame:
    """What one pass over all languages would give, from a pass for every share: sums are added per document, the two least stay."""
    key = ["id", "text_hash"]
    sums = None
    for langs, parts in models.shares:
        for part in range(parts):
            done = stored(_pass(source, models.load(langs, parts, part), parts, part), "share-sums")
            own = done.select(*key, "characters", "grams", F.explode("best").alias("b")).select(
                *key, "characters", "grams", "b.lang", "b.total", F.lit(part).alias("part"))
            sums = own if sums is None else sums.unionByName(own)
    # Repeated rows have equal sums, which count once.
    totals = sums.groupBy(*key, "lang", "part").agg(F.first("total").alias("total"), F.first("characters").alias("characters"), F.first("grams").alias("grams"))
    totals = totals.groupBy(*key, "lang").agg(F.sum("total").alias("total"), F.first("characters").alias("characters"), F.first("grams").alias("grams"))
    best = F.slice(F.array_sort(F.collect_list(F.struct("total", "lang"))), 1, 2)
    found = totals.groupBy(*key).agg(F.first("characters").alias("characters"), F.first("grams").alias("grams"), best.alias("best"))
    found = stored(found.select(F.col("id").alias("s_id"), F.col("text_hash").alias("s_hash"), "characters", "grams", "best"), "document-sums")
    match = F.col("text_hash").eqNullSafe(F.col("s_hash")) & F.col("id").eqNullSafe(F.col("s_id"))
    return source.select(*key).join(found, match, "left").select(
        *key, F.coalesce("characters", F.lit(0)).alias("characters"), F.coalesce("grams", F.lit(0)).alias("grams"),
        F.coalesce("best", F.array().cast(_BEST)).alias("best"))


def cross_entropies(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, characters, lang (the best one), bits (its cross-entropy per character), gap (to the second best)."""
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    shares = models.shares
    if len(shares) > 1 or any(parts > 1 for _, parts in shares):
        scored = _all_passes(source, models)
    else:
        scored = _pass(source, models.load(shares[0][0], 1, 0) if shares else {})
    per_gram = lambda place: F.try_element_at("best", F.lit(place))["total"] / F.col("grams") / float(1 << FIXED)
    has = F.size("best") > 0
    gap = F.when(F.size("best") > 1, per_gram(2) - per_gram(1)).otherwise(1.0)
    return scored.select("id", "characters", F.try_element_at("best", F.lit(1))["lang"].alias("lang"), F.when(has, per_gram(1)).alias("bits"),
                         F.when(has, gap).alias("gap"))


def identify(docs: DataFrame, trained_on, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             z_reject: float = Z_REJECT, model_bytes: int = MODEL_BYTES) -> DataFrame:
    """Per row: id, lang_pred, score, bits, rejected. `trained_on(id column)` tells which rows teach.

    The score is 1 - 2**-(gap * min(characters, 100)): near 0 if the two best languages fit alike, near 1 if one fits far better.
    """
    teaching = docs.where(trained_on(F.col(id_col)))
    models = train(teaching, text_col, lang_col, model_bytes)
    scored = stored(cross_entropies(docs, models, id_col, text_col), "entropies")
    limits = (scored.where(trained_on(F.col("id")) & F.col("bits").isNotNull()).groupBy(F.col("lang").alias("l_lang"))
              .agg((F.avg("bits") + F.lit(z_reject) * F.stddev_pop("bits")).alias("limit")))
    joined = scored.join(small_side(limits), F.col("lang") == F.col("l_lang"), "left")
    score = F.lit(1.0) - F.pow(F.lit(2.0), -F.col("gap") * F.least(F.col("characters"), F.lit(100)))
    return joined.select("id", F.coalesce("lang", F.lit("und")).alias("lang_pred"), F.coalesce(score, F.lit(0.0)).alias("score"),
                         "bits", F.coalesce(F.col("bits") > F.col("limit"), F.lit(True)).alias("rejected"))


def op10_kneser_ney(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, lambda doc_id: remainder(doc_id, 4) != 2)
    return found.select(F.col("id").alias("doc_id"), (remainder(F.col("id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
