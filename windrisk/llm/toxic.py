"""Toxicity: misspelled lexicon terms by Levenshtein automata on a trie, weighed by their context.

Learning: the words of labelled training texts are counted once per document and class, in Spark, equal texts once. A word enters the lexicon by the lower
bound of its log odds; the strongest LEXICON words are kept, which bounds the model. A word of at least five characters that
is not in the lexicon is run against the trie of the strong terms: the automaton's state is a row of edit
distances, bounded by one edit, and whole subtrees are left out once no entry is within the bound; look-alike digits and signs
count as their letters. Words that clean training documents use themselves are never taken for misspellings; those near a strong term are stored as exceptions.

Scoring: every hit is weighed by the window of WINDOW words around it. Quotation marks and reporting words in the window make it a
quotation, which counts as a fraction QUOTED of direct abuse; words that address a reader raise it. A logistic regression on six
sums of such hits gives the score. It is fitted on at most FIT_ROWS labelled training rows, first by hash of the id; a
row's own label is taken out of the word counts when its sums are made for the fit.

Defined results: NULL and empty texts have no hits and get the score of a text without hits. Labels of NULL or other values than 0 and 1 and labels of
unknown documents teach nothing; several labels of one document count as its largest. Without toxic training rows all scores are 0.
Repeated rows get equal scores.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrisk.llm.common import remainder, small_or_shuffled, stored, table

LEXICON, FIT_ROWS = 3000, 50_000
LEAST_BOUND, STRONG_BOUND = 3.0, 4.2
SHORTEST, WINDOW, QUOTED, ADDRESSED = 5, 5, 0.3, 1.2
STRIP = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~“”„‘’‚«»‹›…¡¿"
QUOTES = set("\"“”„‘’‚«»‹›`")
# Words that tell of a quotation, and words that address a reader.
REPORTING = {"said", "says", "say", "quote", "quoted", "quotes", "called", "wrote", "writes", "told", "term", "word",
             "sagte", "sagt", "schrieb", "nannte", "zitat", "dit", "écrit", "écrivait", "citation", "dijo", "dice", "escribió", "cita"}
ADDRESS = {"you", "your", "you're", "u", "du", "dein", "deine", "ihr", "tu", "vous", "ton", "ta", "usted", "eres", "ustedes"}
FEATURES = 6
_LOOKALIKES = str.maketrans("013457@$!", "oieastasi")


def bare(word: str) -> str:
    return word.strip(STRIP)


def bound(toxic: float, clean: float, n_toxic: float, n_clean: float) -> float:
    """Lower bound of the log odds of a word: estimate less one standard error."""
    odds = math.log((toxic + 0.5) / (n_toxic + 1.0)) - math.log((clean + 0.5) / (n_clean + 1.0))
    return odds - math.sqrt(1.0 / (toxic + 0.5) + 1.0 / (clean + 2.0))


class Trie:
    """Lexicon trie with Levenshtein automata over it, bounded by one edit."""

    def __init__(self, terms):
        self.root: dict = {}
        self.terms = set(terms)
        # Words within one edit share a spelling once a letter is left out of either, or of both.
        self.close = set(self.terms)
        for term in self.terms:
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term
            self.close.update(term[:i] + term[i + 1:] for i in range(len(term)))

    def possible(self, word: str) -> bool:
        """False only if no term is within one edit."""
        close = self.close
        if word in close:
            return True
        for i in range(len(word)):
            if word[:i] + word[i + 1:] in close:
                return True
        return False

    def nearest(self, word: str, k: int) -> tuple[str, int] | None:
        """The nearest term within distance k (the smallest by code point of equally near ones)."""
        best: tuple[int, str] | None = None
        stack = [(self.root, tuple(range(len(word) + 1)))]
        while stack:
            node, row = stack.pop()
            for letter, child in node.items():
                if letter == "":
                    if row[-1] <= k and (best is None or (row[-1], child) < best):
                        best = (row[-1], child)
                    continue
                state = [row[0] + 1]
                for i, own in enumerate(word):
                    state.append(min(state[i] + 1, row[i + 1] + 1, row[i] + (own != letter)))
                if min(state) <= k:
                    stack.append((child, tuple(state)))
        return None if best is None else (best[1], best[0])


class Lexicon:
    """Terms with their counts, exceptions, and the sums of weighed hits of a text."""

    def __init__(self, terms: dict[str, tuple[int, int]], exceptions: dict[str, int], n_toxic: int, n_clean: int):
        self.terms, self.exceptions, self.n = terms, exceptions, (n_toxic, n_clean)
        self.trie = Trie(t for t, c in terms.items() if bound(*c, *self.n) >= STRONG_BOUND and len(t) >= SHORTEST)
        self._hits: dict[str, tuple[str, int]] = {}
        self._clean: set[str] = set()  # recent words without a hit; emptied when full

    def misspelled(self, word: str) -> tuple[str, int] | None:
        """The strong term that a word misspells, and the distance."""
        plain = word.translate(_LOOKALIKES)
        if plain != word and plain in self.trie.terms:
            return plain, 1
        found = self.trie.nearest(plain, 1) if len(plain) >= SHORTEST and self.trie.possible(plain) else None
        return found and (found[0], 1)

    def hits(self, words: set[str]) -> dict[str, tuple[str, int]]:
        """(term, distance) of those lower-case words, as they stand, that hit; the distance of a misspelled one is 1."""
        found = {}
        if len(self._clean) > 600_000:
            self._clean.clear()
        for raw in words - self._clean:
            hit = self._hits.get(raw)
            if hit is None:
                word = bare(raw)
                hit = (word, 0) if word in self.terms else self.misspelled(word)
                if hit is None:
                    self._clean.add(raw)
                    continue
                self._hits[raw] = hit
            found[raw] = hit
        return found

    def sums(self, text: str | None, own: int | None = None) -> list[float]:
        """Six sums over the hits of a text; `own` is the text's label if that was counted in the lexicon."""
        words = text.lower().split() if text else []
        distinct = self.hits(set(words))
        if not distinct:
            return [0.0] * FEATURES
        seen: dict[str, tuple[bool, float]] = {}
        fuzzy = total = 0.0
        for i, raw in enumerate(words):
            found = distinct.get(raw)
            if found is None:
                continue
            term, distance = found
            if distance and self.exceptions.get(bare(raw), 0) - (own == 0) > 0:
                continue
            window = words[max(0, i - WINDOW):i + WINDOW + 1]
            plain = {bare(w) for w in window}
            quoted = any(w[0] in QUOTES or w[-1] in QUOTES for w in window) or not REPORTING.isdisjoint(plain)
            weight = QUOTED if quoted else ADDRESSED if not ADDRESS.isdisjoint(plain) else 1.0
            toxic, clean = self.terms[term]
            # The text's own label does not speak for it.
            worth = bound(max(0, toxic - (own == 1)), max(0, clean - (own == 0)), *self.n)
            if distance:
                fuzzy += weight
            if worth >= LEAST_BOUND:
                is_strong = worth >= STRONG_BOUND
                seen[term] = max(seen.get(term, (is_strong, 0.0)), (is_strong, weight * worth * (0.7 if distance else 1.0)))
                if is_strong:
                    total += weight
        strong = [v for is_strong, v in seen.values() if is_strong]
        return [math.log1p(sum(strong)), float(len(strong) >= 2), math.log1p(sum(v for is_strong, v in seen.values() if not is_strong)),
                math.log1p(fuzzy), math.log1p(total), min(1.0, 50.0 * len(seen) / len(words))]


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, toxic, clean): in how many labelled texts of either class a word stands. A task sums up before it sends."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held)), pa.array([v[1] for v in held.values()], pa.int64()), pa.array([v[0] for v in held.values()], pa.int64())],
                names=["word", "toxic", "clean"])

        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                for word in {bare(w) for w in set((text.as_py() or "").lower().split())}:
                    if word:
                        held.setdefault(word, [0, 0])[label] += 1
                if len(held) > 300_000:
                    yield out()
                    held.clear()
        if held:
            yield out()

    counted = labelled.select("text", F.col("toxic").cast("int")).mapInArrow(count, "word string, toxic long, clean long")
    return counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(labelled: DataFrame, n_toxic: int, n_clean: int, size: int = LEXICON) -> Lexicon:
    """The lexicon of `text, toxic` rows, so many of either class: at most `size` terms and the clean words near the strong ones."""
    counts = stored(word_counts(labelled), "toxic-words")
    t, c = F.col("toxic"), F.col("clean")
    low = (F.log((t + 0.5) / F.lit(n_toxic + 1.0)) - F.log((c + 0.5) / F.lit(n_clean + 1.0))
           - F.sqrt(F.lit(1.0) / (t + 0.5) + F.lit(1.0) / (c + 2.0)))
    rows = counts.where(t > 0).withColumn("low", low).where(F.col("low") >= LEAST_BOUND).orderBy(F.desc("low"), "word").limit(size).collect()
    terms = {r.word: (r.toxic, r.clean) for r in rows}
    lexicon = Lexicon(terms, {}, n_toxic, n_clean)
    shared = labelled.sparkSession.sparkContext.broadcast(lexicon)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        for batch in batches:
            keep = [w not in lexicon.terms and lexicon.misspelled(w) is not None for w in batch.column("word").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    # Words within one edit of `size` terms: a bounded number, as is the alphabet.
    close = counts.where(c > 0).select("word", "clean").mapInArrow(near, "word string, clean long").collect()
    return Lexicon(terms, {r.word: r.clean for r in close}, n_toxic, n_clean)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    w[-1] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)) if len(y) else -5.0
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


_NAMES = [f"s{i}" for i in range(FEATURES)]


def _sums(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """`row` (any type), `own`, `text` -> `row`, `own` and the sums."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    schema = T.StructType([rows.schema["row"], T.StructField("own", T.IntegerType()), *[T.StructField(n, T.DoubleType()) for n in _NAMES]])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        for batch in batches:
            own = batch.column("own").to_pylist()
            rows = np.array([lexicon.sums(t.as_py(), o) for t, o in zip(batch.column("text"), own)]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("own"), *[pa.array(rows[:, i]) for i in range(FEATURES)]],
                                             names=["row", "own", *_NAMES])

    return rows.mapInArrow(sums, schema)


def learn(docs: DataFrame, labels: DataFrame, trained_on=None, id_col: str = "doc_id", text_col: str = "text",
          label_id_col: str = "doc_id", toxic_col: str = "toxic", size: int = LEXICON, fit_rows: int = FIT_ROWS) -> tuple[Lexicon, np.ndarray | None]:
    """Lexicon and weights (None if nothing toxic is labelled). `trained_on(id column)` tells which rows teach; by default all."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    marks = (labels.select(F.col(label_id_col).alias("l_id"), F.col(toxic_col).cast("int").alias("toxic"))
             .where(F.col("toxic").isin(0, 1) & F.col("l_id").isNotNull()))
    if trained_on is not None:
        marks = marks.where(trained_on(F.col("l_id")))
    marks = stored(marks.groupBy("l_id").agg(F.max("toxic").alias("toxic")), "toxic-labels")

    def marked(some: DataFrame) -> DataFrame:
        return texts.join(small_or_shuffled(some, 32), F.col("id") == F.col("l_id"))

    # Copies would make any word of theirs look like evidence, so one document of equal texts is counted.
    chosen = stored(marked(marks).groupBy(F.xxhash64("text"), "toxic").agg(F.min("l_id").alias("l_id")).select("l_id", "toxic"), "toxic-chosen")
    n = {r.toxic: r.n for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    lexicon = learn_lexicon(marked(chosen).select("text", "toxic"), n.get(1, 0), n.get(0, 0), size)
    sample = stored(marks.orderBy(F.xxhash64("l_id"), "l_id").limit(fit_rows), "toxic-sample")
    taught = _sums(marked(sample).select(F.col("id").alias("row"), F.col("toxic").alias("own"), "text"), lexicon).select("own", *_NAMES).toPandas()
    y = taught["own"].to_numpy(dtype=float)
    return lexicon, fit(taught[_NAMES].to_numpy(dtype=float), y) if y.sum() else None


def scored(docs: DataFrame, model: tuple[Lexicon, np.ndarray | None], text_col: str = "text") -> DataFrame:
    """`row` (a struct of all columns of `docs`) and `score` for every row, without a shuffle."""
    lexicon, weights = model
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.lit(None).cast("int").alias("own"), F.col(text_col).alias("text"))
    if weights is None:
        return rows.select("row", F.lit(0.0).alias("score"))
    z = F.lit(float(weights[-1]))
    for name, weight in zip(_NAMES, weights):
        z = z + F.lit(float(weight)) * F.col(name)
    return _sums(rows, lexicon).select("row", (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("score"))


def op8_automata_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"), lambda doc_id: remainder(doc_id, 5) != 0)
    found = scored(docs, model).select("row.doc_id", "score")
    return found.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))
