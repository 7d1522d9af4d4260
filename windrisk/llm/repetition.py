"""Quality rule on repetition within a text, by suffix array and LCP intervals.

The suffix array is built over words (word ids as symbols) by prefix doubling, for many texts at once: a word's id is its own in
each text, so no suffix compares equal across texts. Positions whose prefix is already unique drop out of the doubling. The rank arrays of all
doublings give the LCP of neighbouring suffixes by descent over powers of two. LCP intervals of at least `least` words whose
occurrences differ in the word before are the maximal repeats; the spans of their occurrences are united.

A text is rejected if maximal repeats cover more than `most_covered` of its words or the longest has more than `most_longest`
words, besides the base rule (fewer than 10 words, or more than 20 % of words in repeated 5-word windows).

Defined results: a NULL or empty text has no words, fails the base rule and is not kept. Overlapping occurrences count. Repeated rows get
equal results, NULL ids pass through, an empty table gives an empty result. Very long texts take n log n time and, while they are
measured, one array of ranks for each doubling of the longest repeat.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrisk.llm.common import table
from windrisk.llm.shingles import word_hashes

WINDOW = 5
LEAST, MOST_COVERED, MOST_LONGEST = 10, 0.15, 100
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array, and the rank arrays by first 1, 2, 4, .. symbols (one entry longer than `ids`, -1 at the end)."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    head = np.ones(n, dtype=bool)
    head[1:] = ids[order[1:]] != ids[order[:-1]]
    rank = np.full(n + 1, -1, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    ranks, step = [rank], 1
    while True:
        single = head & np.append(head[1:], True)
        slots = np.flatnonzero(~single)
        if not len(slots):
            return order, ranks
        at = order[slots]
        first, second = rank[at], rank[np.minimum(at + step, n)]
        turn = np.lexsort((second, first))
        at, first, second = at[turn], first[turn], second[turn]
        order[slots] = at
        new = np.ones(len(slots), dtype=bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        head[slots] = new
        rank = rank.copy()
        rank[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        ranks.append(rank)
        step *= 2


def neighbour_lcp(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """lcp[t]: common prefix of suffixes t - 1 and t of the array; 0 at both ends (one entry more than suffixes)."""
    n = len(order)
    lcp = np.zeros(n + 1, dtype=np.int64)
    if n > 1:
        t = np.flatnonzero(ranks[0][order[1:]] == ranks[0][order[:-1]]) + 1
        a, b, length = order[t - 1].copy(), order[t].copy(), np.zeros(len(t), dtype=np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            same = ranks[level][a] == ranks[level][b]
            length += same.astype(np.int64) << level
            a, b = np.where(same, a + (1 << level), a), np.where(same, b + (1 << level), b)
        lcp[t] = length
    return lcp


def lcp_intervals(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of every LCP interval of at least `least` symbols, by a stack over the runs that reach it."""
    reach = np.flatnonzero(lcp >= least)
    for run in np.split(reach, np.flatnonzero(np.diff(reach) > 1) + 1) if len(reach) else ():
        stack: list[tuple[int, int]] = []
        for t, value in zip([*run.tolist(), int(run[-1]) + 1], [*lcp[run].tolist(), 0]):
            left = t - 1
            while stack and stack[-1][0] > value:
                length, left = stack.pop()
                yield length, left, t - 1
            if value and (not stack or stack[-1][0] < value):
                stack.append((value, left))


def maximal_repeats(words: list, least: int = LEAST) -> list[tuple[int, list[int]]]:
    """(length, positions) of the maximal repeats of one sequence of words."""
    if len(words) < 2:
        return []
    ids = np.unique(np.asarray(words), return_inverse=True)[1]
    order, ranks = suffix_array(ids)
    out = []
    for length, first, last in lcp_intervals(neighbour_lcp(order, ranks), least):
        at = np.sort(order[first:last + 1])
        before = ids[at[at > 0] - 1]
        if at[0] == 0 or len(np.unique(before)) > 1:
            out.append((length, at.tolist()))
    return out


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def measure(texts: list[str], least: int = LEAST) -> np.ndarray:
    """Per text: words, words in repeated windows, words in maximal repeats, longest repeat, number of maximal repeats."""
    hashes = [word_hashes(t, lower=False) for t in texts]
    sizes = np.array([len(h) for h in hashes])
    out = np.zeros((len(texts), 5), dtype=np.int64)
    out[:, 0] = sizes
    n = int(sizes.sum())
    if not n:
        return out
    doc = np.repeat(np.arange(len(texts)), sizes)
    with np.errstate(over="ignore"):
        own = np.concatenate(hashes) ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order, ranks = suffix_array(own)
    lcp = neighbour_lcp(order, ranks)
    deepest = np.zeros(n, dtype=np.int64)
    deepest[order] = np.maximum(lcp[:-1], lcp[1:])
    windows = np.flatnonzero(deepest >= WINDOW)
    out[:, 1] = np.bincount(doc[_covered(windows, np.full(len(windows), WINDOW), n)], minlength=len(texts))
    before = np.concatenate([[-1], ranks[0][:n - 1]])
    before[np.concatenate([[0], np.cumsum(sizes)[:-1]])[sizes > 0]] = -1
    longest, tops = _innermost(order, before, lcp, least)
    repeated = np.flatnonzero(longest)
    if len(repeated):
        starts, lengths = order[repeated], longest[repeated]
        out[:, 2] = np.bincount(doc[_covered(starts, lengths, n)], minlength=len(texts))
        np.maximum.at(out[:, 3], doc[starts], lengths)
        out[:, 4] = np.bincount(doc[order[tops]], minlength=len(texts))
    return out


def _innermost(order: np.ndarray, before: np.ndarray, lcp: np.ndarray, least: int) -> tuple[np.ndarray, list[int]]:
    """Length of the innermost maximal repeat at every place of the suffix array (0: none), and the first place of each maximal repeat.

    An interval is maximal if the symbol before its suffixes changes inside it, told by a running count of changes. Intervals come
    innermost first; each place is set once, and set places are stepped over, so nested intervals cost no more than flat ones.
    """
    ahead = before[order]
    changes = np.concatenate([[0], np.cumsum(ahead[1:] != ahead[:-1])]).tolist()
    longest = np.zeros(len(order), dtype=np.int64)
    free: dict[int, int] = {}  # from a set place towards the next one that is not
    tops = []
    for length, first, last in lcp_intervals(lcp, least):
        if changes[first] == changes[last]:
            continue
        tops.append(first)
        place = first
        while place <= last:
            step, path = place, []
            while step in free:
                path.append(step)
                step = free[step]
            for p in path:
                free[p] = step
            if step > last:
                break
            longest[step] = length
            free[step] = step + 1
            place = step + 1
    return longest, tops


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
               most_covered: float = MOST_COVERED, most_longest: int = MOST_LONGEST) -> DataFrame:
    """Per row: id, base measures, covered_fraction, longest_repeat, n_maximal_repeats, base_failed, kept."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat", "n_maximal_repeats"]
    schema = T.StructType([source.schema["id"], *[T.StructField(n, T.LongType()) for n in names]])

    def rows_of(texts: list[str]) -> np.ndarray:
        found = measure(texts, least)
        plain = np.zeros((len(texts), 3), dtype=np.int64)
        for i, text in enumerate(texts):
            lines = [line for line in text.split("\n") if line.strip(SPACES)]
            plain[i] = (len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)))
        return np.column_stack([found[:, 0], plain, found[:, 1:]])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            start = size = 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= 1 << 19 or i == len(texts) - 1:
                    table_of = rows_of(texts[start:i + 1])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").slice(start, i + 1 - start), *[pa.array(c) for c in table_of.T]], names=["id", *names])
                    start, size = i + 1, 0

    base = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    fraction = F.col("covered_words") / F.greatest(F.col("n_words"), F.lit(1))
    return (source.mapInArrow(measured, schema).withColumn("covered_fraction", fraction).withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & (F.col("covered_fraction") <= most_covered) & (F.col("longest_repeat") <= most_longest)))


def op1_suffix_repetition(spark, sf_dir):
    found = repetition(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept", "covered_fraction", "longest_repeat", "n_maximal_repeats")
