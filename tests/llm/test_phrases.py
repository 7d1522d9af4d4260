"""Substring dedup against every window by itself."""

import random

import pytest

from llm.conftest import EDGES
from windrisk.llm import phrase_automata

LAST = (1 << 63) - 1


def brute(rows, window):
    words = [(i, (LAST if i is None else i), (t or "").encode().split()) for i, t in rows]
    first = {}
    for _, own, w in words:
        for k in range(len(w) - window + 1):
            s = tuple(w[k:k + window])
            first[s] = min(first.get(s, LAST), own)
    out = []
    for i, own, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < own:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


def passages(seed, n=120):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(30))
    shared = [" ".join(word() for _ in range(rng.randrange(10, 80))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 30))) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(shared).split()
            a = rng.randrange(len(passage))
            parts.insert(rng.randrange(len(parts) + 1), " ".join(passage[a:a + rng.randrange(5, 60)]))
        rows.append((rng.randrange(200) if rng.random() < 0.9 else None, rng.choice(["  ", "\n", " "]).join(parts)))
    return rows + rng.sample(rows, 15) + [(300 + i, rows[0][1]) for i in range(5)]


@pytest.mark.parametrize("options", [{}, {"shard_windows": 3}, {"shard_windows": 40, "longest": 2}, {"window": 4, "gram": 2}])
def test_equals_brute_force(make_docs, options):
    """Also with crowded minimizers, many shards, short pieces and short windows."""
    rows = passages(11)
    assert found(phrase_automata.without_repeats(make_docs(rows), **options)) == brute(rows, options.get("window", 13))


def test_repetition_inside_one_document_stays(make_docs):
    run = " ".join(f"w{i}" for i in range(20))
    rows = [(1, f"{run} x {run}"), (2, f"y {run} {run} z"), (3, "W0 " + run[3:]), (4, "same " * 200), (5, "same " * 13)]
    assert found(phrase_automata.without_repeats(make_docs(rows))) == brute(rows, 13)


def test_edges_and_empty_table(make_docs):
    rows = EDGES + [(8, "word " * 30_000 + "end"), (None, "word " * 20)]
    assert found(phrase_automata.without_repeats(make_docs(rows))) == brute(rows, 13)
    assert phrase_automata.without_repeats(make_docs(rows).limit(0)).count() == 0
