"""The conversation trie against a plain trie in Python."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from windrisk.llm import prefix_trie

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    # Names that the operator uses itself.
    *[T.StructField(n, T.StringType()) for n in ("conv", "d", "key", "n", "pos", "words", "depth")]])
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], SCHEMA).repartition(3)


def brute(rows):
    """The same by a dictionary from prefixes to members."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            text = text or ""
            own[conv].append(((turn is not None, turn or 0), role or "", hashlib.sha256(text.encode()).digest(), text))
    own = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in own.items()}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = set()
    for path, inside in members.items():
        below = [p for p in members if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len((p[-1][1] if p else "").encode().split()) for p in below)
        ends = ",".join(str(c) for c in sorted(inside) if len(full[c]) == len(path))
        out.add((min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside), len(children), len(leaves), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(spark, rows, **options):
    got = [tuple(r[f] for f in FIELDS) for r in prefix_trie.trie(frame(spark, rows), **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def random_rows(seed, convs=60, longest=14):
    rng = random.Random(seed)
    pool = [("user", "a b c"), ("assistant", "d"), ("user", ""), (None, "e  f"), ("user", None)]
    seqs = [[rng.choice(pool[:2]) for _ in range(rng.randrange(1, longest))] for _ in range(5)]
    rows = []
    for c in rng.sample(range(100), convs):
        turns = list(rng.choice(seqs))
        for _ in range(rng.randrange(3)):
            turns[rng.randrange(len(turns)):] = [rng.choice(pool) for _ in range(rng.randrange(6))] or [pool[0]]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("seed, block, most", [(1, 4, 4096), (2, 1, 4096), (3, 3, 2), (4, 4, 3)])
def test_trie_equals_brute_force(spark, make_docs, seed, block, most):
    """Also with tiny ranges, so that long conversations and wide lists take the ways of hot ones."""
    rows = random_rows(seed)
    assert found(spark, rows, block=block, most=most) == brute(rows)


def test_nulls_ties_repeats_and_negative_ids(spark, make_docs):
    rows = [(0, 0, "user", "hi there"), (0, 1, None, None), (1, None, "user", "x"), (1, None, "user", "x"), (1, 0, "b", "z"), (1, 0, "a", "z"),
            (None, 0, "user", "lost"), (7, 3, "user", "word " * 30_000), (7, 3, "user", "word " * 30_000), (-5, 0, "user", "hi there"),
            (-5, 1, "user", "hi there"), (2, 5, "user", "only"), (40, 0, None, ""), (41, 0, "user", "hi there")]
    for most in (4096, 2):
        assert found(spark, rows, most=most) == brute(rows)


def test_one_conversation_with_most_rows(spark, make_docs):
    rows = [(20, i, "user", f"t {i % 3}") for i in range(300)] + [(21, i, "user", f"t {i % 3}") for i in range(280)] + [(22, 0, "a", "b")]
    assert found(spark, rows, most=16) == brute(rows)


def test_empty_table_has_no_node(spark, make_docs):
    assert prefix_trie.trie(frame(spark, [(None, 1, "user", "x")])).count() == 0
    assert prefix_trie.trie(frame(spark, [(1, 1, "user", "x")]).limit(0)).count() == 0
