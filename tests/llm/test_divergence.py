"""The source audit against plain counting, and its perfect hashes by themselves."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm.conftest import EDGES
from windrisk.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least):
    docs = [((r[2] if len(r) > 2 else "en") or "", (r[3] if len(r) > 3 else "s") or "", Counter(TERM.findall((r[1] or "").translate(LOWER)))) for r in rows]
    df = defaultdict(Counter)
    for lang, _, c in docs:
        df[lang].update(c.keys())
    kept = {lang: sorted(t for t, n in c.items() if n >= least) for lang, c in df.items()}
    count = defaultdict(Counter)
    for lang, source, c in docs:
        count[lang, source].update({t: n for t, n in c.items() if t in set(kept[lang])})
        count[lang, None].update({t: n for t, n in c.items() if t in set(kept[lang])})

    def p(lang, source, term):
        return 1 + 10 ** 9 * (count[lang, source][term] + 5) // (sum(count[lang, source].values()) + 5 * len(kept[lang]))

    out = set()
    groups = sorted({(lang, source) for lang, source, _ in docs})
    for lang, source in groups:
        pairs = [(sum(abs(p(lang, source, t) - p(lang, o, t)) for t in kept[lang]), o) for l, o in groups if l == lang and o != source]
        terms = [(p(lang, source, t) - p(lang, None, t), t) for t in kept[lang] if count[lang, source][t] > 0]
        for part, found, most in (("pair", pairs, None), ("term", [x for x in terms if x[0] > 0], 50)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out |= {(lang, source, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)}
    return out


def found(df):
    rows = [tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_docs(seed, n=160):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)] + ["É", "Über", "l'eau", "x1y", "a_b", "日本"]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "s4", None])
        bias = words[:30] if source == "s1" else words
        rows.append((i, " ".join(rng.choice(bias) + rng.choice(["", ".", "7"]) for _ in range(rng.randrange(60))), lang, source))
    return rows + [(900, "rare", "xx", "only"), (901, None, "yy", "a"), (902, "", "yy", "b")]


@pytest.mark.parametrize("options", [
    {}, {"shard_terms": 20, "held": 50, "tile_terms": 16, "block": 2}, {"shard_terms": 20, "max_bytes": 900, "tile_terms": 7, "block": 3}])
def test_audit_equals_plain_counts(make_docs, options):
    """Also with several shards, rounds of broadcasts, tiles and blocks of sources."""
    rows = random_docs(5)
    assert found(divergence.audit(make_docs(rows), least_docs=10, **options)) == brute(rows, 10)


def test_top_terms_and_ties(make_docs):
    rows = [(i, " ".join(f"t{chr(97 + a)}{chr(97 + b)}" for a in range(8) for b in range(8)), "en", "left") for i in range(4)]
    rows += [(10 + i, "other words", "en", "right") for i in range(4)]
    got = found(divergence.audit(make_docs(rows), least_docs=2))
    assert got == brute(rows, 2) and max(r[5] for r in got if r[2] == "term") == 50


def test_edges_and_empty_table(make_docs):
    assert found(divergence.audit(make_docs(EDGES), least_docs=2)) == brute(EDGES, 2)
    assert divergence.audit(make_docs(EDGES).limit(0), least_docs=2).count() == 0


def test_perfect_hash_is_minimal_and_verified():
    rng = random.Random(1)
    terms = sorted({"".join(rng.choice("abcdefgé") for _ in range(rng.randrange(1, 9))) for _ in range(20_000)})
    terms = [t.encode() for t in terms]
    known = divergence.PerfectHash(*divergence.PerfectHash.build(terms[::2]))
    slots = known.slots(terms[::2], divergence._hashes(terms[::2]))
    assert sorted(slots.tolist()) == list(range(len(terms[::2])))
    assert (known.slots(terms[1::2], divergence._hashes(terms[1::2])) == -1).all()


def test_terms_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(divergence, "_hashes", lambda terms: np.array([len(t) for t in terms], dtype=np.uint64))
    terms = [b"aa", b"bb", b"c", b"dd"]
    known = divergence.PerfectHash(*divergence.PerfectHash.build(terms))
    assert sorted(known.slots(terms, divergence._hashes(terms)).tolist()) == [0, 1, 2, 3]
    assert known.slots([b"zz", b"y"], divergence._hashes([b"zz", b"y"])).tolist() == [-1, -1]
