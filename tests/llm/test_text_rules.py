"""Repetition, tokens, toxicity and language: against brute force, round trips and held-out rows."""

import math
import random
import time
import re
from collections import defaultdict

import public_tokenizers
import pytest
import sentencepiece

from llm.conftest import EDGES, prose
from windrisk.llm import langid, piece_bpe, repetition, toxic

WORD = re.compile("[^\x20\x09-\x0D]+")


def covered(words, size):
    at = defaultdict(list)
    for i in range(len(words) - size + 1):
        at[tuple(words[i:i + size])].append(i)
    return len({i + k for starts in at.values() if len(starts) > 1 for i in starts for k in range(size)})


def test_repetition_equals_brute_force(make_docs):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab c dé".split()) for _ in range(rng.randrange(0, 80))) for _ in range(60)]
    texts += ["x y z " * 40, "l1 l2\nl1 l2\n\n \nl1 l2\nq#*", prose(rng, 300)]
    rows = [*enumerate(texts, 100), *EDGES]
    got = repetition.repetition(make_docs(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.id: r for r in got if r.id is not None}
    for doc_id, text in rows:
        if doc_id is None:
            continue
        text, r = text or "", by_id[doc_id]
        words = WORD.findall(text)
        lines = [line for line in text.split("\n") if WORD.search(line)]
        assert (r.n_words, r.word_chars, r.n_dup_lines) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        if len(words) < 1000:
            assert (r.n_repeat_words, r.covered_words) == (covered(words, 5), covered(words, repetition.LEAST))
        assert r.base_failed == (len(words) < 10 or r.n_repeat_words * 5 > len(words))
    assert not by_id[6].kept and by_id[162].kept


def test_maximal_repeats_equal_brute_force():
    rng = random.Random(2)
    for _ in range(100):
        s = [rng.choice("abc") for _ in range(rng.randrange(25))]
        want = set()
        for size in range(2, len(s)):
            at = defaultdict(list)
            for i in range(len(s) - size + 1):
                at[tuple(s[i:i + size])].append(i)
            for starts in at.values():
                left = {s[i - 1] if i else ("start", i) for i in starts}
                right = {s[i + size] if i + size < len(s) else ("end", i) for i in starts}
                if len(starts) > 1 and len(left) > 1 and len(right) > 1:
                    want.add((size, tuple(starts)))
        assert {(n, tuple(p)) for n, p in repetition.maximal_repeats(s, 2)} == want


def test_pieces_equal_the_library_on_odd_texts(make_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(3)
    odd = ["  two  spaces ", "▁▁already", "naïve 東京 ‍🙂 \x00\x07", "<s> </s> <0x41>", "\n\n\t", "a" * 5000, "aaaa bbb" * 300]
    odd += ["".join(rng.choice("ab ▁é🙂\n<") for _ in range(rng.randrange(60))) for _ in range(80)]
    rows = [*enumerate(odd, 100), *EDGES]
    got = piece_bpe.pieces(make_docs(rows)).collect()
    assert len(got) == len(rows)
    texts = dict(r for r in rows if r[0] is not None)
    for r in got:
        if r.id is not None:
            assert r.ids == library.encode(texts[r.id] or "", add_eos=True) and r.decoded == library.decode(r.ids)


@pytest.mark.parametrize("word,found", [("idiot", ("idiot", 0)), ("idiox", ("idiot", 1)), ("idot", None), ("idiott", ("idiot", 1)), ("1d1ot", ("idiot", 1)),
                                        ("idoit", None), ("riot", None), ("", None)])
def test_automata_find_what_edit_distance_allows(word, found):
    lexicon = toxic.Lexicon({"idiot": (400, 0), "moron": (400, 0)}, {}, 1000, 9000)
    assert lexicon.hits({word}).get(word) == found


def test_nearest_term_equals_brute_force():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 7)))
    trie = toxic.Trie({word() for _ in range(20)})
    for _ in range(300):
        w = word()
        near = min((distance(w, t), t) for t in trie.terms)
        want = (near[1], near[0]) if near[0] <= 1 else None
        assert trie.nearest(w, 1) == want and (want is None or trie.possible(w))


def test_quotation_weighs_less_than_abuse():
    lexicon = toxic.Lexicon({"idiot": (400, 0)}, {}, 1000, 9000)
    direct = lexicon.sums("what an idiot this person is")
    quoted = lexicon.sums('they said the word "idiot" is rude')
    assert direct[0] > quoted[0] > 0 and lexicon.sums(None) == [0.0] * toxic.FEATURES


def toxic_rows(rng):
    for i in range(400):
        words = prose(rng, 60).split()
        label = i % 4 == 0
        if label:
            for w in rng.sample(["idiot", "moron", "scum"], 2):
                words.insert(rng.randrange(60), w)
        yield i, " ".join(words), int(label)


def test_toxicity_on_held_out_rows_and_edges(spark, make_docs):
    rows = list(toxic_rows(random.Random(5)))
    docs = make_docs([(i, t) for i, t, _ in rows] + [(1000 + (i or 0), t) for i, t in EDGES] + [(2000, "you are a m0ron and an idjot my friend")])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5000, 1), (3, None), (3, 7)], "doc_id long, toxic int")
    found = toxic.scored(docs, toxic.learn(docs, labels, lambda c: c % 5 != 0)).select("row.doc_id", "row.score", "score").toDF("doc_id", "old", "score").collect()
    score = {r.doc_id: r.score for r in found}
    assert len(found) == len(rows) + len(EDGES) + 1 and {r.old for r in found} == {"x"}
    held = [(score[i] >= 0.5) == bool(y) for i, _, y in rows if i % 5 == 0]
    assert sum(held) >= len(held) - 1 and score[2000] >= 0.5 and all(score[1000 + i] < 0.5 for i, _ in EDGES if i)
    none = toxic.scored(docs.limit(0), toxic.learn(docs.limit(0), labels))
    assert none.count() == 0


def test_languages_on_held_out_rows_and_edges(make_docs):
    rng = random.Random(6)
    stems = {"aa": "ka lo mi tu ra ne".split(), "bb": "sch ung ver che ein der".split()}
    rows = []
    for i in range(300):
        lang = "aa" if i % 2 else "bb"
        rows.append((i, " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(20)), lang))
    edges = [(1000, None, "aa"), (1001, "12 34 !", "aa"), (1002, "", None), (1003, rows[0][1], None), (None, rows[1][1], "aa")]
    docs = make_docs(rows + edges)
    got = {r.id: r for r in langid.identify(docs, lambda c: c % 4 != 2).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (1000, 1001, 1002)) and got[1003].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.identify(docs.limit(0), lambda c: c % 4 != 2).count() == 0


def test_kneser_ney_sums_to_one_and_hashes_as_sql_does(spark, make_docs):
    import numpy as np
    from pyspark.sql import functions as F
    values = [0, 1, -5, 2**60 - 1, 123456789]
    want = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v long").select(F.xxhash64("v")).collect()]
    assert langid._xxhash64_long(np.array(values)).view(np.int64).tolist() == want
    model = langid.train(make_docs([(1, "abab abba", "x"), (2, "baab", "x")]))["x"]
    context = np.uint64(0)
    for c in "  ab":
        context = (context << np.uint64(12)) | np.uint64(ord(c))
    letters = np.array([ord(c) for c in " ab"], dtype=np.uint64)
    packed = (context << np.uint64(12)) | letters
    total = (2.0 ** -model.bits(packed, langid.hash_arrays(packed))).sum()
    assert 0.7 < total <= 1.0 + 1e-9  # the rest is kept for characters never seen


@pytest.mark.parametrize("unit", ["word ", "a b ", "x y z x "])
def test_repetition_of_very_repetitive_texts_is_not_quadratic(unit):
    text = unit * (400_000 // len(unit.split()))
    start = time.process_time()
    words, in_windows, covered_words, longest, _ = repetition.measure([text])[0].tolist()
    assert time.process_time() - start < 8
    assert (words, in_windows, covered_words) == (400_000, 400_000, 400_000) and longest == 400_000 - len(unit.split())


def test_repetition_of_an_empty_table(make_docs):
    assert repetition.repetition(make_docs([(1, "a")]).limit(0)).count() == 0


def brute_bits(teaching, text):
    """Interpolated Kneser-Ney by its definition: cross-entropy of the cleaned text, per character and end."""
    order = langid.ORDER
    pad = lambda t: " " * (order - 1) + langid.letters(t) + " "
    top = defaultdict(int)
    for t in teaching:
        s = pad(t)
        for i in range(len(s) - order + 1):
            top[s[i:i + order]] += 1
    counts = {order: top}
    for n in range(order - 1, 0, -1):
        counts[n] = defaultdict(int)
        for g in counts[n + 1]:
            counts[n][g[1:]] += 1

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1.0 / (len(counts[1]) + 1)
        table = counts[n]
        few = [sum(1 for c in table.values() if c == k) for k in (1, 2)]
        d = few[0] / (few[0] + 2 * few[1]) if all(few) else 0.5
        after = [c for g, c in table.items() if g[:-1] == gram[:-1]]
        lower = p(gram[1:])
        return lower if not after else max(table.get(gram, 0) - d, 0.0) / sum(after) + d * len(after) / sum(after) * lower
    s = pad(text)
    each = [-math.log2(max(p(s[i:i + order]), 1e-12)) for i in range(len(s) - order + 1)]
    return sum(each) / len(each)


def language_rows(rng, languages, texts):
    for i in range(languages):
        stems = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöüéñ") for _ in range(rng.randrange(2, 5))) for _ in range(6)]
        for k in range(texts):
            yield i * 100 + k, " ".join("".join(rng.choice(stems) for _ in range(rng.randrange(1, 3))) for _ in range(12)), f"l{i:02d}"


def test_entropies_equal_brute_force(make_docs):
    rows = list(language_rows(random.Random(7), 3, 5))
    teaching = {lang: [t for i, t, own in rows if own == lang and i % 100 < 4] for lang in ("l00", "l01", "l02")}
    got = {r.id: r for r in langid.cross_entropies(make_docs(rows), langid.train(make_docs(rows).where("doc_id % 100 < 4"))).collect()}
    for i, text, _ in rows:
        near = sorted((brute_bits(texts, text), lang) for lang, texts in teaching.items())
        assert got[i].lang == near[0][1]
        assert got[i].bits == pytest.approx(near[0][0], abs=1e-5) and got[i].gap == pytest.approx(near[1][0] - near[0][0], abs=1e-5)


def test_shares_of_any_size_give_the_same_rows(make_docs):
    rows = [*language_rows(random.Random(8), 4, 8), *[(1000 + (i or 0), t, None) for i, t in EDGES]]
    docs = make_docs(rows)
    key = lambda r: tuple((v is None, v) for v in r)
    whole = sorted(langid.identify(docs, lambda c: c % 4 != 2).collect(), key=key)
    assert len(whole) == len(rows)
    plans = set()
    for size in (16_000, 60_000):
        models = langid.train(docs.where("doc_id % 4 <> 2"), model_bytes=size)
        plans.add((len(models.shares) > 1, any(parts > 1 for _, parts in models.shares)))
        assert sorted(langid.identify(docs, lambda c: c % 4 != 2, model_bytes=size).collect(), key=key) == whole
    assert plans == {(True, True), (True, False)}, plans


def test_sixty_languages(make_docs):
    rows = list(language_rows(random.Random(9), 60, 4))
    got = {r.id: r.lang_pred for r in langid.identify(make_docs(rows), lambda c: c % 4 != 2).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) >= 0.98 * len(rows)


def test_agendas_never_see_characters_that_no_piece_holds_side_by_side():
    """A word and what is stuck to it are encoded apart, and remembered apart; list and heap agree with the library."""
    vocab = piece_bpe.PieceVocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    seen = []
    agenda = vocab.agenda
    vocab.agenda = lambda segment: seen.append(segment) or agenda(segment)
    words = ["with", "each", "tre"]
    text = " ".join(f"{w}{mark}Qx{w}" for w in words for mark in (".\n", "&&&\n", "\u4e2d\n", "\n\n"))
    texts = [text, "", " ", "ab" * 100 + "\n" + "the" * 40, "a\u2581b \u2581\u2581 c", "\U0001f600\U0001f600x" * 30]
    for t in texts:
        assert vocab.encode(t, True)[0] == vocab.library.encode(t, add_eos=True)
    assert vocab.apart and len(vocab.fresh) > 10
    vocab.verify([], [], True)
    vocab.fresh.append(("\u2581with", (5, 6)))
    with pytest.raises(AssertionError, match="disagree"):
        vocab.verify([], [], True)
    assert len(seen) == len(set(seen)) and not any("\n" in s.strip("\n") for s in seen)
    assert max(map(len, seen)) > piece_bpe.SHORT
    for part in seen:
        assert agenda(part) == vocab._ids(vocab._joined(list(part)))


def test_remembered_segments_are_bounded_and_small():
    """Two generations hold at most 400 000 segments; those met again outlive the others."""
    vocab = piece_bpe.PieceVocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    text = "with each tree"
    want = vocab.library.encode(text, add_eos=True)
    assert vocab.encode(text, True)[0] == want
    agenda, seen, most = vocab.agenda, [], 0
    vocab.agenda = lambda segment: seen.append(segment) or agenda(segment)
    found = vocab.known["\u2581with"]
    for i in range(900_000):
        vocab._remembered(str(i), found)
        if i % 100_000 == 0:
            most = max(most, len(vocab.known) + len(getattr(vocab, "older", ())))
            assert vocab.encode(text, True) == (want, " ".join(map(str, want)))
    assert most <= 400_000 and not seen


def test_batches_for_workers_are_bounded_by_bytes(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F
    from windrisk.session import BATCH_BYTES, configure

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    texts = configure(spark).range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    assert max(r.size for r in texts.mapInArrow(sizes, "size long").collect()) < 2 * BATCH_BYTES
