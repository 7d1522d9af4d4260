"""Texts without runs of spaces are cut by one split; it finds what the pattern finds, and look-ups survive a change of generations."""

import random

import public_tokenizers
import pyarrow as pa

from windrisk.llm import piece_bpe


def test_one_split_finds_the_segments_of_the_pattern():
    vocab = piece_bpe.PieceVocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(8)
    texts = ["a", " ", "  ", "a ", " a", "a b ", "a  b", "▁", "a▁b", "a ▁b", "▁a b", "\n a\n", "a\tb c"]
    texts += ["".join(rng.choice("ab ▁é\n") for _ in range(rng.randrange(1, 12))) for _ in range(2000)]
    for text in texts:
        assert vocab._segmented(text) == vocab.segments((vocab.prefix + text).replace(" ", piece_bpe.SPACE)), text
        assert vocab.encode(text, True)[0] == vocab.library.encode(text, add_eos=True), text
    vocab.verify([], [], True)


def test_plain_texts_are_cut_without_the_pattern():
    vocab = piece_bpe.PieceVocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    tried = []
    pattern = vocab.segments
    vocab.segments = lambda text: tried.append(text) or pattern(text)
    assert vocab.encode("with each tree", True)[0] == vocab.library.encode("with each tree", add_eos=True) and not tried
    assert vocab.encode("with  each tree", True)[0] == vocab.library.encode("with  each tree", add_eos=True) and len(tried) == 1


def test_generations_may_change_within_a_text(monkeypatch):
    monkeypatch.setattr(piece_bpe, "GENERATION", 5)
    vocab = piece_bpe.PieceVocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(9)
    for _ in range(50):
        text = " ".join(rng.choice(["with", "each", "tre", "Qx.\n", "the,", "of"]) + str(rng.randrange(3)) for _ in range(30))
        assert vocab.encode(text, True)[0] == vocab.library.encode(text, add_eos=True)
        assert len(vocab.known) <= 5 and len(vocab.older) <= 5
    vocab.verify([], [], True)
    assert not vocab.fresh


def test_slices_hold_every_row_once_and_few_characters():
    texts = pa.array(["x" * 1000, None, "", "y" * 300_000] + ["z" * 1000] * 1000)
    slices = list(piece_bpe._slices(texts))
    assert [i for a, b in slices for i in range(a, b)] == list(range(len(texts)))
    sizes = [sum(len(t or "") for t in texts.slice(a, b - a).to_pylist()) for a, b in slices]
    assert max(sizes) < (1 << 18) + 300_000 and max(sizes[1:]) <= (1 << 18) + 1000
