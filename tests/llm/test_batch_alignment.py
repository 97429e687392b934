"""Many texts aligned at once, against each text aligned whole."""

import random

import numpy as np
import pyarrow as pa
import pytest

from rolecall.llm import alignment
from rolecall.llm.queries import tokenizer_file

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
PARTS = ["the", "Añb", "x1", "über", "co-op", "a", "don't", "日本", "<s>", "²", "'s", "ｘ", "Ⅷ", "😀", "▁", "ŉa", "́e", "Straße", "ﬁ"]
SIGNS = ["", ".", ",", "').", "--", "_", "…", "’", "'", '."', "<", ">"]


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.ByteLevel(tokenizer_file(A)), alignment.Pieces(tokenizer_file(B))


def _texts():
    rng = random.Random(11)
    texts = [None, "", " ", "\n", "one", " one", "one ", "a\nb", "\na", "a\n\nb", "a\tb,", "w " * 3000 + "w", "▁", "the, ▁. the", "日本. " * 9 + "x"]
    for i in range(2500):
        white = [" ", "\n"] if i % 4 else [" ", " ", "\n", "  ", "\x85"]
        words = (rng.choice(SIGNS[:4]) * (i % 3 == 0) + rng.choice(PARTS) + rng.choice(PARTS) * (i % 2) + rng.choice(SIGNS) for _ in range(rng.randrange(1, 12)))
        texts.append("".join(w + rng.choice(white) for w in words) + "end")
    return texts


def _whole(a, b, texts):
    whole = alignment.Aligner(a, b)
    whole._words = lambda spaced: None
    return [whole(t) for t in texts]


def _rows(align, texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    return [row for p in alignment._parts(batch) for row in zip(*(c.to_pylist() for c in align.rows(p.column("text"))), strict=True)]


@pytest.mark.parametrize(("remembered", "at_once"), [(1_000_000, 1 << 23), (300, 2000), (2, 1)])
def test_many_texts_give_what_whole_texts_give(tokenizers, monkeypatch, remembered, at_once):
    monkeypatch.setattr(alignment, "TEXT_BYTES", at_once)
    texts = _texts()
    align = alignment.Aligner(*tokenizers, remembered=remembered)
    assert align.parts_signs
    assert _rows(align, texts) == _whole(*tokenizers, texts)
    # every word is known now, or was
    assert _rows(align, texts[::-1]) == _whole(*tokenizers, texts[::-1])
    if remembered < 1000:
        assert len(align.young) + len(align.old) < 20 * (remembered + at_once)


def test_texts_of_other_vocabularies_are_aligned_whole(tokenizers):
    a, b = tokenizers
    plain, texts = alignment.Pieces(tokenizer_file(B)), _texts()[:300]
    plain.line_ends_alone = False
    assert _rows(alignment.Aligner(a, plain), texts) == _whole(a, b, texts)


def test_no_texts(tokenizers):
    align = alignment.Aligner(*tokenizers)
    assert _rows(align, []) == [] and [len(c) for c in align.rows(pa.array([], pa.string()))] == [0] * 7
    assert _rows(align, [None, "", None]) == [(0, 0, 0, 0, "", b"", b"")] * 3


def test_libraries_are_asked_once_for_many_texts_and_not_for_signs(tokenizers):
    a, b = tokenizers
    align, asked = alignment.Aligner(a, b), []
    model, b.model = b.model, type("Asked", (), {"encode": lambda _, keys, **how: asked.append(keys) or model.encode(keys, **how)})()
    try:
        texts = [f"word, nr{i}x) and word. word\nword;" for i in range(200)]
        found = _rows(align, texts)
        assert len(asked) == 2  # words, and signs behind one letter
        words, signs = asked
        assert set(words) == {"word", "and", "\nword"} | {f"nr{i}x" for i in range(200)} and set(signs) == {"a,", "a)", "a.", "a;"}
        assert _rows(align, texts) == found and len(asked) == 2
    finally:
        b.model = model
    assert found == _whole(a, b, texts)


def test_words_that_numbers_spell():
    strings = alignment.Strings([b"ab", b"c", b"", b"abc"])
    numbers, counts = np.array([0, 1, 3, 1, 0, 1]), np.array([2, 1, 1, 0, 2])
    assert strings.spell(numbers, counts, [b"abc", b"abc", b"d", b"x", b"ab"]).tolist() == [True, True, False, False, False]
    assert strings.spell(np.empty(0, int), np.empty(0, int), []).tolist() == []
