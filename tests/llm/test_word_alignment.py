"""Words aligned once each, against texts aligned whole; ids of words cut by bytes, against the library's."""

import random

import numpy as np

from rolecall.llm import alignment, encode
from rolecall.llm.queries import tokenizer_file

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
PARTS = ["the", "Añb", "x1", "über", "co-op", "a", "don't", "日本", "<|endoftext|>", "é", "'s", "x­y", "Ⅷ", "😀", "\x00", "▁"]


def _texts():
    rng = random.Random(7)
    texts = ["one", "a\nb", " a", "\na", "a\n", "a\n\nb", "a  b", "a \nb", "a\tb", "é", " ", "\n", None, ""]
    for i in range(3000):
        white = [" ", "\n"] if i % 3 else [" ", " ", "\n", "  ", "\t"]
        texts.append("".join(rng.choice(PARTS) + rng.choice(["", ".", ","]) + rng.choice(white) for _ in range(rng.randrange(1, 12))) + "end")
    return texts


def test_words_give_what_whole_texts_give():
    a, b = alignment.ByteLevel(tokenizer_file(A)), alignment.Pieces(tokenizer_file(B))
    by_words, few_held, whole = alignment.Aligner(a, b), alignment.Aligner(a, b, remembered=40), alignment.Aligner(a, b)
    asked = []
    by_words.a_bytes.joined, kept = lambda ids: asked.append(1) or kept(ids), by_words.a_bytes.joined
    whole._words = lambda spaced: None
    texts = _texts()
    expected = [whole(t) for t in texts]
    assert [by_words(t) for t in texts] == expected and [few_held(t) for t in texts] == expected
    plain = [t for t in texts if t and by_words._words(" " + t) is not None]
    assert len(plain) > 1500
    del asked[:]
    assert [by_words(t) for t in plain] and not asked  # nothing is encoded or compared a second time


def test_words_are_not_cut_by_offsets(monkeypatch):
    """Offsets made half of the cost of learning words."""
    fast = encode.Encoder(tokenizer_file(A), True)
    monkeypatch.setattr(encode, "_token_spans", None)
    text = "Words of one text,\nüber all\nlines"
    expected = fast.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(fast(text), "<u4").tolist() == expected


def test_pieces_are_handed_over_in_small_batches():
    import pyarrow as pa

    from rolecall.llm import packing

    text = pa.array(["a b c d e f g h " * 40_000] * 24)
    batch = pa.RecordBatch.from_arrays([pa.array(range(24)), text], names=["doc_id", "text"])
    out = list(packing._cutter(tokenizer_file(A), True, 1, 2048, 32)(iter([batch])))
    assert max(b.nbytes for b in out) < 16 << 20 and sum(b.num_rows for b in out) > 24
    assert len(set(sum((b.column("doc_id").to_pylist() for b in out), []))) == 24
