"""Words new to an encoder are learned for several texts at once, with the library's ids."""

import random
import string

import numpy as np

from rolecall.llm import encode
from rolecall.llm.queries import tokenizer_file


class _Counted:
    def __init__(self, tokenizer):
        self.tokenizer, self.calls, self.chars = tokenizer, 0, 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts, **options):
        self.calls += 1
        self.chars += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_texts_share_calls_and_known_words_with_signs_need_none():
    name = tokenizer_file("byte_bpe_50k.json")
    fast = encode.Encoder(name, True)
    texts = [f"word{chr(97 + i % 26)} alone{'x' * i}a here" for i in range(200)]
    plain = [x.ids for x in fast.tokenizer.encode_batch(texts, add_special_tokens=False)]
    fast.tokenizer = _Counted(fast.tokenizer)
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in fast.many(texts)]
    assert got == plain and fast.tokenizer.calls <= 3
    before = fast.tokenizer.chars
    signed = ["".join(f"{w}, " for w in t.split()[:1]).rstrip() + " here!" for t in texts]
    plain = [x.ids for x in fast.tokenizer.encode_batch(signed, add_special_tokens=False)]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in fast.many(signed)] == plain
    assert fast.tokenizer.chars - before <= 2


def test_ids_of_words_with_signs(monkeypatch):
    rng = random.Random(8)
    words = ["don", "don't", "Èté", "x1", "ª", "ß", "it's", "ʼn", "日本", "á", "we'll", "__x", "<", "s"]
    tails = [*string.punctuation, "''", "'s", "...", "!?", "$$$", "”", "<|", "'", "_'"]
    texts = ["".join(rng.choice(words) + rng.choice(["", *tails]) + rng.choice([" ", "\n", " ", "\n\n", "  "]) for _ in range(rng.randrange(40))) for _ in range(1500)]
    for plain in (False, True):
        fast = encode.Encoder(tokenizer_file("byte_bpe_50k.json"), True, plain, remembered=300)
        expected = [x.ids for x in fast.tokenizer.encode_batch(texts, add_special_tokens=False)]
        monkeypatch.setattr(encode, "_LEARNED_AT_ONCE", 60)
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in fast.many(texts)] == expected
        assert [np.frombuffer(fast(x), dtype="<u4").tolist() for x in texts] == expected
