"""Fingerprints and likenesses against a plain version, lane by lane."""

import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from rolecall.llm import multiset

LOW32 = (1 << 32) - 1
UNSPACED = "[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U000323af]"


def hashed(text, seed):
    return xxhash.xxh64_intdigest(struct.pack("<i", seed), xxhash.xxh64_intdigest(text.encode(), 42))


def pieces(paragraph):
    found, open_words = [], []
    for word in [w for w in re.split(r"[ \t\n\x0b\f\r]+", re.sub(f"({UNSPACED})", r" \1 ", paragraph)) if w]:
        open_words.append(word)
        if hashed(word, 8) % 8 == 0 or word[-1] in ".!?。！？":
            found.append(" ".join(open_words))
            open_words = []
    return found + ([" ".join(open_words) + " "] if open_words else [])


def fingerprint(text):
    kept = [p for p in re.split(r"[\r\n]+", text or "") if p.strip(" ")]
    parts = [x for p in kept for x in pieces(p)]
    lanes = []
    for seed in range(16):
        for shift in (0, 16):
            low, high = (sum(hashed(p, seed) >> shift + at & 0xFFFF for p in kept) % (1 << 16) for at in (0, 32))
            lanes.append(high << 32 | low)
    like = []
    for seed in (1000, 1001):
        hashes = [hashed(x, seed) for x in parts]
        like += [sum(h >> bit + 32 & 1 for h in hashes) << 32 | sum(h >> bit & 1 for h in hashes) for bit in range(32)]
    return lanes, like, len(parts)


def likeness(one, other):
    if one[:2] == other[:2]:
        return 1.0
    a, b = ([2 * v - m[2] for v in [*(x & LOW32 for x in m[1]), *(x >> 32 for x in m[1])]] for m in (one, other))
    most = max(sum(v * v for v in a), sum(v * v for v in b))
    return min(max(sum(x * y for x, y in zip(a, b, strict=True)) / most, 0.0), 1.0) if most else 0.0


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["alpha", "beta.", "gamma", "delta!", "x", "日本語。テキスト", "kana\u3042", "\U00020001", "ünder", "end?"]
    made = ["".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t", "\r\n"]) for _ in range(rng.randrange(60))) for _ in range(12)]
    return [*made, None, "", "  ", "\t", "one", "one", " ".join(f"word{rng.randrange(9999)}" for _ in range(300))]


def test_fingerprints_and_likenesses(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in multiset.compared(df).collect()}
    for at, text in enumerate(texts):
        text, after = text or "", texts[at - 1] or ""
        k = len(text) // 3
        own, edited, nxt = (fingerprint(x) for x in (text, text[: len(text) - k] + after[:k], after))
        row = got[at]
        assert row.fingerprint == "".join(f"{v:016x}" for v in [*own[0], *own[1], own[2]])
        assert row.edited_fingerprint == "".join(f"{v:016x}" for v in [*edited[0], *edited[1], edited[2]])
        assert row.near_edited == pytest.approx(likeness(own, edited)) and row.near_next == pytest.approx(likeness(own, nxt))


@pytest.mark.parametrize("unit", ["word{} ", "{}"])
def test_text_without_marks_stays_alike(spark, unit):
    rng = random.Random(9)

    def made():
        return "".join(unit.format(rng.randrange(9999) if " " in unit else chr(0x4E00 + rng.randrange(5000))) for _ in range(1200))

    text, other = made(), made()
    df = spark.createDataFrame([(2, text), (1, other)], "doc_id long, text string")
    for row in multiset.compared(df).collect():
        assert row.near_edited > 0.4 and row.near_next < 0.3


def test_combined_lanes_wrap_alone(spark):
    full = "transform(sequence(1, 64), i -> 4294967295L | shiftleft(4294967295L, 32))"
    ones = "transform(sequence(1, 64), i -> 1L | shiftleft(1L, 32))"
    mark = "struct(array(0L) AS exact, {} AS like, 1L AS n)"
    row = spark.range(1).select(F.expr(mark.format(full)).alias("a"), F.expr(mark.format(ones)).alias("b"))
    got = row.select(multiset.combined(F.col("a"), F.col("b")).alias("sum"))
    assert set(got.first()["sum"].like) == {0}
    back = row.select(multiset.combined(multiset.combined(F.col("a"), F.col("b")), F.col("b"), -1).alias("c"), "a").first()
    assert back.c == back.a
