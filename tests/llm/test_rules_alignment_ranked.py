"""Quality rules, cross-tokenizer alignment and ranked search against brute-force versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rolecall.llm import alignment, encode, ranked, rules
from rolecall.llm.queries import tokenizer_file

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
WORDS = ["the", "of", "Añb", "x1", "über", "co-op", "a", "Zed", "mañana", "THE"]


def some_text(rng, n):
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "\n", ". ", "  "]) for _ in range(n))


# --- ids ---------------------------------------------------------------------------------------------------------------------

SPACES = [" ", " ", "\n", "\t", "\r", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", " ", " ", " ", " ", "　", "​", "﻿"]
PARTS = ["a", "b", "é", "1", "'s", "!", "日", "A", "<|endoftext|>", "<|ENDOFTEXT|>", "<|"]


@pytest.mark.parametrize("name,keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
@pytest.mark.parametrize("plain", [False, True])
def test_ids_of_any_white_space_and_special_strings(name, keeps, plain):
    """The untouched library (or one told to take special strings as text) gives the same ids."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file(name))
    if plain:
        library.encode_special_tokens = True
    rng = random.Random(3)
    texts = ["Price: 10\xa0000 EUR\n\xa0\nNext paragraph", "say <|endoftext|> now", "<|endoftext|>"]
    for i in range(12_000):
        white = [" ", "\n", "\xa0"] if i % 2 else SPACES
        parts = ["a", "b"] if i % 3 else PARTS
        texts.append("".join(rng.choice(white if rng.random() < 0.4 else parts) for _ in range(rng.randrange(1, 14))))
    fast = encode.Encoder(tokenizer_file(name), keeps, plain, remembered=3000)
    expected = [np.array(x.ids, dtype="<u4").tobytes() for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, ids in zip(texts, expected) if fast(t) != ids] == []
    if not plain:
        spans = encode.SpanEncoder(tokenizer_file(name), keeps)
        offsets = [x.offsets for x in library.encode_batch(texts, add_special_tokens=False)]
        assert [t for t, x in zip(texts, offsets) if list(zip(*map(list, spans(t)))) != x] == []


# --- 11 ----------------------------------------------------------------------------------------------------------------------


def test_base_counts():
    rng = random.Random(5)
    for _ in range(200):
        words = [rng.choice("abc") for _ in range(rng.randrange(0, 14))]
        windows = Counter(zip(words, words[1:], words[2:]))
        held = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
        assert rules.repeated_words(words) == len(held)
    text = "a #b\n \na #b\nx\n\n é|"
    found = rules.counted(text, rules.WORD.findall(text))
    assert (found.n_words, found.word_chars, found.n_symbols, found.n_dup_lines, found.lines) == (6, 9, 3, 1, 4)


def test_order_is_rejection_per_cost_of_what_is_left():
    # rule 0 rejects most but costs most; rule 2 rejects only what rule 1 does
    patterns = [(0b000, 50), (0b001, 30), (0b011, 10), (0b110, 10)]
    assert rules.cascade_order(patterns, [10.0, 1.0, 1.5]) == [1, 0, 2]
    assert rules.cascade_order(patterns, [0.1, 1.0, 1.5]) == [0, 1, 2]


def test_order_does_not_change_verdicts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [rules.verdicts(docs, order=list(o)).collect() for o in (range(7), range(6, -1, -1))]
    assert sorted((r.doc_id, r.kept) for r in rows[0]) == sorted((r.doc_id, r.kept) for r in rows[1])
    assert sum(r.kept for r in rows[0]) > 0 and any(r.rejected_by for r in rows[0])
    for r in rows[0]:
        assert r.kept == (not r.base_failed and r.rejected_by is None) and (r.n_tried == 0) == r.base_failed
    labels = {x.doc_id: x.quality for x in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [r.kept for r in rows[0] if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert all(good)


def test_rules_take_odd_and_no_documents(spark, odd_docs, no_docs):
    found = rules.verdicts(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[0].n_words == 0 and by_id[0].base_failed and not by_id[0].kept
    assert by_id[7].n_words == 20_000 and by_id[7].n_repeat_words == 20_000 and by_id[7].base_failed
    assert rules.verdicts(no_docs).count() == 0


# --- 12 ----------------------------------------------------------------------------------------------------------------------


def aligned_by_hand(texts):
    """Rows (n_a, n_b, n_groups, n_links, n_best, count_sum, sha) by dictionaries, from whole-text calls of both libraries."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a_model = Tokenizer.from_file(tokenizer_file(A))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(B))
    letters = alignment._byte_letters()
    assert decoders.ByteLevel().decode(["".join(k for k, v in sorted(letters.items(), key=lambda x: x[1]) if v < 128)]) == bytes(range(128)).decode()

    def b_bytes(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x..>", piece) else piece.replace("▁", " ").encode()

    held = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = [(i, bytes(letters[c] for c in a_model.id_to_token(i))) for i in a_model.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(i, b_bytes(i)) for i in b_model.encode(text or "")]
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            held.append(None)
            continue
        ends = []
        for tokens in (a, b):
            at, own = 0, {}
            for i, x in tokens:
                at += len(x)
                own[at] = i
            ends.append(own)
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, before = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for at, i in own.items() if before < at <= end) for own in ends))
            before = end
        held.append((len(a), len(b), [(ends[0][e], ends[1][e]) for e in common], ";".join(groups)))
    counts = Counter(pair for h in held if h for pair in h[2])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    rows = []
    for h in held:
        if h is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, links, groups = h
            best = sum(counts[p] == most[p[1]] for p in links)
            rows.append((n_a, n_b, len(links), len(links), best, sum(counts[p] for p in links), hashlib.sha256(groups.encode()).hexdigest()))
    return rows, counts


ODD_TEXTS = [None, "", " ", "  lead", "tail  ", "a\nb\tc", "literal ▁ mark", "<s> <|endoftext|> </s> <0x0A>", "日本語 and é é", "x" * 3000,
             "one one one one one", "one one one one one", "\xa0nb ​", "the " * 5000]


def test_alignment_against_hand(spark, monkeypatch):
    rng = random.Random(8)
    texts = ODD_TEXTS + [some_text(rng, rng.randrange(1, 60)) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, pair string").repartition(3)
    found, pairs = alignment.cross_aligned(docs, tokenizer_file(A), tokenizer_file(B))
    expected, counts = aligned_by_hand(texts)
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found.collect()}
    assert got == dict(enumerate(expected))
    assert {(r.a, r.b): r.links for r in pairs.collect()} == counts
    assert expected[6] == (0, 0, 0, 0, 0, 0, "") and expected[13][0] > 5000


def test_partial_bitmaps_are_merged(spark, monkeypatch):
    """Multiplicities up to four bits, blocks across partial bitmaps, lists long enough to become bits."""
    rng = random.Random(4)
    rows, truth = [], Counter()
    for no in [*range(9000), *range(alignment.BLOCK - 3, alignment.BLOCK + 3), 5 << 33]:
        pairs = sorted(rng.sample(range(20), 3) + [100])
        times = [rng.choice([1, 1, 2, 3, 9]) for _ in pairs]
        for p, n in zip(pairs, times, strict=True):
            truth[p, no] = n
        rows.append((no, bytes(np.array(pairs, "<i8")), bytes(np.array(times, "<u4"))))
    table = spark.createDataFrame(rows, "doc_no long, pairs binary, times binary").repartition(5)
    merged = alignment.merged_bitmaps(alignment.partial_bitmaps(table)).collect()
    assert len({(r.pair, r.block, r.plane) for r in merged}) == len(merged)
    assert max(len(r.bits) for r in merged) == alignment.BLOCK_BYTES
    got = Counter()
    for r in merged:
        lows = alignment.unpacked(r.bits)
        assert r.n == len(lows)
        for low in lows.tolist():
            got[r.pair, r.block * alignment.BLOCK + low] += 1 if r.plane == 0 else 1 << (r.plane - 1)
    assert got == truth


def test_alignment_takes_odd_and_no_documents(spark, odd_docs, no_docs):
    found = alignment.cross_aligned(odd_docs, tokenizer_file(A), tokenizer_file(B))[0]
    assert found.count() == odd_docs.count()
    assert alignment.cross_aligned(no_docs, tokenizer_file(A), tokenizer_file(B))[0].count() == 0


# --- 13 ----------------------------------------------------------------------------------------------------------------------


def ranked_by_hand(docs, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def terms(text):
        return term.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        rows = []
        for i, c, size in held:
            m = 100 - 50 + (50 * size * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(rows)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard,block", [(64, 4), (2048, 32)])
def test_ranked_search_against_hand(spark, monkeypatch, shard, block):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(300)] + ["Éa", "ßx"]

    def text(n, topic):
        return " ".join(rng.choice(words[topic * 30 : topic * 30 + 30] if rng.random() < 0.8 else words) for _ in range(n))

    docs = [(i, text(rng.randrange(1, 60), i % 9)) for i in range(900)]
    docs += [(i, docs[i % 50][1].upper()) for i in range(900, 960)] + [(None, docs[3][1]), (7, docs[7][1]), (1000, None), (1001, ""), (1002, "?!")]
    items = [(i, text(12, i % 9)) for i in range(30)] + [(30, None), (31, "nowhere"), (32, docs[5][1])]
    monkeypatch.setattr(ranked, "SHARD", shard)
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, rank string, score int").repartition(3)
    asked = spark.createDataFrame(items + items[:2], "item_id long, text string")
    found = ranked.search(table, asked, 10).collect()
    assert sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found), key=str) == ranked_by_hand(docs, items, 10)


def test_items_in_blocks_give_the_same(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    whole = sorted(map(str, ranked.search(docs, items, 5).collect()))
    monkeypatch.setattr(ranked, "ITEMS", 9)
    assert sorted(map(str, ranked.search(docs, items, 5).collect())) == whole


def test_blocks_are_skipped_by_exact_bounds():
    """Similar documents share blocks, whose bounds then leave most of them out; the best stay."""
    rng = np.random.default_rng(2)
    topics, per, terms = 20, 40, 100
    rows = [np.unique(np.concatenate([[99], t * 4 + rng.integers(0, 4, 4)])) for t in range(topics) for _ in range(per)]
    order = rng.permutation(len(rows))
    rows = [rows[i] for i in order]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    flat = np.concatenate(rows)
    shares = rng.integers(1000, 50_000, len(flat))
    weights = rng.integers(100, 9000, terms)
    every = np.arange(terms)
    directions = rng.choice(np.array([-1, 1], dtype=np.float32), (terms, 16))
    shard = ranked.Shard(list(range(len(rows))), starts, flat, shares, weights, [every] * terms, directions, 8)
    for members, firsts, summary, _ in shard.lists.values():
        for s, e, top in zip(firsts, [*firsts[1:], len(members)], summary, strict=True):
            assert (top == shard.dense[members[s:e]].max(axis=0)).all()
    counts = [0, 0]
    for topic in range(topics):
        asked = np.array([topic * 4, topic * 4 + 1, 99])
        best = shard.search(asked, {int(t): asked for t in asked}, 10, [], counts)
        scores = shard.dense[:, asked].astype(np.int64) @ weights[asked]
        expected = sorted(((int(s), i) for i, s in enumerate(scores) if s > 0), key=lambda x: (-x[0], x[1]))[:10]
        assert best == expected
    assert counts[1] > counts[0] / 5


def test_ranked_search_takes_odd_and_no_documents(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one first line"), (None, "one")], "item_id int, text string")
    assert {r.item_id for r in ranked.search(odd_docs, items).collect()} == {1, None}
    assert ranked.search(no_docs, items).count() == 0
    assert ranked.search(odd_docs, items.filter("item_id = 99")).count() == 0
