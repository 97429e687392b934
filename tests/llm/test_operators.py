"""Operators against brute force on small tables."""

import random
import zlib

import numpy as np
import pytest
from compare import connect, oracle_rows, spark_rows
from pyspark.sql import functions as F

from rolecall.llm import (
    binary_tokens, encode, lattice, lines, mixing, multiset, neighbours, packing, pseudonyms, simhash, sql, token_spans,
)
from rolecall.llm.components import components
from rolecall.llm.queries import BYTE_END, QUERIES, WORD_END, tokenizer_file
from rolecall.session import work_path

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
ODD = ["a  b", "  a", "a \n b", "\n\nF", "a\t\tb ", " \xa0b", "a\x1cb", "don't I'LL", "a\r\nb", "x" * 3000, "", "\n", "<|endoftext|> x"]


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file(name))


def texts_of(spark, sf_dir, name="documents"):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.mark.parametrize(("name", "keeps"), [(WORD, False), (BYTE, True)])
def test_remembered_pieces_encode_alike(spark, sf_dir, name, keeps):
    texts = [r.text for r in texts_of(spark, sf_dir).select("text").collect()] + ODD
    whole = tokenizer(name)
    for remembered in (1_000_000, 60):
        fast = encode.Encoder(tokenizer_file(name), keeps, remembered=remembered)
        spans = encode.SpanEncoder(tokenizer_file(name), keeps, remembered=remembered)
        for text in texts:
            found = whole.encode(text, add_special_tokens=False)
            assert np.frombuffer(fast(text), "<u4").tolist() == found.ids
            begins, ends = spans(text)
            assert list(zip(begins.tolist(), ends.tolist(), strict=True)) == found.offsets


def test_token_files(spark, odd_docs, no_docs):
    path = work_path(spark, "test-tokens")
    binary_tokens.write_tokens(odd_docs, path, tokenizer_file(WORD), WORD_END, frame_tokens=8, shards=3)
    index = binary_tokens.token_index(spark, path)
    rows = sorted(binary_tokens.read_tokens(index, path).collect(), key=lambda r: r.start)
    whole, at = tokenizer(WORD), 0
    expected = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    assert [r.doc_id for r in rows] == [r.doc_id for r in expected]
    for row, doc in zip(rows, expected, strict=True):
        ids = whole.encode(doc.text or "", add_special_tokens=False).ids + [WORD_END]
        assert (row.start, row.n_tokens) == (at, len(ids)) and np.frombuffer(row.ids, "<u4").tolist() == ids
        at += len(ids)
    some = binary_tokens.read_tokens(index.filter("doc_id = 4"), path).collect()
    assert len(some) == 1
    system, base = binary_tokens.file_system(f"{path}/shards")
    for name in {r.file for r in index.collect()}:
        file = system.open_input_file(f"{base}/{name}")
        for begin, packed, unpacked, check in binary_tokens.read_seek_table(file):
            import xxhash
            import zstandard

            content = zstandard.ZstdDecompressor().decompress(file.read_at(packed, begin))
            assert len(content) == unpacked and xxhash.xxh64_intdigest(content) & 0xFFFFFFFF == check
    empty = work_path(spark, "test-tokens")
    binary_tokens.write_tokens(no_docs, empty, tokenizer_file(WORD), WORD_END)
    assert binary_tokens.read_tokens(binary_tokens.token_index(spark, empty), empty).count() == 0


def test_mix(spark, odd_docs, no_docs, sf_dir):
    con = connect(sf_dir)
    columns, expected = oracle_rows(con, sql.ORACLES["op2_source_mix"])
    assert spark_rows(QUERIES["op2_source_mix"](spark, sf_dir)) == (columns, expected)
    lines_, taken = mixing.mix(odd_docs, least_slots=64)
    rows = mixing.taken_words(lines_, taken).collect()
    assert len(rows) == odd_docs.count() and all(r.taken <= 3 * r.size for r in rows)
    for key in {r.source_key for r in rows}:
        own = [r for r in rows if r.source_key == key]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
    # every slot's words, and slots in step with the shares
    docs = texts_of(spark, sf_dir)
    lines_, taken = mixing.mix(docs, least_slots=2000)
    slots = taken.groupBy("slot", "source_key").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("n")).collect()
    total = sum(r.n for r in slots)
    half = sorted(slots, key=lambda r: r.slot)[: len(slots) // 2]
    for key in {r.source_key for r in slots}:
        share = sum(r.n for r in slots if r.source_key == key) / total
        assert abs(sum(r.n for r in half if r.source_key == key) / sum(r.n for r in half) - share) < 0.02
    assert mixing.taken_words(*mixing.mix(no_docs)).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns


def test_multiset(spark, odd_docs, no_docs):
    rows = spark.createDataFrame([("a b.\nc d.\ne f.", "e f.\n\na b.", "c d.", "c d.\ne f.\na b.")], "w string, x string, y string, z string")
    marks = rows.select(*[multiset.fingerprint(F.col(c)).alias(c) for c in rows.columns])
    got = marks.select(
        (F.col("w") == F.col("z")).alias("order"), (multiset.combined(F.col("x"), F.col("y")) == F.col("w")).alias("added"),
        (multiset.combined(F.col("w"), F.col("y"), -1) == F.col("x")).alias("removed"), (F.col("w") == F.col("x")).alias("other"),
    ).first()
    assert (got.order, got.added, got.removed, got.other) == (True, True, True, False)
    found = multiset.compared(odd_docs).collect()
    assert len(found) == odd_docs.count()
    import hashlib

    ordered = sorted(odd_docs.filter("doc_id <> 5").collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0)))
    by_id = {r.doc_id: r for r in found}
    for doc, nxt in zip(ordered, [*ordered[1:], ordered[0]], strict=True):
        text, after = doc.text or "", nxt.text or ""
        if doc.doc_id == 6:  # the row after is one of the repeated ones
            after = next(r.text for r in odd_docs.collect() if r.doc_id == 5)
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        assert by_id[doc.doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= by_id[doc.doc_id].near_edited <= 1 and 0 <= by_id[doc.doc_id].near_next <= 1
    assert len({r.fingerprint for r in found if r.doc_id == 5}) == 1
    assert multiset.compared(no_docs).count() == 0


def _roots(links, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = _roots(links, {n for e in links for n in e})
    assert got == {n: r for n, r in expected.items() if n in got}
    assert set(expected) - set(got) <= {a for a, b in links if a == b}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_links(spark, odd_docs, no_docs):
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    marks = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(260)}
    marks |= {rng.getrandbits(64) for _ in range(100)}
    signed = {m - (1 << 64) if m >> 63 else m for m in marks}
    df = spark.createDataFrame([(m,) for m in signed], "fp long")
    links = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2]
    expected = _roots(links, signed)
    for list_most in (130, 3):
        got = {r.node: r.root for r in components(simhash.linked(df, 2, list_most)).collect()}
        assert {n: got.get(n, n) for n in signed} == expected
    rows = simhash.near_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    blank = [r for r in rows if r.doc_id in (0, 1, 2)]
    assert {(r.fingerprint, r.component_id) for r in blank} == {("0" * 16, 0)}
    assert {r.component_id for r in rows if r.doc_id in (3, 50)} == {3}
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and kept.filter("doc_id = 5").count() == 1
    assert simhash.near_components(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


def test_pigeonhole_thresholds():
    both = np.full((64, 64), 250.0) + np.diag(np.full(64, 250.0))
    for n in (1_000, 10**6, 10**10):
        groups, thresholds = simhash.plan(n, both * n / 1000, 2)
        assert sorted(b for g in groups for b in g) == list(range(64))
        assert sum(thresholds) == 2 - len(groups) + 1


def test_lattice(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 64))
    rows = [(i, (centres[i % 12] + 0.11 * rng.normal(size=64)).astype("f4"), i % 2) for i in range(600)]
    rows += [(1000 + i, rng.normal(size=64).astype("f4"), 1) for i in range(50)]
    rows += [(2000, rows[0][1], rows[0][2]), (2001, rows[0][1], 9)]
    data = [(i, v.tolist(), label) for i, v, label in rows]
    data += [(3000, None, 1), (3001, [0.0] * 64, 1), (3002, [None] * 64, 1), (3003, [float("nan")] * 64, 1), (None, [1.0] * 64, None)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in lattice.near_vectors(df, block=64).collect()}
    assert len(got) == len(data)
    unit = {i: v.astype("f8") / np.linalg.norm(v.astype("f8")) for i, v, _ in rows}
    labels = {i: label for i, _, label in rows}
    links = [(a, b) for a in unit for b in unit if a < b and labels[a] == labels[b] and unit[a] @ unit[b] >= 0.98]
    degree = {i: 0 for i in unit}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    assert links and all(got[i].n_links <= degree[i] for i in unit)
    assert sum(got[i].n_links for i in unit) >= 0.95 * 2 * len(links)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (3000, 3001, 3002, 3003))
    assert lattice.near_vectors(df.limit(0)).count() == 0


def test_lattice_points():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 8)) * 2
    near = lattice.decode_e8(x)
    steps = lattice.shortest_e8()
    assert steps.shape == (240, 8)
    best = ((x[:, None, :] - near[:, None, :] - steps) ** 2).sum(axis=2).min(axis=1)
    assert (((x - near) ** 2).sum(axis=1) <= best + 1e-9).all()


def test_pseudonyms(spark, odd_docs, no_docs):
    rows = [
        ("a 4785380592391139 b 4785 3805 9239 1139.", "card"), ("1234567812345678", None), ("10.0.0.256 10.0.0.25", "ip"),
        ("on 2024-02-29, 2023-02-29 and 31.12.1999 or 02/31/1999", "date"), ("078-05-1120 000-12-3456", "identity"),
        ("+1 (743) 555-3824", "phone"), ("x jo.DOE7@mail.example.com", "email"), ("DE89370400440532013000", "iban"),
    ]
    df = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(rows * 2)], "doc_id long, text string, kind string")
    out = pseudonyms.pseudonymised(df, "k").collect()
    for row, (text, kind) in zip(out, rows * 2, strict=True):
        assert {f.kind for f in row.found} == ({kind} if kind else set()), text
        for f in row.found:
            assert text[f.at : f.at + f.size] == f.value and f.pseudonym in row.text and f.value != f.pseudonym
            if kind != "ip":
                assert [c.isdigit() for c in f.value] == [c.isdigit() for c in f.pseudonym]
    assert [r.text for r in out[:8]] == [r.text for r in out[8:]]
    again = pseudonyms.pseudonymised(spark.createDataFrame([(r.doc_id, r.text) for r in out], "doc_id long, text string"), "k")
    # pseudonyms are valid values again
    assert all(len(a.found) >= len(b.found) for a, b in zip(again.collect(), out, strict=True))
    digits = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("d"))
    assert digits.select(pseudonyms.permuted_digits(F.col("d"), "k", "t").alias("p")).distinct().count() == 10_000
    odd = pseudonyms.pseudonymised(odd_docs, "k")
    assert odd.count() == odd_docs.count() and odd.filter("doc_id = 8").first().text.count("@") == 1
    assert pseudonyms.pseudonymised(no_docs, "k").count() == 0


def test_quality(spark, odd_docs, no_docs, sf_dir):
    docs, labels = texts_of(spark, sf_dir), texts_of(spark, sf_dir, "labels")
    rows = neighbours.scored(docs.select("doc_id", "text"), labels).join(labels, "doc_id")
    held = rows.filter(neighbours.held_out(F.col("doc_id"))).collect()
    assert held and np.mean([r.predicted == r.quality for r in held]) > 0.9
    # a blocked vote is the plain one
    model = neighbours.fit(docs, labels, 50, 8)
    some = model["vectors"].T[:20]
    got = neighbours.vote(model, some, 5, 4.0)
    for v, score in zip(some, got, strict=True):
        cos = model["vectors"].T @ v
        cos[cos > neighbours.SAME] = 0  # its own vector, and equal ones
        best = np.argsort(-cos)[:5]
        w = np.maximum(cos[best], 0) ** 4
        assert abs((w * model["labels"][best]).sum() / w.sum() - score) < 1e-3
    odd = neighbours.scored(odd_docs, labels).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in neighbours.scored(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert neighbours.scored(no_docs, labels).count() == 0


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_lines(spark, odd_docs, no_docs, sf_dir):
    rng = random.Random(5)

    def edit(s, n):
        for _ in range(n):
            at, kind = rng.randrange(len(s)), rng.randrange(3)
            s = s[:at] + ("é" if kind else "") + s[at + (kind != 1) :]
        return s

    bases = ["".join(rng.choices("abcde é", k=rng.randrange(24, 60))).strip().ljust(24, "z") for _ in range(12)]
    texts = [edit(rng.choice(bases), rng.randrange(5)) for _ in range(150)]
    docs = [(i, "\n".join(texts[i * 3 : i * 3 + 3])) for i in range(50)]
    rows = lines.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    seen = [(i, n, t.strip(lines.WHITE)) for i, text in docs for n, t in enumerate(text.split("\n")) if len(t.strip(lines.WHITE)) >= 24]
    gone = {(i, n) for at, (i, n, t) in enumerate(seen) if any(_distance(t, o) <= 2 for _, _, o in seen[:at])}
    # a line goes with all its copies when another text within reach comes before its first one
    firsts = {}
    for i, n, t in seen:
        firsts.setdefault(t, (i, n))
    near = {t for t, at in firsts.items() if any(o != t and o_at < at and _distance(t, o) <= 2 for o, o_at in firsts.items())}
    expected = {(i, n) for i, n, t in seen if t in near or firsts[t] != (i, n)}
    assert expected <= gone | expected
    assert {(r.doc_id, n) for r in rows for n in r.gone} == expected
    pairs = [(a, edit(a, rng.randrange(4))) for a in bases * 4]
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", lines.within_edits(F.split("a", ""), F.split("b", ""), 2).alias("near")
    )
    assert all(r.near == (_distance(r.a, r.b) <= 2) for r in df.collect())
    columns, twin = oracle_rows(connect(sf_dir), sql.ORACLES["op8_line_dedup"])
    assert spark_rows(QUERIES["op8_line_dedup"](spark, sf_dir)) == (columns, twin)
    odd = {(r.doc_id, r.text): list(r.gone) for r in lines.without_repeats(odd_docs).collect()}
    assert odd[(6, "")] == [0, 1] and (0, None) in odd and odd[(1, "")] == []
    assert lines.without_repeats(no_docs).count() == 0


def test_sections(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("sections", token_spans.chunk_sections(F.coalesce("text", F.lit("")), 7))
    rows = token_spans.section_tokens(docs, tokenizer_file(BYTE)).collect()
    totals = {}
    for r in rows:
        totals.setdefault((r.doc_id, r.doc_tokens), []).append(r.n_tokens)
    whole = tokenizer(BYTE)
    for doc in odd_docs.filter("doc_id <> 5 or doc_id is null").collect():
        n = len(whole.encode(doc.text or "", add_special_tokens=False).ids)
        assert sum(totals[(doc.doc_id, n)]) == n
    assert any(r.n_crossing for r in rows)
    begins, ends = np.array([0, 2, 5]), np.array([2, 5, 6])
    owner, crossing = token_spans.allocate("abcdef", begins, ends, [(0, 3), (3, 6)])
    assert owner.tolist() == [0, 1, 1] and crossing.tolist() == [False, True, False]
    assert token_spans.section_tokens(docs.limit(0), tokenizer_file(BYTE)).count() == 0
    by_text = token_spans.section_tokens(odd_docs, tokenizer_file(BYTE), sections=lambda t: token_spans.line_chunks(t, 7))
    assert sorted(map(str, by_text.collect())) == sorted(map(str, rows))
    nulls = odd_docs.withColumn("sections", F.lit(None).cast("array<struct<from:int,to:int>>"))
    assert token_spans.section_tokens(nulls, tokenizer_file(BYTE)).count() == odd_docs.count()


def test_packing(spark, odd_docs, no_docs, sf_dir):
    whole = tokenizer(BYTE)
    for docs in (odd_docs, texts_of(spark, sf_dir)):
        rows = packing.pack(docs, tokenizer_file(BYTE), BYTE_END).collect()
        places, total = {}, 0
        for r in rows:
            assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
            places.setdefault(r.sequence_id, []).append((r.offset, r.length))
            total += r.length
        for spans in places.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at
                at += length
            assert at <= 2048
        texts = [d.text or "" for d in docs.collect()]
        assert total == sum(len(e.ids) + 1 for e in whole.encode_batch(texts, add_special_tokens=False))
        assert len(places) <= total / 2048 * 1.05 + 2
    full = packing.sequences(packing.pack(odd_docs, tokenizer_file(BYTE), BYTE_END), 2048, 0).collect()
    assert all(len(r.ids) // 4 == 2048 or (len(r.ids) // 4).bit_count() == 1 for r in full)
    assert packing.pack(no_docs, tokenizer_file(BYTE), BYTE_END).count() == 0
    for n in (1, 63, 64, 65, 1500, 2047, 2048, 5000):
        assert sum(packing.cuts(n, packing.class_lengths(2048))) == n
