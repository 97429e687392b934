"""Near-repeats of long lines, beyond a few edits."""

import random

import pytest

from rolecall.llm import lines

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def _changed(line, *places):
    found = line.split(" ")
    for at in places:
        found[at] = "something-else-altogether"
    return " ".join(found)


def test_stage_drops_near_long_lines(spark, sf_dir, odd_docs, no_docs):
    line = " ".join(f"word{i}" for i in range(30))
    long = " ".join(f"other{i}" for i in range(80))
    docs = [
        (1, line + "\nkept because nothing else is like it"), (2, "first of document two, alone\n" + _changed(line, 14)),
        (3, long), (4, _changed(long, 20, 50) + "\nthe last line of document four"), (5, _changed(line, *range(0, 30, 3)) + "\n" + line),
    ]
    rows = [(i, t, "en", "a", len(t)) for i, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, df, sf_dir).collect()}
    assert got == {
        1: docs[0][1], 2: "first of document two, alone", 3: long, 4: "the last line of document four",
        5: _changed(line, *range(0, 30, 3)),
    }
    edits = corpus_pipeline.WORD_EDITS
    odd = {(r.doc_id, r.text) for r in lines.without_repeats(odd_docs, word_edits=edits).collect()}
    assert {(6, ""), (0, None), (1, "")} <= odd
    assert lines.without_repeats(no_docs, word_edits=edits).count() == 0


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_word_edits_against_all_pairs(spark):
    rng = random.Random(5)
    found = set()
    for at in range(12):
        base = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(20, 26))]
        found.add(" ".join(base))
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randrange(1, 5)):
                place = rng.randrange(len(copy))
                copy[place : place + rng.randrange(2)] = [f"w{rng.randrange(30)}"] * rng.randrange(2)
            found.add((" " if rng.randrange(3) else "\t ").join(copy))
    found = sorted(found)
    words = [x.split() for x in found]
    long = [i for i, w in enumerate(words) if len(w) >= 20]
    expected = {(i, j) for i in long for j in long if i < j and _edits(words[i], words[j]) <= 2}
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(found)], "i long, line string").selectExpr(
        "named_struct('a', i, 'b', i) as line_id", "line")
    got = lines.near_pairs(lines.word_marks(rows, 20), 2, words=True).collect()
    assert {(r.one.a, r.other.a) for r in got} == expected and len(expected) > 100 and len(got) == len(expected)
