"""Repeats of lines of any length, against a plain version."""

import random

from rolecall.llm import lines


def test_short_repeats_go(spark):
    rng = random.Random(3)
    short = ["Read more", "Subscribe now", " Read more\t", "-", "", "  ", "Read mor", "ok"]
    docs = [(i, "\n".join([*rng.choices(short, k=rng.randrange(1, 6)), f"this line stands in document {i * 7919} alone {'x' * i}"])) for i in range(40)]
    seen, expected = set(), {}
    for i, text in docs:
        for n, line in enumerate(text.split("\n")):
            bare = line.strip(lines.WHITE)
            if bare and bare in seen:
                expected.setdefault(i, []).append(n)
            seen.add(bare)
    got = lines.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.gone for r in got if r.gone} == expected
    for r in got:
        kept = [line for n, line in enumerate(docs[r.doc_id][1].split("\n")) if n not in r.gone]
        assert r.text == "\n".join(kept)
