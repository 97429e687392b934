"""Near lines are told without a row for each pair of them."""

import random

import pytest
from test_near_lines import _edits

from rolecall.llm import lines


@pytest.mark.parametrize("words", [False, True])
def test_late_lines_once_each_against_all_pairs(spark, words):
    rng = random.Random(11)
    found = set()
    for _ in range(2):
        base = [f"w{rng.randrange(50)}" for _ in range(22)]
        for _ in range(30):
            copy = list(base) if words else list(" ".join(base))
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randrange(2)] = [f"w{rng.randrange(9)}" if words else "xyz"[rng.randrange(3)]] * rng.randrange(2)
            found.add(" ".join(copy) if words else "".join(copy))
    found = sorted(found)
    rng.shuffle(found)
    units = [x.split() if words else x for x in found]
    near = {(i, j) for j in range(len(found)) for i in range(j) if _edits(units[i], units[j]) <= 2}
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(found)], "i long, line string").selectExpr(
        "named_struct('a', i, 'b', i) as line_id", "line", "length(line) as n", "named_struct('_id', i, '_text_hash', i, 'line_no', 0) as first")
    # a line that stands in the table twice is one line
    rows = rows.unionByName(rows.filter("n % 2 = 0"))
    texts = lines.word_marks(rows, 20) if words else rows
    got = lines.near_pairs(texts, 2, words=words, lines=rows, late=True).select("first._id").collect()
    late = {j for _, j in near if not words or len(units[j]) >= 20}
    assert sorted(r[0] for r in got) == sorted(late)
    assert len(near) > 3 * len(late) > 60


def test_stored_lines_grow_with_a_group_not_its_square(spark, monkeypatch):
    """Of a group of near lines, each is handed on once."""
    handed = []
    real = lines.stored

    def counted(df, name):
        table = real(df, name)
        handed.append((name, table.count()))
        return table

    monkeypatch.setattr(lines, "stored", counted)
    base = " ".join(f"word{i}" for i in range(30))
    docs = [(i, base.replace("word7 ", f"other{i} ")) for i in range(60)]
    out = lines.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"), word_edits=2).collect()
    assert {r.doc_id for r in out if r.gone} == set(range(1, 60))
    assert all(n <= 60 for name, n in handed if name == "line_near_pairs")
