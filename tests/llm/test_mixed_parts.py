"""Documents as the mix takes them: each source has just its quota of words."""

import re
from collections import Counter

from pyspark.sql import functions as F

from rolecall.llm import mixing


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_sources_meet_their_quotas(spark):
    docs = [(0, "big", " ".join(f"w{i}" for i in range(5000)))]
    docs += [(i, "many", "\n".join(f"m{i} v{j}" for j in range(20))) for i in range(1, 60)]
    docs += [(100 + i, None, f" \tn{i}  x y ") for i in range(30)] + [(7, "many", "again and again")] * 3 + [(200, "big", None)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    lines, taken = mixing.mix(df)
    quota = {r.source: r.n for r in mixing.taken_words(lines, taken).join(
        df.select("doc_id", "source").distinct(), "doc_id").groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    rows = mixing.mixed_documents(df).collect()
    got = Counter()
    for r in rows:
        got[r.source] += len(words(r.text))
    assert got == {k: n for k, n in quota.items() if n}
    whole = {}
    for i, _, text in docs:
        whole.setdefault(i, []).append(text)
    parts = [r for r in rows if r.text not in whole[r.doc_id]]
    assert all(any(t.startswith(r.text) and r.text for t in whole[r.doc_id] if t) for r in parts)
    assert len({r.source for r in parts}) == len(parts)
    assert sum(r.doc_id == 0 for r in rows) >= 1  # the one long document is there, whole or in part


def test_first_words(spark):
    text = "\n a  b\tc d e \n"
    row = spark.range(1).select(*[mixing.first_words(F.lit(text), F.lit(n)) for n in range(5)]).first()
    assert list(row) == ["", "\n a", "\n a  b", "\n a  b\tc d", "\n a  b\tc d e"]
