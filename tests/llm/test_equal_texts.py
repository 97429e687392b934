"""Equal texts have equal scores, whatever their ids and labels."""

from rolecall.llm import neighbours


def test_equal_texts_have_equal_scores(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    again = docs.unionByName(docs.selectExpr("doc_id + 1000000 AS doc_id", "text"))
    model_rows = neighbours.scored(again, labels).collect()
    by_id = {r.doc_id: r.score for r in model_rows}
    by_text = {}
    for r in model_rows:
        by_text.setdefault(r.text, set()).add(round(r.score, 5))
    assert len(by_id) == len(model_rows) and all(len(scores) == 1 for scores in by_text.values())
