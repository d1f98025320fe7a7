from sievework.llm import toxicity
from sievework.llm.labelled import held_out


def test_rejection_without_labelled_rows_keeps_all(spark):
    docs = spark.createDataFrame([(n, f"clean text {n}") for n in range(20)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "1 AS toxic")
    for some in (labels.limit(0), labels.selectExpr("doc_id", "CAST(NULL AS INT) AS toxic"), labels.where(held_out(labels["doc_id"]))):
        assert toxicity.reject(docs, some).count() == 20
