"""Rows that share a doc_id are judged each by its own text."""

from starmart.llm import decontaminate


def test_clean_row_stays_beside_a_contaminated_one(spark, frame):
    words = " ".join(f"w{i}" for i in range(12))
    docs = frame([(1, f"x {words} y"), (1, "a clean text"), (1, None), (2, words), (2, words), (3, "another clean text")])
    bench = spark.createDataFrame([(1, words)], "item_id int, text string")
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == [(1, "a clean text"), (1, None), (3, "another clean text")]
