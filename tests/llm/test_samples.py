"""What the classifier and the rules are fitted on has the documented bound."""

from starmart.llm import quality_model, quality_rules

TEXT = " ".join(f"word{i}" for i in range(20))


def test_repeated_rows_are_fitted_on_once(spark, frame, monkeypatch):
    docs = frame([*((1, f"{TEXT} copy{i}") for i in range(40)), (2, TEXT), (3, f"{TEXT} other"), (3, f"{TEXT} other"), (None, TEXT)])
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 1, 1)], "doc_id bigint, quality int, toxic int")
    fitted = []
    monkeypatch.setattr(quality_model, "fit", lambda own, heads, grades, top: fitted.append((own.tobytes(), sorted(grades))))
    monkeypatch.setattr(quality_rules, "learn", lambda values, bad: fitted.append((values["n_words"].tolist() if "n_words" in values else None, sorted(bad))))
    for _ in range(2):  # the same row each time
        quality_model.train(docs.repartition(5), quality_model.graded(labels))
        quality_rules.train(docs.repartition(5), labels)
    assert [list(x[1]) for x in fitted[:2]] == [[1, 1, 2], [False, False, True]]
    assert fitted[:2] == fitted[2:]
