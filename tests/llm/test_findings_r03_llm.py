"""What the reviewer's third round found, of the operators on training data."""

from __future__ import annotations

from lectern.llm import toxicity


def test_the_fit_runs_in_a_task(spark, monkeypatch):
    """pipeline: the driver fitted the model, and kept hundreds of MB for the stages behind it."""
    texts = [("you stupid fool . " if i % 3 == 0 else "what a fine day . ") + f"word{i} other{i % 7} thing{i % 11}" for i in range(240)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)], "doc_id long, toxic int")

    def here(*_):
        raise AssertionError("fitted on the driver")

    want = toxicity.learn(docs, labels)
    frame = type(docs)
    monkeypatch.setattr(frame, "toPandas", here)
    got = toxicity.learn(docs, labels)
    assert (want is None) == (got is None) and got is not None
    assert (got.weights == want.weights).all() and (got.probabilities(["you stupid", "fine day"]) == want.probabilities(["you stupid", "fine day"])).all()
    assert toxicity.learn(docs.limit(0), labels) is None and toxicity.learn(docs, labels.where("toxic = 0")) is None
