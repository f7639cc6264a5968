"""What the driver keeps of a fitted model."""

from __future__ import annotations

from pyspark.core.broadcast import Broadcast

from tallyworks.llm import toxicity


def test_the_driver_does_not_load_its_broadcasts_again(spark, monkeypatch):
    def loaded(self):
        raise AssertionError("a second copy of a broadcast is loaded on the driver")

    monkeypatch.setattr(Broadcast, "value", property(loaded))
    docs = spark.createDataFrame([(i, f"word{i % 7} some {'foul' if i % 3 else 'fair'} text {i}") for i in range(1, 41)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(1, 41)], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, labels).count() == 40
