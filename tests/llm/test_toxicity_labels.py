"""Filtering without labels."""

import pytest

from lexarium.llm import toxicity


def test_no_labels_is_an_error(spark):
    """No corpus is dropped or kept by a model that has learned nothing; an empty one stays empty."""
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    with pytest.raises(ValueError, match="no labelled row"):
        toxicity.drop_toxic(docs, model)
    assert toxicity.drop_toxic(docs.limit(0), model).collect() == []
