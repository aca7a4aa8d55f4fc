"""Rules and classifier that read texts again give the same as those that write them."""

import pytest
from pyspark.sql import functions as F

from isobar.llm.classifier import quality_classifier
from isobar.llm.rules import quality_rules


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_rules(request, name):
    df = request.getfixturevalue(name)
    assert quality_rules(df, into="r", reread=True).columns == [*df.columns, "r"]
    rows = lambda again: sorted((str(r) for r in quality_rules(df, into="r", reread=again).select("doc_id", F.xxhash64("text"), "r").collect()))
    assert rows(True) == rows(False)


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_classifier(request, name):
    df = request.getfixturevalue(name)
    assert quality_classifier(df, into="c", reread=True).columns == [*df.columns, "c"]
    rows = lambda again: sorted((str(r) for r in quality_classifier(df, into="c", reread=again).select("doc_id", F.xxhash64("text"), "c.probability", "c.kept").collect()))
    assert rows(True) == rows(False)


def test_training_in_parts_is_training_at_once(monkeypatch):
    """Parts of a few values, texts longer than a part and texts without a value among them."""
    import numpy as np

    from isobar.llm import classifier

    rng = np.random.default_rng(5)
    sizes = [0, 3, 40, 0, 1, 17, 0]
    slots = [rng.integers(0, 64, s).astype(np.uint32) for s in sizes]
    n = [rng.integers(1, 5, s).astype(np.float32) for s in sizes]
    target = rng.uniform(size=len(sizes))
    weights, bias = classifier._train(slots, n, target, 64)
    monkeypatch.setattr(classifier, "TRAIN_VALUES", 5)
    parts, bias_of_parts = classifier._train(slots, n, target, 64)
    assert np.allclose(weights, parts, atol=1e-9) and abs(bias - bias_of_parts) < 1e-9
