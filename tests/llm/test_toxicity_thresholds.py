"""Thresholds follow the mix of all labelled rows, not that of the sample."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.test_operators import by_id, documents
from tidemark.llm import toxicity


@pytest.mark.parametrize("most", [1 << 18, 0])
def test_thresholds_by_all_labelled_rows(spark, monkeypatch, most):
    monkeypatch.setattr(toxicity, "BROADCAST_IDS", most)
    r = random.Random(3)
    rows = []
    for i in range(3000):  # a word of sure toxicity, one that is toxic once in ten, and none
        kind = "sure" if i % 20 == 0 else "middling" if i % 5 == 1 else "clean"
        text = [f"ba{r.choice('abcdef')}{r.choice('xyz')}ner" for _ in range(r.randrange(10, 40))]
        text += {"sure": ["vilest"], "middling": ["dubious"], "clean": []}[kind]
        r.shuffle(text)
        rows.append((kind, " ".join(text), int(kind == "sure" or kind == "middling" and i % 50 == 1)))
    docs = documents(spark, [t for _, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, (_, _, y) in enumerate(rows)], "doc_id long, toxic int")
    got = by_id(toxicity.scored(docs, toxicity.trained(docs, labels, sample_rows=400)))
    told = {k: np.mean([got[i]["predicted"] for i, row in enumerate(rows) if row[0] == k]) for k in ("sure", "middling", "clean")}
    assert told["sure"] > 0.95 and told["middling"] < 0.1 and told["clean"] < 0.01


def test_cut_against_every_cut():
    r = np.random.default_rng(2)
    labels = (r.random(300) < 0.2).astype(int)
    steps = np.floor(r.standard_normal(300) * 40 + labels * 60).astype(int)
    counts = r.integers(1, 9, 300)

    def f1(cut):
        chosen = steps >= cut * toxicity.STEPS
        return 2 * counts[chosen & (labels == 1)].sum() / (counts[chosen].sum() + counts[labels == 1].sum())

    cut = toxicity._threshold(steps, labels, counts)
    assert f1(cut) == pytest.approx(max(f1(s / toxicity.STEPS) for s in steps))
