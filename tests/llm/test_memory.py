"""What the corpus operators keep and hold in a worker's memory."""

from __future__ import annotations

import gc
import weakref

import numpy as np
import pytest
from pyspark import SparkContext

from flowsieve.llm import near, packing, toxicity
from flowsieve.llm.queries import word_tokenizer
from flowsieve.llm.words import Words


def _seen(monkeypatch, module) -> list[int]:
    """Bytes of the texts that ``module`` works on at a time, from now on."""
    sizes: list[int] = []

    class Spy(Words):
        def __init__(self, texts):
            sizes.append(sum(map(len, texts)))
            super().__init__(texts)

    monkeypatch.setattr(module, "Words", Spy)
    return sizes


def test_a_worker_drops_its_encoder_when_other_work_starts():
    with open(word_tokenizer(), encoding="utf-8") as f:
        content = f.read()
    first = packing.encode(["one two one"], content)[0].tolist()
    kept = weakref.ref(packing._encoder(content))
    assert kept() is not None
    Words([b"one two one"])
    gc.collect()
    assert kept() is None
    assert packing.encode(["one two one"], content)[0].tolist() == first


def test_compared_texts_are_weighed_in_pieces(monkeypatch):
    draw = np.random.default_rng(3)
    texts = [b" ".join(b"w%d" % k for k in draw.integers(0, 500, 10_000)) for _ in range(40)]
    texts[7] = texts[0]
    counters = np.ones((near.SKETCH_ROWS, near.SKETCH_SLOTS))
    weights = near.Weights(counters, 40, 5, 0.25, 64)
    whole = weights.weigh(Words(texts))
    sizes = _seen(monkeypatch, near)
    assert near._near_first(texts, weights, 0.8).tolist() == [6]
    assert len(sizes) > 1 and sum(sizes) == sum(map(len, texts)) and max(sizes) < 500_000
    for one, other in zip(weights.weigh_all(texts), whole, strict=True):
        assert np.array_equal(one, other)


def test_texts_are_scored_in_small_pieces(monkeypatch):
    words = [b"word%d" % k for k in range(200)]
    feature = np.unique(Words([b" ".join(words)]).hash)
    model = toxicity.Model(toxicity.Table(feature), np.linspace(-1, 1, 3 * len(feature)), 0.1)
    texts = [" ".join(["Some, text!"] * 2_000 + ["word"] * (k % 5)) for k in range(60)]
    sizes = _seen(monkeypatch, toxicity)
    found = model.score(texts)
    assert len(sizes) > 1 and max(sizes) < 500_000
    assert np.allclose(found, [model.score([t])[0] for t in texts])


@pytest.mark.parametrize("rows", [0, 30])
def test_packing_starts_no_other_python_workers(spark, monkeypatch, rows):
    def parallelize(*_, **__):
        raise AssertionError("rows from Python run through workers of their own")

    docs = spark.range(rows).selectExpr("id AS doc_id", "repeat('some text ', CAST(id * 100 AS INT)) AS text")
    monkeypatch.setattr(SparkContext, "parallelize", parallelize)
    placed = packing.pack(docs, word_tokenizer()).collect()
    assert {r.doc_id for r in placed} == set(range(rows))
