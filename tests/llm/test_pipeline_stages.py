"""Stages of the pipeline on odd rows."""

import random

import numpy as np

import corpus_pipeline
from assayer.llm import toxicity


def test_near_dedup_keeps_one_document_of_every_group(spark):
    rng = random.Random(5)
    text = lambda: " ".join(f"w{rng.randrange(9999)}" for _ in range(60))
    one, two, three, four, five, six = (text() for _ in range(6))
    rows = [
        (None, one), (None, two), (None, two), (None, three),  # unrelated texts without an id
        (7, four), (7, five), (3, five),  # one id, two groups
        (9, six), (None, six),
    ]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    out = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(None, one), (None, two), (None, three), (7, four), (3, five), (9, six)], key=str)


def test_texts_without_a_word_are_not_toxic(spark, monkeypatch):
    config = toxicity.ToxicityConfig()
    model = toxicity.ToxicityModel(config, np.zeros(1 << config.bits), 3.0)
    monkeypatch.setattr(corpus_pipeline, "toxicity_model", lambda *_: model)
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " ...\n!"), (4, "some words")], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, "").collect()} == {1, 2, 3}
