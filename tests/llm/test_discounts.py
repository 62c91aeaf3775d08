"""Scores of the language model don't depend on its shards."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clustrata.llm import ngram_lm

from .test_operators import ROWS, frame


def test_scores_do_not_depend_on_shards(spark, monkeypatch):
    score = lambda: {r["doc_id"]: r["score"] for r in ngram_lm.score_texts(frame(spark, ROWS), F.col("doc_id") % 2 == 0).collect()}
    one = score()
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 200)
    many = score()
    assert list(many.values()) == pytest.approx([one[i] for i in many], rel=1e-12)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 500)
    score = lambda n: {r["doc_id"]: r["score"] for r in ngram_lm.score_texts(frame(spark, ROWS).repartition(n), F.col("doc_id") % 2 == 0).collect()}
    two, many = score(2), score(13)
    assert list(many.values()) == pytest.approx([two[i] for i in many], rel=1e-12)
