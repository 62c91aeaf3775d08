"""The pipeline's stages on odd rows and with columns whose names the operators use themselves."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clustrata.llm import queries

SF = "/root/testdata/sf0.001"
CLASH = ["toxicity", "id", "node", "h", "n", "size", "rank", "words", "item", "ids", "n_tokens", "decoded_sha256", "component_id", "_rank", "lost_id"]
WORDS = " ".join(f"word{i}" for i in range(40))
ROWS = [
    (1, None), (2, ""), (3, "  \n\t"), (4, "lone"), (5, WORDS), (5, WORDS), (6, WORDS + " and one more"), (None, "no id at all, but some words that nobody else has"),
    (7, "x y " * 40_000), (8, "X y\n" * 40_000), (9, "ünï ©ode 𝒳"), (9, "ünï ©ode 𝒳"),
]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame([(i, t, None if k % 3 else "en", None, None) for k, (i, t) in enumerate(ROWS)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return plain.withColumns({c: F.lit(3) for c in CLASH})


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, SF)
    rows = out.collect()
    ids = sorted((r["doc_id"] for r in rows), key=lambda i: (i is None, i or 0))
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns and all(r[c] == 3 for r in rows for c in CLASH)
    if name == "exact_dedup":
        assert ids == [3, 4, 5, 6, 7, 8, 9, None]  # the longest of the empty ones, one of each equal text
    elif name == "ngram_jaccard":
        assert ids == [1, 2, 3, 4, 5, 7, 9, None]
    elif name in ("toxicity", "decontamination"):
        assert {1, 2, 3} <= set(ids)
    else:
        assert len(rows) == len(ROWS) and all(r["exact"] for r in rows) and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert stage(spark, docs.where("false"), SF).count() == 0


def test_toxicity_without_labels(spark, docs, tmp_path):
    queries.table(spark, SF, "labels").where("false").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == len(ROWS)
