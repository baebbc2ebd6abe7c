"""The pipeline's stages, each on what the one before kept."""

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_clean_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, seen, SF).cache()
        assert out.count() <= seen.count()
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
            assert out.select("doc_id").distinct().count() == out.count()
        seen = out
    assert [c for c in seen.columns] == ["doc_id", "n_pieces", "ids"]
    assert seen.count() > 0.8 * docs.count()


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_other_columns_pass_through(spark, stage):
    docs = spark.createDataFrame([(1, "one two three four five six token=abcdefghijklmnop", "x", 9, 0.5), (2, None, "x", None, 0.5), (2, None, "x", None, 0.5)], "doc_id long, text string, lang string, n_chars long, score double")
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns
    assert out.count() >= 1
    assert stage(spark, docs.where("false"), SF).count() == 0


def test_secrets_become_marks(spark):
    docs = spark.createDataFrame([(1, "a token=abcdefghijklmnop b", 26), (2, "plain", 5)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.without_secrets(spark, docs, SF).collect()}
    assert got == {1: ("a [REDACTED] b", 14), 2: ("plain", 5)}
