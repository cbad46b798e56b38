from __future__ import annotations

import corpus_pipeline
from tests.llm.conftest import SF


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "pii", "packing"]


def test_every_stage_takes_effect(spark):
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs away into the wood", "en"),
        (2, "The quick brown fox jumps over the lazy dog and runs away into the wood", "en"),
        (3, "the quick brown fox jumps over the lazy dog and runs away into the woods", "en"),
        (4, "1234 5678 !!!", "en"),
        (5, None, "en"),
        (6, "der schnelle braune fuchs springt über den faulen hund, mail a@b.co", "de"),
        (7, "", None),
    ]
    docs = spark.createDataFrame([(i, t, lang, None, None if t is None else len(t)) for i, t, lang in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        kept[name] = sorted({r["doc_id"] for r in docs.collect()})
        if name == "pii":
            assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}[6] == ("der schnelle braune fuchs springt über den faulen hund, mail <EMAIL>", 68)
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert kept == {"language_id": [1, 2, 3, 6], "exact_dedup": [2, 3, 6], "near_dedup": [2, 6], "pii": [2, 6], "packing": [2, 6]}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_near_dedup_stage_compares_five_words(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(base)), (2, " ".join("x" if i % 20 == 7 else w for i, w in enumerate(base))), (3, " ".join([*base[:-1], "x"]))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup_stage(spark, docs, SF).collect()) == [1, 2]
