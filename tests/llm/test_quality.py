from __future__ import annotations

import numpy as np
from monthloom.llm import quality
from monthloom.llm.queries import QUERIES
from pyspark.sql import functions as F


def test_vote_is_the_weighted_mean_of_the_nearest():
    draw = np.random.default_rng(2)
    raw = draw.random((60, 5)).astype(np.float32)
    vectors = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    labels = draw.integers(0, 2, 60).astype(np.float32)
    voters = quality.Voters(np.eye(5, dtype=np.float32), vectors, labels, 0.5)
    latent = vectors[:7]
    expected = []
    for row in latent:
        near = sorted(range(60), key=lambda i: -float(row @ vectors[i]))[: quality.NEIGHBOURS]
        weights = [float(row @ vectors[i]) ** quality.SHARPNESS for i in near]
        expected.append(sum(w * labels[i] for w, i in zip(weights, near, strict=True)) / sum(weights))
    assert np.allclose(quality.vote(latent, voters), expected, atol=1e-5)


def test_raw_vectors_do_not_depend_on_the_batch():
    texts = ["", "ab", "hello world", "é" * 50, "WORD WORD WORD! "] + ["long text here. " * 60_000]
    together = quality.raw_vectors(texts)
    for i, text in enumerate(texts):
        assert np.array_equal(together[i], quality.raw_vectors([text])[0])
    assert quality.styles("A a a a") == (2 / 3, 0.0, 0.0)


def test_odd_rows_and_labels(spark):
    docs = [(i, f"good plain text number {i} with words", 1) for i in range(30)] + [(100 + i, f"BUY!! NOW!! {i}!! FREE!!", 1) for i in range(30)]
    docs += [(200, None, 1), (201, "", 1), (202, "good plain text with words", 1), (203, "BUY!! FREE!! NOW!!", 1), (203, "BUY!! FREE!! NOW!!", 1), (None, "good words", 1)]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(i, 1 if i < 100 else 0, None) for i in [*range(30), *range(100, 130)]] + [(5, 0, None), (7, None, None)], "doc_id bigint, quality int, toxic int")
    voters = quality.train(docs, labels, F.lit(True))
    out = {r["doc_id"]: r["score"] for r in quality.score(docs, voters).collect()}
    assert len(out) == 65 and all(0 <= s <= 1 for s in out.values())
    assert out[202] > 0.7 > 0.3 > out[203]
    assert out[200] == out[201] == voters.mean
    assert quality.score(docs.limit(0), voters).collect() == []
    assert quality.train(docs, labels.limit(0), F.lit(True)) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    out = QUERIES["op3_quality"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out")
    right = out.groupBy("quality").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int")).alias("right"))
    share = {r["quality"]: r["right"] for r in right.collect()}
    assert share[1] > 0.95 and share[0] > 0.85
