from __future__ import annotations

import math
import random

from monthloom.llm import topk
from monthloom.llm.oracles import ORACLES
from pyspark.sql import functions as F
from tests.llm.conftest import plain

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, rank string, number int"


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, None, 1.0, "x", 2) for r in rows], SCHEMA.replace("float", kind))


def brute(rows, k=10):
    sound = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in sound:
        if q % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in sound if c != q)  # noqa: B905
            out += [{"query_id": q, "rank": r, "vec_id": c, "score": -s} for r, (s, c) in enumerate(scored[:k], 1)]
    return sorted(({k: r[k] for k in sorted(r)} for r in out), key=repr)


def run(frame):
    return plain(topk.search(frame.repartition(6), F.col("vec_id") % 100 == 0))


def test_matches_brute_force_and_sql(spark, twin):
    draw = random.Random(3)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.25, draw.uniform(-1, 1)]) for _ in range(9)]) for i in range(700)]
    rows += [(i, rows[200][1]) for i in range(1000, 1100)]  # ties
    rows = [(i, [float(f"{x:.3f}") for x in v]) for i, v in rows]
    frame = vectors(spark, rows, "double")
    assert run(frame) == brute(rows)
    assert run(frame) == twin(ORACLES["op9_topk"], rows, "embeddings", "vec_id bigint, embedding double[]")


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    draw = random.Random(8)
    rows = [(i * 50, [draw.uniform(-1, 1) for _ in range(4)]) for i in range(40)]
    assert run(vectors(spark, rows, "double")) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, []), (6, [1.0]), (None, [1.0, 1.0]), (7, [-3.0, 0.5, 9.0]), (100, None), (200, [])]
    assert run(vectors(spark, rows)) == brute(rows)
    assert run(vectors(spark, [])) == []
    assert run(vectors(spark, [(0, [1.0])])) == []


def test_sums_beyond_doubles_are_exact(spark):
    rows = [(0, [2.0e6, 1.0, 7.0]), (1, [2.0e6, 1.0, 2.0]), (2, [2.0e6, 1.0, 1.0]), (3, [2.0e6, 2.0, 1.0])]
    assert run(vectors(spark, rows, "double")) == brute(rows)


def test_repeated_ids(spark):
    out = run(vectors(spark, [(0, [1.0]), (0, [-1.0]), (1, [2.0]), (1, [3.0])], "double"))
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out] == [(0, 1, 1, -2 * 1024**2), (0, 2, 1, -3 * 1024**2)]
