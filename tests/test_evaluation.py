from __future__ import annotations

import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from monthloom.operators import evaluation, model, rows
from monthloom.plans import jobs
from monthloom.sources import sinks, tables

PREDICTION = "user_id string, ovd_rate double"
TRUTH = "user_id string, label int"


def scores(frame, values):
    return frame([(f"u{i}", float(v)) for i, v in enumerate(values)], PREDICTION)


def area(frame, values, labels):
    truth = frame([(f"u{i}", y) for i, y in enumerate(labels)], TRUTH)
    return evaluation.auc(scores(frame, values), truth).head()["auc"]


def test_auc_of_ties(frame):
    assert area(frame, [0.1, 0.4, 0.4, 0.8], [0, 0, 1, 1]) == 0.875
    assert area(frame, [1, 2, 3], [0, 0, 1]) == 1.0
    assert area(frame, [3, 3, 3], [0, 1, 1]) == 0.5
    assert area(frame, [3, 2], [1, 1]) is None


def test_auc_against_all_pairs(frame):
    rng = random.Random(1)
    # A third of all users share one score.
    values = [0.5 if rng.random() < 0.35 else round(rng.random(), 2) for _ in range(600)]
    labels = [int(rng.random() < 0.2 + 0.5 * v) for v in values]
    positive = [v for v, y in zip(values, labels, strict=True) if y]
    negative = [v for v, y in zip(values, labels, strict=True) if not y]
    won = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    assert area(frame, values, labels) == pytest.approx(won / (len(positive) * len(negative)))


def best_grid(x, y, exponent=0.6):
    n = len(x)
    cells_allowed = math.floor(n**exponent)
    below = lambda vs: [sum(1 for w in vs if w < v) for v in vs]
    bx, by = below(x), below(y)
    best = 0.0
    for i in range(2, cells_allowed // 2 + 1):
        for j in range(2, cells_allowed // i + 1):
            cells = Counter((b * i // n, c * j // n) for b, c in zip(bx, by, strict=True))
            columns, lines = Counter(), Counter()
            for (a, b), c in cells.items():
                columns[a] += c
                lines[b] += c
            gain = sum(c / n * math.log(c * n / (columns[a] * lines[b])) for (a, b), c in cells.items())
            best = max(best, gain / math.log(min(i, j)))
    return best


@pytest.mark.parametrize("kind", ["line", "noise", "ties"])
def test_best_equal_count_grid(frame, kind):
    rng = random.Random(7)
    x = [rng.random() for _ in range(120)]
    y = {"line": x, "noise": [rng.random() for _ in x], "ties": [round(v * 3) for v in x]}[kind]
    got = evaluation.grid_scores(scores(frame, x), scores(frame, y)).selectExpr("max(score) as best").head()["best"]
    assert got == pytest.approx(best_grid(x, y))


def every_cut(x, y, bins, levels):
    """The best score over all ways to cut ``x`` into at most ``bins`` parts, against equal-count parts of ``y``."""
    n, values = len(x), sorted(set(x))
    level = [sum(1 for w in y if w < v) * levels // n for v in y]
    best = 0.0
    for cuts in itertools.chain.from_iterable(itertools.combinations(values[1:], k) for k in range(bins)):
        cells = Counter((sum(v >= c for c in cuts), r) for v, r in zip(x, level, strict=True))
        columns, lines = Counter(), Counter()
        for (c, r), m in cells.items():
            columns[c] += m
            lines[r] += m
        best = max(best, sum(m / n * math.log(m * n / (columns[c] * lines[r])) for (c, r), m in cells.items()))
    return best / math.log(min(bins, levels))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_optimised_grids_equal_exhaustive_search(frame, seed):
    rng = random.Random(seed)
    x = [rng.randrange(9) for _ in range(40)]
    y = [v if rng.random() < 0.5 else rng.randrange(7) for v in x]
    exact = evaluation.optimised_grids(scores(frame, x), scores(frame, y), clumps=None).collect()
    assert {(r["axis"], r["bins"], r["levels"]) for r in exact} == {(a, i, j) for a in "xy" for i in range(2, 5) for j in range(2, 5) if i * j <= 9}
    for r in exact:
        own, other = (x, y) if r["axis"] == "x" else (y, x)
        assert r["score"] == pytest.approx(every_cut(own, other, r["bins"], r["levels"]))
    # With more parts per bin than there are scores, cuts between parts are cuts between scores.
    many = evaluation.optimised_grids(scores(frame, x), scores(frame, y), clumps=40).collect()
    key = lambda r: (r["axis"], r["bins"], r["levels"])
    assert [pytest.approx(tuple(r)[3]) for r in sorted(many, key=key)] == [r["score"] for r in sorted(exact, key=key)]
    best = evaluation.grid_association(scores(frame, x), scores(frame, y), clumps=None).head()["association"]
    assert best == pytest.approx(max(r["score"] for r in exact))
    assert best >= best_grid(x, y) - 1e-12


def test_association_of_a_line_and_of_runs(frame):
    x = [i / 50 for i in range(100)]
    assert evaluation.grid_association(scores(frame, x), scores(frame, [v * v for v in x])).head()["association"] == pytest.approx(1.0)
    cells = np.array([[3, 0], [2, 0], [0, 4], [1, 1], [0, 5], [0, 2]])
    joined = np.array([[5, 0], [0, 4], [1, 1], [0, 7]])
    assert evaluation.best_cuts(cells, 6) == pytest.approx(evaluation.best_cuts(joined, 6))


def test_work_is_bounded_by_distinct_scores(frame):
    """A hundred times the users on the same scores give the same cells."""
    rng = random.Random(4)
    x, y = [rng.randrange(6) for _ in range(50)], [rng.randrange(6) for _ in range(50)]
    once, often = (evaluation.grid_association(scores(frame, x * k), scores(frame, y * k), 0.6 if k == 1 else 0.6 * math.log(50) / math.log(50 * k), None) for k in (1, 20))
    assert often.head()["association"] == pytest.approx(once.head()["association"])


def test_chosen_grids_only(frame):
    x = scores(frame, [i * 37 % 101 for i in range(120)])
    some = evaluation.grid_scores(x, x, axis=[3, 5]).collect()
    assert sorted((r["a"], r["b"]) for r in some) == [(3, 3), (3, 5), (5, 3)]


def test_too_few_users_for_a_grid(frame):
    few = scores(frame, [1, 2, 3])
    assert evaluation.grid_association(few, few).head()["association"] == 0.0


def test_blends(frame):
    first, second = scores(frame, [0.2, 0.4, 0.6]), scores(frame, [1.0, 0.0])
    blended = evaluation.blend([first, second], evaluation.MODEL_WEIGHTS, complete=False)
    assert {r["user_id"]: r["ovd_rate"] for r in blended.collect()} == pytest.approx({"u0": 0.84, "u1": 0.08})
    for others in (second, first.unionByName(first)):
        with pytest.raises(Exception, match="not exactly one score"):
            evaluation.blend_models(first, others).collect()
    equal = evaluation.blend_windows([first] * 4)
    assert {r["user_id"]: r["ovd_rate"] for r in equal.collect()} == pytest.approx({"u0": 0.2, "u1": 0.4, "u2": 0.6})
    with pytest.raises(ValueError):
        evaluation.blend([first], [0.5, 0.5])


def test_correlation(frame):
    line = evaluation.correlation(scores(frame, [1, 2, 3]), scores(frame, [2, 4, 6]))
    assert line.head()["correlation"] == pytest.approx(1.0)


def test_holdout(spark):
    users = spark.range(4000).selectExpr("cast(id as string) as user", "cast(id % 4 = 0 as int) as label")
    first = {r["user"]: r["is_validation"] for r in model.holdout_split(users).collect()}
    again = {r["user"]: r["is_validation"] for r in model.holdout_split(users.repartition(7)).collect()}
    assert first == again
    for label in (0, 1):
        held = [first[str(i)] for i in range(4000) if (i % 4 == 0) == label]
        assert 0.07 < sum(held) / len(held) < 0.13
    assert first != {r["user"]: r["is_validation"] for r in model.holdout_split(users, seed=1).collect()}
    train, validate = model.holdout_sample(users, 0.1, seed=3)
    assert train.count() + validate.count() == 4000
    assert train.join(validate, "user").count() == 0


@pytest.mark.parametrize("digits", [4, 1])
def test_exact_sample_per_label(spark, monkeypatch, digits):
    """Against sorting by hash, whatever the number of ranges and partitions."""
    monkeypatch.setattr(model, "HASH_DIGITS", digits)
    users = spark.createDataFrame([(f"u{i}", None if i % 50 == 0 else i % 3, i) for i in range(1501)], "user string, label int, rank int")
    for fraction in (0.0, 0.1, 0.333, 1.0):
        want = set()
        for label in (None, 0, 1, 2):
            own = sorted((hashlib.md5(f"u{i}#5".encode()).hexdigest(), f"u{i}") for i in range(1501) if (None if i % 50 == 0 else i % 3) == label)
            want.update(u for _, u in own[: math.ceil(len(own) * fraction)])
        for parts in (1, 7):
            marked = model.exact_sample(users.repartition(parts), fraction, 5)
            assert {r["user"] for r in marked.filter("is_validation").collect()} == want
            assert marked.columns == [*users.columns, "is_validation"] and marked.count() == 1501
    assert model.exact_sample(users.limit(0)).count() == 0


@pytest.fixture(scope="module")
def encoded(frame):
    rng = random.Random(2)
    records = []
    for i in range(300):
        y = int(rng.random() < 0.4)
        tokens = [(1, 1.0), (2 + y if rng.random() < 0.9 else 4, 1.0), (6, float(rng.randint(1, 9)))]
        records.append((f"u{i}", y, 6, tokens))
    return frame(records, "user string, label int, feature_size int, tokens array<struct<idx:int,value:double>>")


def test_trees_find_the_signal(encoded):
    vectors = rows.to_vectors(encoded)
    trees = model.train(vectors, rounds=5, depth=3, rate=0.3)
    predictions = model.score(trees, vectors)
    truth = encoded.select(encoded["user"].alias("user_id"), "label")
    assert evaluation.auc(predictions, truth).head()["auc"] > 0.9
    used = {r["feature_idx"]: r["score"] for r in model.importances(trees, vectors).collect()}
    assert max(used, key=used.get) in (2, 3) and 1 not in used


def test_training_runs_every_round(encoded):
    """At the small default rate single rounds gain little, which must not end the training."""
    vectors = rows.to_vectors(encoded)
    held, rest = vectors.filter("user like '%1'"), vectors.filter("not user like '%1'")
    trees = model.train(rest, rounds=12, depth=2)
    assert trees.getNumTrees == 12
    errors = model.validation_error(trees, held).collect()
    assert [r["round"] for r in errors] == list(range(1, 13))
    assert all(0 < r["error"] < 2 for r in errors)


def test_stopping_early_is_asked_for(encoded):
    vectors = rows.to_vectors(encoded)
    held, rest = vectors.filter("user like '%1'"), vectors.filter("not user like '%1'")
    assert 1 <= model.train(rest, rounds=12, depth=2, stop_on=held).getNumTrees < 12


def test_train_and_score_job(spark, encoded, tmp_path):
    path = lambda name: str(tmp_path / name)
    sinks.write_encoded(rows.to_sparse_rows(encoded), path("rows"))
    read = tables.read_encoded(spark, path("rows"))
    assert sorted(map(str, read.collect())) == sorted(map(str, encoded.collect()))
    lines = [r["value"] for r in spark.read.text(path("rows")).collect()]
    assert sorted(lines) == lines and lines[0].startswith("u0\t6\t")
    assert sinks.svm_lines(rows.to_sparse_rows(encoded)).columns == ["user", "line"]
    jobs.train_and_score(
        spark,
        path("rows"),
        path("rows"),
        path("train.csv"),
        path("test.csv"),
        path("importance.csv"),
        model_path=path("model"),
        validate=True,
        rounds=2,
        depth=2,
    )
    predictions = tables.read_predictions(spark, path("test.csv"))
    assert predictions.count() == 300
    header = spark.read.csv(path("importance.csv"), header=True).columns
    assert header == ["feature", "score"]
    jobs.blend_windows(spark, [path("train.csv"), *[path("test.csv")] * 3], path("windows"))
    jobs.blend_models(spark, path("test.csv"), path("windows"), path("final"))
    final = tables.read_predictions(spark, path("final"))
    gaps = final.join(predictions.withColumnRenamed("ovd_rate", "single"), "user_id").selectExpr("max(abs(ovd_rate - single)) as gap")
    assert gaps.head()["gap"] < 1e-9
