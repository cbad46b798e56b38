from __future__ import annotations

import hashlib
import math
import random
from dataclasses import replace

import pytest
from monthloom.operators import boosting, trees
from monthloom.plans import jobs
from monthloom.sources import sinks

ROWS = "user string, label int, feature_size int, tokens array<struct<idx:int,value:double>>"
UNIT = boosting.UNIT


def share(*parts):
    return int(hashlib.md5("#".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2**32


def plain_trees(records, s):
    """The same learner over lists: best-first, one split at a time, every histogram from its rows."""
    users = [(u, label, {i - 1: v for i, v in tokens if v}) for u, label, _, tokens in records]
    features = sorted({f for _, _, x in users for f in x})
    below = {f: sorted(x.get(f, 0.0) for _, _, x in users) for f in features}
    codes = {f: {v: below[f].index(v) * s.bins // len(users) for v in below[f]} for f in features}
    margins, out = [0.0] * len(users), []
    for number in range(s.rounds):
        allowed = [f for f in features if share(f, "column", s.seed, number) < s.column_sample]
        drawn = [i for i, u in enumerate(users) if share(u[0], "row", s.seed, number // s.sample_every) < s.row_sample]
        p = [1 / (1 + math.exp(-m)) for m in margins]
        g = [round((p[i] - users[i][1]) * UNIT) for i in range(len(users))]
        h = [round(p[i] * (1 - p[i]) * UNIT) for i in range(len(users))]
        part = lambda rows: (sum(g[i] for i in rows) / UNIT) ** 2 / (sum(h[i] for i in rows) / UNIT + s.l2)  # noqa: B023, E731

        def best(rows, depth):
            found = None
            if s.depth is not None and depth >= s.depth:
                return None
            for f in allowed:  # noqa: B023
                held = {i: codes[f].get(users[i][2].get(f, 0.0)) for i in rows}
                for c in sorted(set(held.values())):
                    left = [i for i in rows if held[i] <= c]
                    right = [i for i in rows if held[i] > c]
                    if min(len(left), len(right)) < max(1, s.min_rows) or min(sum(h[i] for i in x) for x in (left, right)) / UNIT < s.min_weight:  # noqa: B023
                        continue
                    gain = part(left) + part(right) - part(rows)  # noqa: B023
                    if gain > 1e-12 and (found is None or gain > found[0] + 1e-12):
                        found = (gain, f, max(v for v in codes[f] if codes[f][v] <= c), left, right)
            return found

        leaves = [("", drawn, best(drawn, 0))]
        splits = {}
        while len(leaves) < s.leaves and any(b for _, _, b in leaves):
            path, rows, b = max((x for x in leaves if x[2]), key=lambda x: x[2][0])
            leaves.remove((path, rows, b))
            splits[path] = b
            leaves += [(path + "L", b[3], best(b[3], len(path) + 1)), (path + "R", b[4], best(b[4], len(path) + 1))]
        value = {path: -s.rate * (sum(g[i] for i in rows) / UNIT) / (sum(h[i] for i in rows) / UNIT + s.l2) for path, rows, _ in leaves}
        for i, (_, _, x) in enumerate(users):
            path = ""
            while path in splits:
                path += "L" if x.get(splits[path][1], 0.0) <= splits[path][2] else "R"
            margins[i] += value[path]
        out += [(number, path, b[1], b[2], round(b[0], 9), len(b[3]) + len(b[4]), None) for path, b in splits.items()]
        out += [(number, path, None, None, None, len(rows), round(value[path], 9)) for path, rows, _ in leaves]
    return sorted(out, key=repr), {u[0]: 1 / (1 + math.exp(-m)) for u, m in zip(users, margins, strict=True)}


@pytest.fixture(scope="module")
def records():
    draw = random.Random(11)
    out = []
    for n in range(160):
        x = {1: draw.choice([0, 0, 1.5, 2, -1]), 2: draw.random(), 3: draw.choice([0.0, -3.0]), 5: round(draw.random(), 1), 6: 7.0}
        label = int(draw.random() < (0.8 if x[1] > 0 and x[2] > 0.4 else 0.15))
        out.append((f"u{n}", label, 6, sorted((i, float(v)) for i, v in x.items() if v)))
    return out


SMALL = boosting.Settings(rounds=3, leaves=5, rate=0.3, min_weight=0.5, min_rows=4, bins=16, row_sample=0.8, sample_every=2, column_sample=0.9, seed=4)


@pytest.mark.parametrize("settings", [SMALL, replace(SMALL, depth=2, leaves=4, l2=2.0, sample_every=1), replace(SMALL, leaves=63, bins=255, row_sample=1.0, column_sample=1.0, rounds=2)])
def test_trees_equal_a_plain_model(frame, records, settings):
    encoded = frame(records, ROWS)
    nodes = boosting.train(encoded.repartition(3), settings)
    want, rates = plain_trees(records, settings)
    found = trees.paths(nodes).select("*", trees.turns(trees.F.col("path")).alias("turns")).collect()
    rounded = lambda x: None if x is None else round(x, 9)
    got = [(r["tree"], r["turns"], r["feature"], r["threshold"], rounded(r["gain"]), int(r["cover"]), rounded(r["value"])) for r in found]
    assert sorted(got, key=repr) == want
    assert {r["user_id"]: r["ovd_rate"] for r in trees.score(nodes, encoded).collect()} == pytest.approx(rates)
    errors = [r["log_loss"] for r in trees.round_errors(nodes, encoded).orderBy("round").collect()]
    labels = {u: label for u, label, *_ in records}
    assert len(errors) == settings.rounds and errors == sorted(errors, reverse=True)
    assert errors[-1] == pytest.approx(-sum(math.log(rates[u] if labels[u] else 1 - rates[u]) for u in labels) / len(labels))
    counted = {r["feature_idx"]: (r["splits"], round(r["gain"], 6)) for r in trees.importances(nodes).collect()}
    again = {}
    for _, _, f, _, gain, _, _ in want:
        if f is not None:
            n, total = again.get(f + 1, (0, 0.0))
            again[f + 1] = (n + 1, total + gain)
    assert counted == {f: (n, round(total, 6)) for f, (n, total) in again.items()}


def test_margins_written_on_the_way_change_nothing(frame, records, monkeypatch):
    encoded, settings = frame(records, ROWS), replace(SMALL, rounds=3, leaves=3)
    key = lambda r: (r["tree"], r["node"])
    once = sorted(boosting.train(encoded, settings).collect(), key=key)
    monkeypatch.setattr(boosting, "CUT_EVERY", 1)
    assert sorted(boosting.train(encoded, settings).collect(), key=key) == once


def test_boxes_hold_exactly_the_rows_of_their_leaf(frame, records):
    nodes = boosting.train(frame(records, ROWS), replace(SMALL, rounds=1))
    walked = trees.paths(nodes)
    sides = {}
    for b in trees.boxes(walked).collect():
        sides.setdefault(b["node"], []).append((b["feature"], b["above"], b["upto"]))
    leaves = {r["node"]: r["value"] for r in nodes.collect() if r["value"] is not None}
    rates = {r["user_id"]: r["ovd_rate"] for r in trees.score(nodes, frame(records, ROWS)).collect()}
    for user, _, _, tokens in records:
        x = {i - 1: v for i, v in tokens}
        inside = [n for n, own in sides.items() if all((lo is None or x.get(f, 0.0) > lo) and (hi is None or x.get(f, 0.0) <= hi) for f, lo, hi in own)]
        assert len(inside) == 1 and rates[user] == pytest.approx(1 / (1 + math.exp(-leaves[inside[0]])))


def test_nothing_to_split(frame):
    same = frame([(f"u{i}", i % 2, 3, []) for i in range(9)], ROWS)
    nodes = boosting.train(same, replace(SMALL, rounds=1, row_sample=1.0)).collect()
    assert [(r["node"], r["feature"], r["cover"]) for r in nodes] == [(0, None, 9.0)]
    none = boosting.train(frame([], ROWS), replace(SMALL, rounds=1)).collect()
    assert [(r["node"], r["value"]) for r in none] == [(0, 0.0)]


def test_job(spark, frame, records, tmp_path):
    encoded = frame(records, ROWS)
    from monthloom.operators import rows

    sinks.write_encoded(rows.to_sparse_rows(encoded), str(tmp_path / "rows"))
    out = {name: str(tmp_path / name) for name in ("train", "test", "importance", "model", "errors")}
    nodes = jobs.boost_and_score(
        spark, str(tmp_path / "rows"), str(tmp_path / "rows"), out["train"], out["test"], out["importance"], out["model"], replace(SMALL, rounds=2), out["errors"]
    )
    assert nodes.select("tree").distinct().count() == 2
    listed = spark.read.csv(out["importance"], header=True)
    assert listed.count() == nodes.filter("feature is not null").select("feature").distinct().count()
    assert spark.read.csv(out["train"], header=True).count() == len(records)
    assert spark.read.csv(out["errors"], header=True).count() == 2
