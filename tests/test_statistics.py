from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from monthloom.operators import ranking, selection, statistics
from monthloom.plans import jobs
from monthloom.sources import sinks, tables

OBS = "user string, dist int, field_id int, value double"
USERS = "user string, label_month string, label int"


def order_stats(frame, values):
    df = frame([(7, float(v)) for v in values], "field_id int, value double")
    (row,) = ranking.order_statistics(df, "field_id", "value").collect()
    return row["lo"], row["hi"]


@pytest.mark.parametrize("n, lo, hi", [(1, 0, 0), (2, 0, 1), (19, 0, 18), (20, 1, 19), (21, 1, 19), (60, 3, 57)])
def test_order_statistics_sit_at_floored_positions(frame, n, lo, hi):
    values = list(range(n))
    random.Random(n).shuffle(values)
    assert order_stats(frame, values) == (lo, hi)


def test_ties_and_negative_values(frame):
    values = [-1.0] * 30 + [0.0] * 50 + [2.5] * 20
    ordered = sorted(values)
    assert order_stats(frame, values) == (ordered[5], ordered[95])


def skewed(rng):
    """Field 1 holds most rows, and most of those share a few values."""
    rows = [(1, float(rng.choice([0, 0, 0, 1, rng.randint(2, 4000)]))) for _ in range(6000)]
    return rows + [(f, float(rng.randint(0, 50))) for f in range(2, 12) for _ in range(rng.randint(1, 60))]


def test_hot_group_against_brute_force(spark, frame):
    rows = skewed(random.Random(3))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = frame(rows, "field_id int, value double").repartition(8)
        ranked = ranking.running_totals(
            df.groupBy("field_id", "value").count().withColumnRenamed("count", "n"), ["field_id"], "value", ["n"]
        )
        # The hot field is spread over several tasks.
        got = {(r["field_id"], r["value"]): (r["before_n"], r["all_n"]) for r in ranked.collect()}
        stats = {r["field_id"]: (r["lo"], r["hi"]) for r in ranking.order_statistics(df, "field_id", "value").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by_field = {}
    for f, v in rows:
        by_field.setdefault(f, []).append(v)
    want = {
        (f, v): (sum(1 for x in vs if x < v), len(vs)) for f, vs in by_field.items() for v in set(vs)
    }
    assert got == want
    assert stats == {
        f: (sorted(vs)[math.floor(len(vs) * 0.05)], sorted(vs)[math.floor(len(vs) * 0.95)])
        for f, vs in by_field.items()
    }


def test_a_hot_field_is_split_over_chunks(spark, frame):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = frame([(1, float(i), 1) for i in range(4000)], "field_id int, value double, n int").repartition(4)
        from pyspark.sql import functions as F

        ranged = counts.repartitionByRange("field_id", "value").withColumn("chunk", F.spark_partition_id())
        sizes = [r["count"] for r in ranged.groupBy("chunk").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) < 4000


def test_statistics_use_user_means_and_round(frame):
    obs = frame(
        [("a", 1, 5, 1.0), ("a", 2, 5, 2.0), ("a", 3, 5, 2.0), ("b", 1, 5, 4.0)], OBS
    )
    (mean,) = statistics.minmax_stats(obs).collect()
    assert (mean["lo"], mean["hi"]) == (1.6667, 4.0)
    (exact,) = statistics.minmax_stats(obs, round_to=None).collect()
    assert exact["lo"] == 5 / 3
    (change,) = statistics.max_change_stats(obs).collect()
    assert (change["lo"], change["hi"]) == (0.0, 1.0)
    assert tables.drop_constant(statistics.minmax_stats(frame([("a", 1, 5, 1.0)], OBS))).count() == 0


def test_column_presence(frame):
    users = frame([(u, "2017-01", 0) for u in "abcd"], USERS)
    obs = frame(
        [
            ("a", 1, 1, 0.0),
            ("b", 1, 1, 0.0),
            ("c", 1, 1, 1.0),
            ("d", 1, 1, 1.0),
            ("a", 1, 6, 0.0),
            ("b", 1, 6, 2.0),
            ("b", 2, 6, 3.0),
        ],
        OBS,
    )
    some = {r["field_id"]: r["presence"] for r in statistics.column_presence(users, obs, 8).collect()}
    assert some == {2: 0.0, 3: 0.0, 4: 0.0, 5: 0.0, 6: 0.25, 7: 0.0, 8: 0.0}
    full = statistics.column_presence(users, obs, 8, include_full=True).collect()
    assert (full[0]["field_id"], full[0]["presence"]) == (1, 1.0)


def test_row_presence(frame):
    users = frame([(u, "2017-01", 0) for u in "ab"], USERS)
    obs = frame([("a", 1, 13, 0.0), ("a", 2, 13, 0.0), ("a", 1, 6, 1.0), ("a", 1, 7, 0.0)], OBS)
    rows = [(r["user"], r["presence"]) for r in statistics.row_presence(users, obs, 100).collect()]
    assert rows == [("a", 0.02), ("b", 0.0)]


def test_category_reports(frame):
    users = frame([("a", "2017-01", 1), ("b", "2017-01", 0), ("c", "2017-01", 1), ("d", "2017-01", 0)], USERS)
    obs = frame(
        [("a", 1, 4, 2.0), ("a", 2, 4, 9.0), ("b", 3, 4, 2.0), ("c", 1, 4, 5.0), ("d", 1, 4, -1.0)], OBS
    )
    rates = [(r["value"], r["rate"]) for r in statistics.category_rate(users, obs, 4).collect()]
    assert rates == [(5.0, 1.0), (2.0, 0.5)]
    assert [r["value"] for r in statistics.category_values(obs, 4).collect()] == [-1.0, 2.0, 5.0, 9.0]


def test_statistics_files(spark, frame, tmp_path):
    obs = frame([("a", 1, 5, 1.0), ("a", 2, 5, 2.0), ("a", 3, 5, 2.0)], OBS)
    sinks.write_statistics(statistics.minmax_stats(obs), str(tmp_path / "stats"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "stats")).collect()] == ["5\t1.6667\t1.6667"]
    assert tables.read_statistics(spark, str(tmp_path / "stats")).head()["lo"] == 1.6667
    users = frame([("a", "2017-01", 0), ("b", "2017-01", 0)], USERS)
    sinks.write_column_presence(statistics.column_presence(users, obs, 5), str(tmp_path / "columns"))
    assert "5\t0.5000" in {r["value"] for r in spark.read.text(str(tmp_path / "columns")).collect()}
    sinks.write_row_presence(statistics.row_presence(users, obs, 4), str(tmp_path / "rows"))
    assert {r["value"] for r in spark.read.text(str(tmp_path / "rows")).collect()} == {"a\t0.2500", "b\t0.0000"}


def test_statistics_jobs(spark, frame, tmp_path):
    (tmp_path / "labels").write_text("a\t2017-01\t1\nb\t2017-01\t0\n")
    (tmp_path / "actions").write_text("a\t2016-12\t5:1,4:3\na\t2016-11\t5:4\nb\t2016-12\t5:7\n")
    path = lambda name: str(tmp_path / name)
    jobs.merge_for_training(spark, path("labels"), path("actions"), path("profiles"))
    jobs.minmax_statistics(spark, path("profiles"), path("minmax"))
    jobs.max_change_statistics(spark, path("profiles"), path("change"))
    jobs.column_presence(spark, path("profiles"), path("columns"))
    jobs.row_presence(spark, path("profiles"), path("rows"))
    minmax = {r["field_id"]: (r["lo"], r["hi"]) for r in tables.read_statistics(spark, path("minmax")).collect()}
    assert minmax == {4: (3.0, 3.0), 5: (2.5, 7.0)}
    change = {r["field_id"]: (r["lo"], r["hi"]) for r in tables.read_statistics(spark, path("change")).collect()}
    assert change == {4: (0.0, 0.0), 5: (0.0, 3.0)}
    assert spark.read.text(path("columns")).count() == 96116 - 1
    assert spark.read.text(path("rows")).count() == 2
    assert [tuple(r) for r in jobs.category_rate(spark, path("profiles"), 4).collect()] == [(3.0, 1.0)]
    assert [r["value"] for r in jobs.category_values(spark, path("profiles"), 5).collect()] == [1.0, 4.0, 7.0]


def test_medians(frame):
    values = frame(
        [(f"u{i}", f, float(v)) for f, vs in {1: [1, 2, 3, 4], 2: [5], 3: [9, 1, 7]}.items() for i, v in enumerate(vs)],
        "user string, field_id int, value double",
    )
    importance = frame([(1, 5.0), (2, 9.0), (3, 7.0), (4, 99.0)], "field_id int, score double")
    got = [(r["field_id"], r["median"]) for r in selection.field_medians(values, importance, 2).collect()]
    assert got == [(2, 5.0), (3, 7.0)]


def drawn_values(n=6000):
    rng = random.Random(12)
    rows = [(k, 5.0 if rng.random() < 0.34 else rng.choice([rng.gauss(0, 9), float(rng.randrange(4))])) for k in (1, 1, 2) for _ in range(n // 3)]
    return rows + [(None, float(v)) for v in range(7)] + [(9, 1.5)]


WANTED = [(q, lambda n, q=q: F.floor(n * F.lit(q))) for q in (0.0, 0.05, 0.34, 0.95)]


def placed(rows):
    out = {}
    for k in {k for k, _ in rows}:
        own = sorted(v for key, v in rows if key == k)
        out.update({(k, i): own[math.floor(len(own) * q)] for i, (q, _) in enumerate(WANTED)})
    return out


@pytest.mark.parametrize("accuracy", [4, 50, 1000])
def test_bracketed_positions_equal_sorting(frame, accuracy):
    rows = drawn_values()
    found = ranking.at_positions(frame(rows, "k int, v double").repartition(5), "k", "v", WANTED, accuracy).collect()
    assert {(r["k"], r["which"]): r["v"] for r in found} == placed(rows) and len(found) == len(placed(rows))


def test_a_bracket_that_misses_is_replaced(frame, monkeypatch):
    rows = drawn_values(900)
    monkeypatch.setattr(ranking.F, "percentile_approx", lambda v, shares, accuracy: F.array_repeat(F.max(v), F.size(shares)))
    found = ranking.at_positions(frame(rows, "k int, v double"), "k", "v", WANTED, 1000).collect()
    assert {(r["k"], r["which"]): r["v"] for r in found} == placed(rows)
    assert ranking.at_positions(frame([], "k int, v double"), "k", "v", WANTED).count() == 0


def test_only_what_brackets_hold_is_shuffled(spark, monkeypatch):
    seen = []
    inside = ranking._inside
    monkeypatch.setattr(ranking, "_inside", lambda *a: seen.append(inside(*a)) or seen[-1])
    values = spark.range(40_000).selectExpr("cast(id % 2 as int) as k", "cast(id as double) as v")
    ranking.order_statistics(values, "k", "v").collect()
    rows = seen[0].agg(F.count("inside").alias("n")).head()["n"]
    assert rows <= 2 * 2 * (0.006 * 20_000 + 2 * 0.001 * 20_000 + 2)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.index("HashAggregate") < plan.index("Exchange hashpartitioning") < plan.rindex("<= high")  # filtered and combined before the exchange
