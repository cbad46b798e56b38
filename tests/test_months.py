"""States that grow by months, presence in several windows, and several layouts from one pass."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from pathlib import Path

import pytest
from monthloom.operators import merge, missing, presence, rows, statistics
from monthloom.plans import jobs, months
from monthloom.plans.encode import encode_layouts, rulebook
from monthloom.plans.layouts import LAYOUTS
from monthloom.schema import in_window
from monthloom.sources import scratch, sinks
from pyspark.sql import functions as F

from checks.queries import Inputs

FOLDER = "/root/testdata/sf0.001"
ACTION = "user string, action_month string, actions string"


def drawn_actions(frame):
    draw = random.Random(3)
    text = lambda: ",".join(f"{draw.randrange(140, 150)}:{draw.randrange(9)}" for _ in range(draw.randrange(1, 6)))
    records = [(f"u{draw.randrange(12)}", f"2020-{m:02d}", text()) for m in range(1, 13) for _ in range(15)]
    return frame([*records, ("u1", None, "140:1"), ("nobody", "2020-03", "140:2"), ("u2", "2020-04", "")], ACTION)


def test_months_one_by_one_equal_a_whole_merge(spark, frame, tmp_path):
    actions = drawn_actions(frame)
    labels = frame([(f"u{n}", "2021-01" if n % 2 else "2020-11", n % 2) for n in range(12)], "user string, label_month string, label int")
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    for m in [*range(1, 13), 5]:  # one month is delivered twice
        months.add_month(actions, f"2020-{m:02d}", step)
    months.load(actions, whole)
    order = lambda df: sorted(map(tuple, df.select("user", "month", "field_id", "total", "n", "most", "least").collect()))
    assert order(months.read(spark, step)) == order(months.read(spark, whole))
    users, obs = merge.merge_training(labels, actions)
    found = months.merged(months.read(spark, step), users)
    key = lambda df: sorted((r["user"], r["dist"], r["field_id"], r["value"]) for r in df.collect())
    assert key(found) == key(obs)
    for k in (0, 6):
        got = {(r["user"], r["field_id"]): (r["avg"], r["max"], r["min"], r["change"]) for r in months.window_values(months.read(spark, step), users, k).collect()}
        values = defaultdict(list)
        for r in obs.filter(in_window(k)).collect():
            values[r["user"], r["field_id"]].append(r["value"])
        assert got == {u: (pytest.approx(sum(v) / len(v)), max(v), min(v), max(v) - min(v)) for u, v in values.items()}


def test_a_new_month_writes_its_own_folder_only(spark, frame, tmp_path):
    actions, path = drawn_actions(frame), str(tmp_path / "state")
    months.load(actions, path)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    before = files()
    months.add_month(actions.withColumn("actions", F.lit("141:9")), "2020-07", path)
    after = files()
    changed = {Path(p).parent.name for p in before.items() ^ after.items() for p in [p[0]]}
    assert changed == {"month=2020-07"}
    assert {r["total"] for r in months.read(spark, path).filter("month = '2020-07'").collect()} == {9.0}
    plan = months.common_window(months.read(spark, path), "2021-01", 9)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month#\d+ >= 2020-10", plan)  # older folders are not read
    got = months.common_window(months.read(spark, path), "2021-01", 9).count()
    assert got == months.read(spark, path).filter("month >= '2020-10'").select("user", "field_id").distinct().count()


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, FOLDER)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no order tables")
def test_one_state_for_all_windows(spark, inputs):
    users, obs = inputs.tables
    numbers = presence.numbered_users(users)
    assert numbers.select("number").distinct().count() == users.count()
    state = presence.presence_bitmaps(numbers, obs)
    # Months added to a state, in any order, are a union of rows.
    halves = [presence.presence_bitmaps(numbers, obs.filter(F.col("dist") % 2 == r)) for r in (1, 0)]
    want = sorted(map(tuple, presence.bitmap_presence(state).collect()))
    assert sorted(map(tuple, presence.bitmap_presence(halves[0].unionByName(halves[1])).collect())) == want
    both = presence.missing_windows(users, obs)
    for k in presence.WINDOWS:
        single = {r["user"]: r["value"] for r in missing.missing_count(users, obs, k).collect()}
        assert {r["user"]: r[f"missing{k}"] for r in both.collect()} == single
    total = users.count()
    whole = {r["field_id"]: total - r["missing"] for r in statistics.column_presence(users, obs, include_full=True).collect()}
    assert {f: n for f, k, n in want if k == 0} == {f: n for f, n in whole.items() if n}
    plan = presence.missing_windows(users, obs)._jdf.queryExecution().executedPlan().toString()  # not run yet: one plan only
    assert len(re.findall(r"FileScan parquet \[[^\]]*field_id", plan)) == 1


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no order tables")
def test_five_layouts_scan_the_observations_once(spark, inputs, tmp_path):
    users, obs = inputs.tables
    named = {name: LAYOUTS[name](inputs.catalogues) for name in LAYOUTS if name != "linear"}
    together = encode_layouts(users, obs, inputs.stats, named, excluded=inputs.excluded)
    plan = together._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[[^\]]*dist#[^\]]*\].*?PushedFilters: (\[.*?\]), ReadSchema", plan)
    assert len(scans) == 2 and sum("In(field_id" in s for s in scans) == 1  # the measures once, the profile's few fields once
    shared = list(dict.fromkeys(b for own in named.values() for b in own))
    assert len(shared) < sum(map(len, named.values()))  # blocks that layouts share are laid out once
    for name in named:
        alone = sorted(map(str, inputs.encoded(name).collect()))
        assert sorted(str(r) for r in together.filter(F.col("layout") == name).drop("layout").collect()) == alone
    sinks.write_layouts(rows.to_sparse_rows(together), str(tmp_path / "rows"))
    lines = spark.read.text(str(tmp_path / "rows"))
    assert {r["layout"] for r in lines.select("layout").distinct().collect()} == set(named)
    assert lines.filter("layout = 'half_year'").count() == inputs.encoded("half_year").count()


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no order tables")
def test_layouts_keep_shares_of_zero_totals(spark):
    from checks.queries import QUERIES

    assert QUERIES["layouts_keeping_nan"](spark, FOLDER).filter("value = -1").count() > 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no order tables")
def test_entries_without_a_field_are_spread(spark, inputs, monkeypatch):
    seen = []
    monkeypatch.setattr("monthloom.plans.encode.materialise", lambda df: seen.append(df) or scratch.materialise(df))
    rulebook(LAYOUTS["half_year"](inputs.catalogues), inputs.stats)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(field_id#\d+, _w\d+#\d+L?", plan)


def test_job_for_several_layouts(spark, inputs, tmp_path):
    users, obs = (df.withColumn("user", F.col("user").cast("string")) for df in inputs.tables)
    path = lambda name: str(tmp_path / name)
    sinks.write_profiles(merge.to_profiles(users, obs), path("profiles"))
    sinks.write_statistics(inputs.stats, path("stats"))
    sinks.write_catalogue(inputs.average_fields, path("average"))
    for name, fields in inputs.rates.items():
        sinks.write_catalogue(fields, path(name))
    lists = jobs.CataloguePaths({k: path("average") for k in (3, 9)}, {k: path("average") for k in (3, 9)}, {name: path(name) for name in inputs.rates})
    jobs.encode_together(spark, path("profiles"), ["three_seasons", "one_season"], lists, path("stats"), path("rows"))
    counted = {r["layout"]: r["count"] for r in spark.read.text(path("rows")).groupBy("layout").count().collect()}
    assert counted == {"three_seasons": users.count(), "one_season": users.count()}
