"""Shapes of the physical plans, and the registered queries against their SQL twins."""

from __future__ import annotations

import re
from pathlib import Path
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.oracles import ORACLES
from checks.queries import QUERIES, Inputs
from monthloom.operators import merge, selection, statistics
from monthloom.plans.encode import encode_layout
from monthloom.plans.layouts import LAYOUTS
from monthloom.sources import scratch, sinks

FOLDER = "/root/testdata/sf0.001"
# The only queries with Python on rows: dynamic programming over the bounded cells of one grid.
PROGRAMMED = ("optimised_grids", "grid_association")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no order tables")
TYPES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("customer", "orders", "lineitem"):
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = plan_of(df)
    for node in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", *(() if name in PROGRAMMED else ("FlatMapGroups",))):
        assert node not in plan
    rows = df.collect()
    if name not in ORACLES:
        assert rows
        return
    twin = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(twin.columns)
    types = {c: TYPES[str(t)] for c, t in zip(twin.columns, twin.types, strict=True)}
    assert {f.name: f.dataType.simpleString() for f in df.schema} == types
    places = [list(twin.columns).index(c) for c in columns]
    want = sorted((tuple(r[p] for p in places) for r in twin.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in rows), key=repr) == want


def layout(inputs, name, users, obs):
    return encode_layout(
        users, obs, inputs.stats, LAYOUTS[name](inputs.catalogues), change_stats=inputs.change_stats
    )


def test_a_layout_takes_two_shuffles_of_the_observations(inputs):
    users, obs = inputs.tables
    plan = plan_of(layout(inputs, "year_and_half", users, obs))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    shapes = sorted(re.sub(r"#\d+L?", "", k).rsplit(", ", 1)[0] for k in keys)
    assert shapes == ["gathered_user", "user", "user, field_id"]
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", ["three_seasons", "year_and_half", "linear"])
def test_bucketed_inputs_need_no_shuffle(spark, inputs, tmp_path, name):
    users, obs = inputs.tables
    sinks.write_bucketed(users, f"users_{name}", 4, str(tmp_path / "users"))
    sinks.write_bucketed(obs, f"obs_{name}", 4, str(tmp_path / "obs"))
    encoded = layout(inputs, name, spark.table(f"users_{name}"), spark.table(f"obs_{name}"))
    plan = plan_of(encoded)
    assert "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan
    key = lambda r: r["user"]
    assert sorted(encoded.collect(), key=key) == sorted(layout(inputs, name, users, obs).collect(), key=key)


def test_filters_and_columns_reach_the_scan(inputs):
    users, obs = inputs.tables
    plan = plan_of(layout(inputs, "one_season", users, obs))
    assert "LessThanOrEqual(dist,3)" in plan
    assert "In(field_id, [" in plan
    presence = plan_of(statistics.category_values(obs, 19))
    assert "ReadSchema: struct<field_id:int,value:double>" in presence
    assert "EqualTo(field_id,19)" in presence


def test_large_catalogues_are_shuffled_not_broadcast(spark, inputs):
    users, obs = inputs.tables
    blocks = LAYOUTS["half_year"](inputs.catalogues)
    small = layout(inputs, "half_year", users, obs)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        large = encode_layout(users, obs, inputs.stats, blocks)
        assert "BroadcastHashJoin" not in plan_of(large)
        key = lambda r: r["user"]
        assert sorted(large.collect(), key=key) == sorted(small.collect(), key=key)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_one_user_with_a_third_of_the_rows(inputs):
    """Repeats of one user's observations collapse before the shuffle and change nothing but means."""
    users, obs = inputs.tables
    hot = obs.groupBy("user").count().orderBy(F.desc("count"), "user").first()["user"]
    copies = max(1, obs.count() // (2 * obs.filter(F.col("user") == hot).count()))
    repeated = obs.unionByName(
        obs.filter(F.col("user") == hot).withColumn("c", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("c")
    )
    key = lambda r: r["user"]
    for name in ("one_season", "linear"):
        once = encode_layout(users, obs, inputs.stats, LAYOUTS[name](inputs.catalogues), inputs.change_stats)
        again = encode_layout(users, repeated, inputs.stats, LAYOUTS[name](inputs.catalogues), inputs.change_stats)
        assert sorted(again.collect(), key=key) == sorted(once.collect(), key=key)


def without_broadcasts(spark, build) -> str:
    """The plan that ``build`` gives when no side counts as small."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan_of(build())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_merging_for_training_shuffles_the_actions_once(spark, inputs):
    actions = scratch.materialise(inputs.untidy_actions)
    labels = scratch.materialise(inputs.untidy_labels)
    plan = without_broadcasts(spark, lambda: merge.merge_training(labels, actions)[1])
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert [re.sub(r"#\d+L?", "", k).rsplit(", ", 1)[0] for k in keys] == ["user", "user"]  # actions, labels
    months = plan.index("<= 12")
    assert months > plan.index("Aggregate")  # filtered below the grouping


def test_excluding_users_leaves_the_observations_alone(spark, inputs):
    users, obs = inputs.tables
    excluded = scratch.materialise(inputs.excluded)
    blocks = LAYOUTS["half_year"](inputs.catalogues)
    shuffles = []
    for listed in (None, excluded):
        plan = without_broadcasts(spark, lambda: encode_layout(users, obs, inputs.stats, blocks, excluded=listed))  # noqa: B023
        shuffles.append(len(re.findall(r"Exchange hashpartitioning", plan)))
        assert plan.count("LeftAnti") == (0 if listed is None else 1)
    assert shuffles[1] <= shuffles[0] + 2  # the users and the list, once each


def test_pairs_are_not_made_in_one_task(spark, inputs):
    plan = plan_of(selection.pair_candidates(inputs.field_importance, 9))
    assert plan.index("Generate explode") < plan.index("Exchange hashpartitioning") < plan.index("Exchange SinglePartition")


def test_scratch_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    used = scratch.scratch_folder(spark)
    assert used.endswith(spark.sparkContext.applicationId)
    if folder:
        assert used.startswith(folder.rstrip("/"))
    table = scratch.materialise(spark.range(3).toDF("n"))
    assert table.inputFiles()[0].removeprefix("file://").startswith(used.removeprefix("file://"))


def test_only_local_sessions_may_lack_the_shared_folder():
    def session(master, folder=None):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: folder),
            sparkContext=SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: None),
        )

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_folder(session("yarn"))
    assert scratch.scratch_folder(session("yarn", "hdfs:///shared/")) == "hdfs:///shared/app-1"
    local = scratch.scratch_folder(session("local[2]"))
    assert Path(local).is_dir() and local == scratch.scratch_folder(session("local[2]"))
