"""Steps whose tasks must stay bounded as the tables grow."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import checks.queries as queries
from checks.queries import Inputs
from monthloom.operators import evaluation, model, statistics
from monthloom.sources.retail import retail_obs

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no order tables")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_task_reads_a_bounded_number_of_users(spark, monkeypatch):
    monkeypatch.setattr(queries, "BUCKET_USERS", 10)
    inputs = Inputs(spark, FOLDER)
    obs = inputs.stored[1]
    plan = plan_of(statistics.field_values(obs))
    assert "Exchange" not in plan and f"SelectedBucketsCount: {inputs.users.count() // 10 + 1}" in plan
    most = obs.groupBy(F.input_file_name()).agg(F.count_distinct("user").alias("n")).agg(F.max("n")).head()[0]
    assert most <= 30
    assert sorted(obs.collect()) == sorted(inputs.tables[1].collect())


def test_months_out_of_reach_leave_before_the_lines_are_joined(spark):
    plan = plan_of(retail_obs(spark, FOLDER, Inputs(spark, FOLDER).tables[0]))
    lines = plan.index("lineitem.parquet")
    assert re.search(r"<= 12", plan[lines:]) or plan.rindex("<= 12", 0, lines) > 0
    assert not re.search(r"<= 12", plan.split("Aggregate")[0])


def test_grids_are_spread_over_tasks_of_a_bounded_number_of_cells(spark, frame, monkeypatch):
    rng = random.Random(9)
    scores = [(i, rng.randrange(60) / 60, rng.randrange(40) / 40) for i in range(400)]
    first, second = (frame([(r[0], r[k]) for r in scores], "user_id bigint, ovd_rate double") for k in (1, 2))
    whole = {(r["a"], r["b"]): r["score"] for r in evaluation.grid_scores(first, second).collect()}
    monkeypatch.setattr(evaluation, "TASK_CELLS", 100)
    bounded = evaluation.grid_scores(first, second)
    plan = plan_of(bounded)
    assert plan.count("REPARTITION_BY_NUM") == 2 and "Window" not in plan
    assert {(r["a"], r["b"]): r["score"] for r in bounded.collect()} == pytest.approx(whole)
    allowed = int(400**0.6)
    assert set(whole) == {(a, b) for a in range(2, allowed // 2 + 1) for b in range(2, allowed // a + 1)}


def test_training_tasks_get_a_bounded_number_of_rows(frame, monkeypatch):
    monkeypatch.setattr(model, "TASK_ROWS", 10)
    seen = []
    monkeypatch.setattr(model.GBTClassifier, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()))
    model.train(frame([(str(i), i % 2) for i in range(200)], "user string, label int").coalesce(1), rounds=1)
    assert seen == [21]
