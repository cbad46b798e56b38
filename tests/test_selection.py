from __future__ import annotations

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from monthloom.operators import selection
from monthloom.schema import FIELD_GROUPS
from monthloom.sources import sinks, tables

FIELDS = "field_id int"
CATALOGUE = "field_id int, idx int"
SCORES = "feature_idx int, score double"
FIELD_SCORES = "field_id int, score double"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_candidates(frame):
    universe = frame([(i,) for i in range(1, 8)], FIELDS)
    excluded, important = frame([(2,), (3,), (5,)], FIELDS), frame([(3,)], FIELDS)
    got = rows(selection.candidate_fields(universe, excluded, important))
    assert got == [(1, 0), (3, 1), (4, 2), (6, 3), (7, 4)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7])
def test_pairs_follow_lexicographic_order(frame, n):
    ids = [3 * i + 1 for i in range(n)]
    scores = frame([(i, 9.0) for i in ids] + [(500, 8.0)], FIELD_SCORES)
    got = sorted(tuple(r) for r in selection.pair_candidates(scores).collect())
    assert got == [(a, b, i) for i, (a, b) in enumerate(combinations(ids, 2))]
    both = {(r["left_id"], r["right_id"]): r["idx"] for r in selection.ratio_pair_candidates(scores, n).collect()}
    best = sorted([*ids, 500], key=lambda f: (-(8.0 if f == 500 else 9.0), f))[:n]
    want = {}
    for i, (a, b) in enumerate(combinations(sorted(best), 2)):
        want[(a, b)], want[(b, a)] = 2 * i, 2 * i + 1
    assert both == want


def test_selected_pairs(frame):
    pairs = frame([(1, 2, 0), (1, 3, 1), (2, 3, 2)], "left_id int, right_id int, idx int")
    chosen = frame([(2,), (0,)], "feature_idx int")
    assert rows(selection.selected_pairs(pairs, chosen)) == [(1, 2, 0), (2, 3, 1)]


def test_selected_fields_and_base(frame):
    catalogue = frame([(10, 0), (20, 1), (30, 2)], CATALOGUE)
    assert rows(selection.selected_fields(catalogue, frame([(2, 1.0), (0, 5.0)], SCORES))) == [(10, 0), (30, 1)]
    assert rows(selection.selected_fields(catalogue, frame([(3, 1.0)], SCORES), base=1)) == [(30, 0)]


def test_shifted_importance(frame):
    assert rows(selection.shift_importance(frame([(435, 74.0)], SCORES), 429)) == [(6, 74.0)]


def test_split_halves(frame):
    catalogue = frame([(10, 0), (20, 1), (30, 2)], CATALOGUE)
    scores = frame([(1, 1.0), (3, 1.0), (4, 1.0), (6, 1.0), (7, 1.0)], SCORES)
    average, maximum = selection.split_halves(catalogue, scores, 3)
    assert rows(average) == [(10, 0), (30, 1)]
    assert rows(maximum) == [(10, 0), (30, 1)]
    longer = frame([(i * 10, i - 1) for i in range(1, 8)], CATALOGUE)
    _, bounded = selection.split_halves(longer, scores, 3)
    _, running_on = selection.split_halves(longer, scores, 3, bounded=False)
    assert rows(bounded) == [(10, 0), (30, 1)]
    assert rows(running_on) == [(10, 0), (30, 1), (40, 2)]


def test_every_fourth(frame):
    dictionary = frame([(i, 100 + i) for i in range(12)], "line int, field_id int")
    assert rows(selection.every_nth(dictionary, "line")) == [(102, 0), (106, 1), (110, 2)]


def test_continuous_only(frame):
    assert rows(selection.continuous_only(frame([(1, 0), (5, 1), (19, 2), (60, 3)], CATALOGUE))) == [(5, 0), (60, 1)]


def test_rate_lists(frame):
    install = frame([(96051,), (96055,)], FIELDS)
    universe = selection.rate_universe(install, frame([(i,) for i in range(131, 135)], FIELDS))
    assert rows(universe) == [(131, 0), (132, 1), (133, 2), (134, 3), (96051, 4), (96052, 6), (96055, 5), (96056, 7)]
    scored = selection.rate_fields(universe, frame([(2, 1.0), (5, 1.0), (8, 1.0)], SCORES))
    assert rows(scored) == [(132, 0), (96051, 1), (96056, 2)]
    split = sorted((r["group"], r["field_id"], r["idx"]) for r in selection.by_group(scored).collect())
    assert split == [("app_install", 96051, 0), ("app_open_time", 96056, 0), ("query_detail", 132, 0)]
    assert rows(selection.one_group(scored, FIELD_GROUPS[0])) == [(132, 0)]


def test_groups_do_not_overlap(spark):
    from pyspark.sql import functions as F

    hits = [g.contains().cast("int") for g in FIELD_GROUPS]
    counted = tables.field_range(spark, 1, 96116).select(sum(hits, F.lit(0)).alias("n"))
    assert counted.agg(F.max("n")).head()[0] == 1


def test_catalogue_files(spark, frame, tmp_path):
    path = lambda name: str(tmp_path / name)
    sinks.write_catalogue(frame([(6, 0), (8, 1)], CATALOGUE), path("fields"))
    assert rows(tables.read_catalogue(spark, path("fields"))) == [(6, 0), (8, 1)]
    assert rows(tables.read_field_set(spark, path("fields"))) == [(6,), (8,)]
    sinks.write_pairs(frame([(6, 31, 0), (8, 6, 1)], "left_id int, right_id int, idx int"), path("pairs"))
    pairs = tables.read_pairs(spark, path("pairs"))
    assert rows(pairs) == [(6, 31, 0), (8, 6, 1)]
    assert rows(tables.pair_members(pairs)) == [(6,), (8,), (31,)]
    (tmp_path / "scores").write_text("6,215\n17,166\n")
    assert rows(tables.read_importance(spark, path("scores"))) == [(6, 215.0), (17, 166.0)]
    (tmp_path / "tabbed").write_text("435\t74\n")
    assert rows(tables.read_importance(spark, path("tabbed"), "\t")) == [(435, 74.0)]
    (tmp_path / "out").write_text("u1\tx\nu2\n")
    assert rows(tables.read_users(spark, path("out"))) == [("u1",), ("u2",)]


def test_malformed_catalogue_fails(spark, tmp_path):
    (tmp_path / "bad").write_text("6\t0\nx\t1\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        tables.read_catalogue(spark, str(tmp_path / "bad")).collect()


@pytest.mark.parametrize("size", [2, 3, 7, 40])
def test_numbers_tell_pairs(spark, size):
    pairs = [(a, b) for a in range(size) for b in range(a + 1, size)]
    i, j = selection.pair_positions(F.col("id"), F.lit(size).cast("bigint"))
    found = spark.range(len(pairs)).select("id", i.alias("i"), j.alias("j")).orderBy("id").collect()
    assert [(r["i"], r["j"]) for r in found] == pairs


def test_numbers_of_a_large_list(spark):
    """First and last pairs of every position of a list whose pairs are never built."""
    size = 96_116
    first = F.expr(f"id * (2 * {size} - id - 1) div 2")
    last = F.expr(f"(id + 1) * (2 * {size} - id - 2) div 2 - 1")
    numbers = spark.range(size - 1).select("id", F.explode(F.array(first, last)).alias("number"))
    i, j = selection.pair_positions(F.col("number"), F.lit(size).cast("bigint"))
    bad = numbers.select("id", "number", i.alias("i"), j.alias("j"))
    wrong = bad.filter((F.col("i") != F.col("id")) | ~F.col("j").isin(0) & ((F.col("number") == first) & (F.col("j") != F.col("id") + 1) | (F.col("number") == last) & (F.col("j") != size - 1) & (first != last)))
    assert wrong.count() == 0


@pytest.mark.parametrize("both", [False, True])
def test_pairs_by_number_equal_the_built_pairs(spark, frame, both):
    fields = frame([(v, 10.0) for v in (70, 3, 9, 12, 55, 4)], "field_id int, score double")
    built = selection.ratio_pair_candidates(fields) if both else selection.pair_candidates(fields, 0)
    numbers = frame([(v,) for v in (14, 0, 3, 3, -1, 29, 30, 7, 999)], "feature_idx int")
    found = selection.pairs_by_number(fields.select("field_id"), numbers, both)
    key = lambda r: r["idx"]
    assert sorted(found.collect(), key=key) == sorted(selection.selected_pairs(built, numbers).collect(), key=key)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "Generate" not in plan and "explode" not in plan
    assert selection.pairs_by_number(fields.limit(0).select("field_id"), numbers).count() == 0
