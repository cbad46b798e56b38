"""Blending, scoring and comparing prediction tables ``(user_id, ovd_rate)``.

Predictions are matched by user, never by position. Ranks come from running totals over the
distinct scores, so no task ever sorts all rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.functions.scaling import required
from monthloom.operators.ranking import running_totals
from monthloom.sources.scratch import materialise
from monthloom.sources.workers import ship

WINDOW_WEIGHTS = (0.25, 0.25, 0.25, 0.25)
MODEL_WEIGHTS = (0.2, 0.8)
# Fixed value: equal-count parts per optimised bin between which cuts are tried.
CLUMPS = 15
# Cells of grids that a task holds at once.
TASK_CELLS = 2_000_000
GRIDS = "axis string, bins bigint, levels bigint, score double"
CELLS = pa.schema(
    [("axis", pa.string()), *[(c, pa.int64()) for c in ("levels", "users", "most")], ("cells", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))]
)


def blend(predictions: Sequence[DataFrame], weights: Sequence[float], complete: bool = True) -> DataFrame:
    """Weighted sum of every user's scores, one from each table.

    A user who is missing from a table or repeated in one fails the query. With ``complete=False``
    users missing from a table are left out instead.
    """
    if len(predictions) != len(weights):
        raise ValueError("one weight per prediction table")
    tables = [
        p.select("user_id", F.lit(i).alias("table"), "ovd_rate") for i, p in enumerate(predictions)
    ]
    own = [F.col("table") == i for i in range(len(tables))]
    by_user = reduce(DataFrame.unionByName, tables).groupBy("user_id").agg(
        *[F.count(F.when(o, 1)).alias(f"n{i}") for i, o in enumerate(own)],
        *[F.max(F.when(o, F.col("ovd_rate"))).alias(f"score{i}") for i, o in enumerate(own)],
    )
    counts = [F.col(f"n{i}") for i in range(len(tables))]
    if not complete:
        by_user = by_user.filter(F.least(*counts, F.lit(1)) > 0)
    score = sum((F.col(f"score{i}") * w for i, w in enumerate(weights)), F.lit(0.0))
    message = F.concat(F.lit("not exactly one score in every table: "), F.col("user_id").cast("string"))
    once = (F.least(*counts, F.lit(1)) == 1) & (F.greatest(*counts, F.lit(1)) == 1)
    return by_user.select("user_id", required(score, once, message).alias("ovd_rate"))


def blend_windows(predictions: Sequence[DataFrame]) -> DataFrame:
    """The four windows in equal parts."""
    return blend(predictions, WINDOW_WEIGHTS)


def blend_models(second: DataFrame, first: DataFrame) -> DataFrame:
    """One part of the two-window model to four parts of the blended windows."""
    return blend([second, first], MODEL_WEIGHTS)


def auc(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Area under the ROC curve in one row; tied scores count half."""
    joined = predictions.join(truth.select("user_id", "label"), "user_id")
    label = F.col("label").cast("bigint")
    counts = joined.groupBy("ovd_rate").agg(F.sum(label).alias("pos"), F.sum(1 - label).alias("neg"))
    ranked = running_totals(counts, [], "ovd_rate", ["neg"])
    won = F.sum(F.col("pos").cast("double") * (F.col("before_neg") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(won, pairs).alias("auc"))


def _below(pairs: DataFrame, axis: str) -> DataFrame:
    """Per distinct score of one axis, the number of users scoring less and the number of all."""
    counts = pairs.groupBy(axis).agg(F.sum("n").alias("n"))
    ranked = running_totals(counts, [], axis, ["n"])
    return ranked.select(axis, F.col("before_n").alias(f"{axis}_below"), F.col("all_n").alias("users"))


def _grid_cells(placed: DataFrame, users: int, allowed: int, numbers: list[int], rows: int, x_first: bool) -> DataFrame:
    """``(a, b, cells)``, the sum of ``n * ln(n)`` over the cells of every grid with fewer bins on the first axis, or as many.

    The pairs are reduced to the bins of that axis first. A task then makes the grids of one number of bins there and a run of
    numbers on the other axis, and holds at most some ``TASK_CELLS`` cells at once, however many users there are.
    """
    own, other, few, many = ("x_below", "y_below", "a", "b") if x_first else ("y_below", "x_below", "b", "a")
    bin_of = lambda below, bins: F.floor(F.col(below) * F.col(bins) / users)
    run = max(1, TASK_CELLS // min(allowed, rows))
    plan = []  # runs of numbers on the second axis as places in the list; equal numbers belong to the first pass
    for k in (k for k in numbers if k * k <= allowed):
        start, end = (bisect_left if x_first else bisect_right)(numbers, k), bisect_right(numbers, allowed // k)
        plan += [(k, i, i + 1, min(run, end - i)) for i in range(start, end, run)]
    if not plan:
        return placed.sparkSession.createDataFrame([], "a bigint, b bigint, cells double")
    runs = materialise(placed.sparkSession.createDataFrame(plan, "few bigint, run int, start int, length int").coalesce(1))
    each = placed.withColumn("few", F.explode(F.lit(sorted({few for few, *_ in plan})).cast("array<bigint>")))
    narrow = each.groupBy("few", bin_of(own, "few").alias("bin"), other).agg(F.sum("n").alias("n"))
    spread = narrow.join(runs, "few").repartition(len(plan), "few", "run")
    some = F.slice(F.lit(numbers).cast("array<bigint>"), F.col("start"), F.col("length"))
    grids = spread.select("few", "run", "bin", other, "n", F.explode(some).alias("many"))
    cells = grids.groupBy("few", "run", "many", "bin", bin_of(other, "many").alias("cell")).agg(F.sum("n").alias("n"))
    summed = cells.groupBy("few", "run", "many").agg(F.sum(_xlogx("n")).alias("cells"))
    return summed.select(F.col("few").alias(few), F.col("many").alias(many), "cells").select("a", "b", "cells")


def _xlogx(n: str) -> Column:
    return F.col(n) * F.log(F.col(n).cast("double"))


def _axis_bins(placed: DataFrame, users: int, numbers: list[int], below: str, name: str) -> DataFrame:
    """Per number of bins of one axis, the sum of ``n * ln(n)`` over its bins."""
    scores = placed.groupBy(below).agg(F.sum("n").alias("n"))
    each = scores.withColumn(name, F.explode(F.lit(numbers).cast("array<bigint>")))
    bins = each.groupBy(name, F.floor(F.col(below) * F.col(name) / users).alias("bin")).agg(F.sum("n").alias("n"))
    return bins.groupBy(name).agg(F.sum(_xlogx("n")).alias(f"of_{name}"))


def grid_scores(
    first: DataFrame, second: DataFrame, exponent: float = 0.6, axis: Sequence[int] | None = None
) -> DataFrame:
    """Normalised mutual information of two score columns on every equal-count grid.

    Grids have from 2 bins per axis on and at most ``users ** exponent`` cells. Bins come from the
    number of lower scores, so tied users share a bin. The work is at most distinct pairs of scores times grids; ``axis`` names
    the numbers of bins to try instead of all, for tables where that is too much. The sums over columns and rows belong to a
    number of bins, not to a grid, so only the cells are counted per grid.
    """
    joined = first.select("user_id", F.col("ovd_rate").alias("x")).join(
        second.select("user_id", F.col("ovd_rate").alias("y")), "user_id"
    )
    pairs = materialise(joined.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")))
    placed = materialise(pairs.join(_below(pairs, "x"), "x").join(_below(pairs, "y").drop("users"), "y").select("x_below", "y_below", "n"))
    rows, users, allowed = placed.agg(  # three numbers
        F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.floor(F.pow(F.coalesce(F.sum("n"), F.lit(0)).cast("double"), F.lit(exponent)))
    ).head()
    numbers = [k for k in (range(2, allowed // 2 + 1) if axis is None else sorted(set(axis))) if 2 <= k <= allowed // 2]
    if not numbers:
        return placed.sparkSession.createDataFrame([], "a bigint, b bigint, score double")
    cells = reduce(DataFrame.unionByName, [_grid_cells(placed, users, allowed, numbers, rows, x_first) for x_first in (True, False)])
    of_a, of_b = (materialise(_axis_bins(placed, users, numbers, below, name)) for below, name in (("x_below", "a"), ("y_below", "b")))
    gain = (F.col("cells") - F.col("of_a") - F.col("of_b")) / users + F.log(F.lit(float(users)))
    smaller = F.log(F.least("a", "b").cast("double"))
    return cells.join(of_a, "a").join(of_b, "b").select("a", "b", (F.greatest(gain, F.lit(0.0)) / smaller).alias("score"))


def best_cuts(cells: np.ndarray, most: int) -> np.ndarray:
    """The largest sum of ``cell * ln(cell / column)`` with 1, 2 ... ``most`` columns made of neighbouring ones.

    ``cells`` has a row per run of scores in order and a column per bin of the other axis. Dynamic
    programming over the runs' boundaries.
    """
    alone = (cells > 0).sum(axis=1) == 1
    where = cells.argmax(axis=1)
    joins = np.r_[False, alone[1:] & alone[:-1] & (where[1:] == where[:-1])]  # a cut inside such a run gains nothing
    upto = np.vstack([np.zeros(cells.shape[1], np.int64), np.cumsum(cells, axis=0)[np.r_[~joins[1:], True]]])
    runs = len(upto) - 1
    plain = lambda n: n * np.log(np.maximum(n, 1))
    gain = np.full((runs + 1, runs + 1), -np.inf)  # of one column from a boundary to a later one
    for end in range(1, runs + 1):
        between = upto[end] - upto[:end]
        gain[:end, end] = plain(between).sum(axis=1) - plain(between.sum(axis=1))
    found = [gain[0]]
    for _ in range(1, min(most, runs)):
        found.append((found[-1][:, None] + gain).max(axis=0))
    best = np.maximum.accumulate([f[runs] for f in found])
    return np.r_[best, np.full(max(0, most - len(best)), best[-1])]


def _cut(keys: tuple, table: pa.Table) -> pa.Table:
    """``GRIDS`` rows of one axis and one number of equal-count bins on the other."""
    users, most = table.column("users")[0].as_py(), table.column("most")[0].as_py()
    levels = keys[1].as_py()
    code = np.concatenate([c.values.to_numpy() for c in table.column("cells").combine_chunks()])
    n = np.concatenate([c.values.to_numpy() for c in table.column("n").combine_chunks()])
    _, place = np.unique(code // levels, return_inverse=True)
    _, level = np.unique(code % levels, return_inverse=True)
    cells = np.zeros((place.max() + 1, level.max() + 1), np.int64)
    np.add.at(cells, (place, level), n)
    rows = cells.sum(axis=0)
    whole = users * np.log(users) - (rows * np.log(rows)).sum()
    bins = np.arange(2, most + 1)
    score = (best_cuts(cells, most)[1:] + whole) / users / np.log(np.minimum(bins, levels))
    columns = [pa.array([keys[0].as_py()] * len(bins)), pa.array(bins, pa.int64()), pa.array([levels] * len(bins), pa.int64()), pa.array(score)]
    return pa.Table.from_arrays(columns, ["axis", "bins", "levels", "score"])


def optimised_grids(first: DataFrame, second: DataFrame, exponent: float = 0.6, clumps: int | None = CLUMPS) -> DataFrame:
    """``(axis, bins, levels, score)``: normalised mutual information with the best bins on one axis.

    The other axis has ``levels`` equal-count bins, and ``bins`` times ``levels`` is at most ``users ** exponent``.
    Cuts lie between distinct scores; with ``clumps`` only between that many equal-count parts per bin, which
    bounds a task's table by ``clumps * users ** exponent`` cells. Users are counted into distinct pairs of
    scores first, and those only are taken once per number of levels.
    """
    joined = first.select("user_id", F.col("ovd_rate").alias("x")).join(second.select("user_id", F.col("ovd_rate").alias("y")), "user_id")
    pairs = materialise(joined.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")))
    placed = pairs.join(_below(pairs, "x"), "x").join(_below(pairs, "y").drop("users"), "y")
    allowed = F.floor(F.pow(F.col("users"), F.lit(exponent)))
    counted = placed.withColumn("allowed", allowed).filter("allowed >= 4").select("n", "users", "allowed", "x_below", "y_below")

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, users, allowed, x, y = (batch.column(i).to_numpy() for i in range(5))
            if not len(n):
                continue
            rows, total, most = [], int(users[0]), int(allowed[0])
            for axis, own, other in (("x", x, y), ("y", y, x)):
                for levels in range(2, most // 2 + 1):
                    place = own if clumps is None else own * (most // levels * clumps) // total
                    code, at = np.unique(place * levels + other * levels // total, return_inverse=True)
                    rows.append((axis, levels, total, most // levels, code, np.bincount(at, n).astype(np.int64)))
            yield pa.RecordBatch.from_pylist([dict(zip(CELLS.names, row, strict=True)) for row in rows], CELLS)

    ship(counted.sparkSession)
    cells = counted.mapInArrow(cells_of, "axis string, levels bigint, users bigint, most bigint, cells array<bigint>, n array<bigint>")
    return cells.groupBy("axis", "levels").applyInArrow(_cut, GRIDS)


def grid_association(first: DataFrame, second: DataFrame, exponent: float = 0.6, clumps: int | None = CLUMPS) -> DataFrame:
    """The best score of any optimised grid in one row; 0 when there are too few users for a grid."""
    best = optimised_grids(first, second, exponent, clumps).agg(F.max("score").alias("best"))
    return best.select(F.coalesce("best", F.lit(0.0)).alias("association"))


def correlation(first: DataFrame, second: DataFrame) -> DataFrame:
    """Linear correlation of two score columns in one row."""
    joined = first.select("user_id", F.col("ovd_rate").alias("x")).join(
        second.select("user_id", F.col("ovd_rate").alias("y")), "user_id"
    )
    return joined.agg(F.corr("x", "y").alias("correlation"))
