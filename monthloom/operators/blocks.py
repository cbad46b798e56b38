"""Feature blocks over field values: each returns ``(user, idx, value)`` with zero-based ``idx``.

A block sees the months of window ``k`` and merges them per (user, field) with ``agg``, any
aggregate that skips nulls. Catalogues and statistics are small tables; read from files or
materialised, Spark broadcasts them after checking their size and shuffles when they are large.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthloom.functions.scaling import (
    BINS,
    clamp,
    five_bin,
    log_product,
    min_max,
    ratio_or_zero,
    required,
    share_of,
    soft_sign,
    steady_sum,
)
from monthloom.operators.statistics import max_change
from monthloom.schema import in_window

Aggregate = Callable[[Column], Column]


def known_range(value: Column) -> Column:
    """``value`` of a field that has statistics; a field without them fails the query."""
    message = F.concat(F.lit("no statistics for field "), F.col("field_id").cast("string"))
    return required(value, F.col("lo").isNotNull(), message)


def scaled(value: Column) -> Column:
    return min_max(value, F.col("lo"), F.col("hi"))


def merged(obs: DataFrame, fields: DataFrame, k: int, agg: Aggregate) -> DataFrame:
    """One value ``x`` per (user, field) of the listed fields in window ``k``."""
    kept = obs.filter(in_window(k)).join(fields.select("field_id"), "field_id", "left_semi")
    return kept.groupBy("user", "field_id").agg(agg(F.col("value")).alias("x"))


def clamped(
    obs: DataFrame,
    fields: DataFrame,
    stats: DataFrame,
    k: int,
    agg: Aggregate,
    on_missing_stats: str,
) -> DataFrame:
    """:func:`merged` trimmed to each field's range, with ``lo`` and ``hi`` at hand."""
    if on_missing_stats not in ("error", "drop"):
        raise ValueError(f"on_missing_stats must be 'error' or 'drop', not {on_missing_stats!r}")
    strict = on_missing_stats == "error"
    ranges = stats.select("field_id", "lo", "hi")
    rows = merged(obs, fields, k, agg).join(ranges, "field_id", "left" if strict else "inner")
    value = clamp(F.col("x"), F.col("lo"), F.col("hi"))
    return rows.withColumn("x", known_range(value) if strict else value)


def _indexed(rows: DataFrame, fields: DataFrame) -> DataFrame:
    return rows.join(fields.select("field_id", "idx"), "field_id")


def _values(rows: DataFrame, value: Column) -> DataFrame:
    return rows.select("user", F.col("idx").cast("int").alias("idx"), value.alias("value"))


def _one_hot(rows: DataFrame, value: Column) -> DataFrame:
    place = F.col("idx").cast("int") * BINS + five_bin(value)
    return rows.select("user", place.alias("idx"), F.lit(1.0).alias("value"))


def tree_block(
    obs: DataFrame,
    fields: DataFrame,
    stats: DataFrame,
    k: int = 0,
    agg: Aggregate = F.avg,
    on_missing_stats: str = "error",
) -> DataFrame:
    """Merged and trimmed value of each field."""
    rows = clamped(obs, fields, stats, k, agg, on_missing_stats)
    return _values(_indexed(rows, fields), F.col("x"))


def onehot_block(
    obs: DataFrame,
    fields: DataFrame,
    stats: DataFrame,
    k: int = 0,
    agg: Aggregate = F.avg,
    on_missing_stats: str = "error",
) -> DataFrame:
    """Bin of each field's scaled value."""
    rows = clamped(obs, fields, stats, k, agg, on_missing_stats)
    return _one_hot(_indexed(rows, fields), scaled(F.col("x")))


def _shares(rows: DataFrame, nan_policy: str) -> DataFrame:
    total = steady_sum(F.col("x"), lambda c: F.sum(c).over(Window.partitionBy("user")))
    shares = rows.withColumn("share", share_of(F.col("x"), total, nan_policy))
    return shares.filter(F.col("share").isNotNull())


def tree_rate(
    obs: DataFrame,
    group: DataFrame,
    fields: DataFrame,
    stats: DataFrame,
    k: int = 0,
    agg: Aggregate = F.avg,
    nan_policy: str = "drop",
) -> DataFrame:
    """Share of each catalogued field in the user's total over the whole ``group``."""
    rows = clamped(obs, group, stats, k, agg, "drop")
    return _values(_indexed(_shares(rows, nan_policy), fields), F.col("share"))


def onehot_rate(
    obs: DataFrame,
    fields: DataFrame,
    stats: DataFrame,
    k: int = 0,
    agg: Aggregate = F.avg,
    nan_policy: str = "drop",
) -> DataFrame:
    """Bin of each field's share in the user's total over the catalogue."""
    rows = clamped(obs, fields, stats, k, agg, "drop")
    return _one_hot(_indexed(_shares(rows, nan_policy), fields), F.col("share"))


def onehot_topn_rate(
    obs: DataFrame,
    fields: DataFrame,
    stats: DataFrame,
    k: int = 0,
    n: int = 10,
    agg: Aggregate = F.avg,
    nan_policy: str = "drop",
) -> DataFrame:
    """:func:`onehot_rate` among the user's ``n`` largest values; ties go to the smaller id."""
    rows = clamped(obs, fields, stats, k, agg, "error")
    largest = Window.partitionBy("user").orderBy(F.desc("x"), "field_id")
    rows = rows.withColumn("rank", F.row_number().over(largest)).filter(F.col("rank") <= n)
    return _one_hot(_indexed(_shares(rows, nan_policy), fields), F.col("share"))


def pair_sides(pairs: DataFrame, met: Column | None = None) -> DataFrame:
    """Each pair as two rows, one per member: ``(field_id, idx, side)``.

    Where ``met`` does not hold, the pair keeps its number but names no fields.
    """
    left, right = F.col("left_id"), F.col("right_id")
    if met is not None:
        left, right = F.when(met, left), F.when(met, right)
    sides = F.array(
        F.struct(left.alias("field_id"), F.lit(0).alias("side")),
        F.struct(right.alias("field_id"), F.lit(1).alias("side")),
    )
    return pairs.select("idx", F.inline(sides))


def _paired(values: DataFrame, pairs: DataFrame) -> DataFrame:
    """``left`` and ``right`` of every catalogued pair a user has both fields of.

    Each value goes only to the pairs that name its field, so the rows follow the catalogue and
    never the number of field combinations of a user.
    """
    sides = values.join(pair_sides(pairs), "field_id")
    both = sides.groupBy("user", "idx").agg(
        F.max(F.when(F.col("side") == 0, F.col("x"))).alias("left"),
        F.max(F.when(F.col("side") == 1, F.col("x"))).alias("right"),
    )
    return both.filter(F.col("left").isNotNull() & F.col("right").isNotNull())


def _members(pairs: DataFrame) -> DataFrame:
    return pair_sides(pairs).select("field_id").distinct()


def ascending(pairs: DataFrame) -> DataFrame:
    """Pairs a log block can meet: it only looks up the smaller id first."""
    return pairs.filter(F.col("left_id") < F.col("right_id"))


def distinct_sides(pairs: DataFrame) -> DataFrame:
    """Pairs a ratio block can meet: two different fields, in either order."""
    return pairs.filter(F.col("left_id") != F.col("right_id"))


def tree_log_pair(
    obs: DataFrame, pairs: DataFrame, stats: DataFrame, k: int = 0, agg: Aggregate = F.avg
) -> DataFrame:
    """Log of the product of both trimmed values."""
    rows = clamped(obs, _members(pairs), stats, k, agg, "error")
    return _values(_paired(rows, ascending(pairs)), log_product(F.col("left"), F.col("right")))


def _scaled_members(obs, pairs, stats, k, agg) -> DataFrame:
    rows = clamped(obs, _members(pairs), stats, k, agg, "error")
    return rows.withColumn("x", scaled(F.col("x")))


def onehot_log_pair(
    obs: DataFrame, pairs: DataFrame, stats: DataFrame, k: int = 0, agg: Aggregate = F.avg
) -> DataFrame:
    """Bin of the log of the product of both scaled values."""
    rows = _paired(_scaled_members(obs, pairs, stats, k, agg), ascending(pairs))
    return _one_hot(rows, log_product(F.col("left"), F.col("right")))


def onehot_ratio_pair(
    obs: DataFrame, pairs: DataFrame, stats: DataFrame, k: int = 0, agg: Aggregate = F.avg
) -> DataFrame:
    """Bin of the softened ratio of the scaled values, left over right."""
    rows = _paired(_scaled_members(obs, pairs, stats, k, agg), distinct_sides(pairs))
    return _one_hot(rows, soft_sign(ratio_or_zero(F.col("left"), F.col("right"))))


def tree_max_change(obs: DataFrame, fields: DataFrame, k: int = 0) -> DataFrame:
    """Largest less smallest value in the window, as it is."""
    return _values(_indexed(merged(obs, fields, k, max_change), fields), F.col("x"))


def onehot_max_change(
    obs: DataFrame, fields: DataFrame, change_stats: DataFrame, k: int = 0
) -> DataFrame:
    """Bin of the scaled change; fields without change statistics are left out."""
    rows = clamped(obs, fields, change_stats, k, max_change, "drop")
    return _one_hot(_indexed(rows, fields), scaled(F.col("x")))
