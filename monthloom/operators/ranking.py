"""Running totals and order statistics that never put a whole group into one task.

A window over a hot group sorts all its rows in a single task. Here the distinct values are
counted first, spread by range over the cluster, and each range adds the total of the ranges
before it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthloom.schema import HIGH_QUANTILE, LOW_QUANTILE
from monthloom.sources.scratch import materialise

ACCURACY = 1000
Wanted = tuple[float, Callable[[Column], Column]]


def running_totals(
    counts: DataFrame,
    keys: list[str],
    by: str,
    measures: list[str],
    positions: Callable[[Column], list[Column]] | None = None,
) -> DataFrame:
    """Totals of ``measures`` over the rows of the same ``keys`` with a smaller ``by``.

    ``counts`` holds one row per (keys, by). Adds ``before_<m>`` and ``all_<m>`` per measure.

    With ``positions``, given the whole total of the first measure, only ranges that hold one of
    them are ranked and returned.

    The ranged rows are written out first: range bounds come from a sample, so both uses below
    must read one and the same split.
    """
    ranged = materialise(
        counts.repartitionByRange(*keys, by).withColumn("chunk", F.spark_partition_id())
    )
    # One row per (keys, chunk): a range is contiguous, so at most keys + partitions rows.
    chunks = ranged.groupBy(*keys, "chunk").agg(*[F.sum(m).alias(f"chunk_{m}") for m in measures])
    order = Window.partitionBy(*keys).orderBy("chunk")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = chunks.select(
        *keys,
        "chunk",
        *[F.coalesce(F.sum(f"chunk_{m}").over(earlier), F.lit(0)).alias(f"offset_{m}") for m in measures],
        *[F.sum(f"chunk_{m}").over(whole).alias(f"all_{m}") for m in measures],
        *[f"chunk_{m}" for m in measures],
    )
    if positions is not None:
        start, length = F.col(f"offset_{measures[0]}"), F.col(f"chunk_{measures[0]}")
        holds = [(start <= p) & (p < start + length) for p in positions(F.col(f"all_{measures[0]}"))]
        offsets = offsets.filter(reduce(Column.__or__, holds))
    inside = (
        Window.partitionBy(*keys, "chunk").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = ranged.join(offsets, [*keys, "chunk"]).select(
        "*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"inside_{m}") for m in measures]
    )
    return joined.select(
        *counts.columns,
        *[(F.col(f"offset_{m}") + F.col(f"inside_{m}")).alias(f"before_{m}") for m in measures],
        *[f"all_{m}" for m in measures],
    )


def _exact(values: DataFrame, key: str, value: str, wanted: list[Wanted]) -> DataFrame:
    """``(key, which, value)`` by ranking every distinct value."""
    own = F.struct(F.col(key).alias("key")).alias("own")  # never null, even where the key is
    counts = values.groupBy(own, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, ["own"], value, ["n"], lambda n: [position(n) for _, position in wanted])
    at = F.array(*[F.when((F.col("before_n") <= position(F.col("all_n"))) & (position(F.col("all_n")) < F.col("before_n") + F.col("n")), i) for i, (_, position) in enumerate(wanted)])
    return ranked.select(F.col("own.key").alias(key), F.explode(F.array_compact(at)).alias("which"), value)


def _inside(stored: DataFrame, brackets: DataFrame, key: str, value: str) -> DataFrame:
    """Counts per bracket and value inside it; null, which sorts first, counts what lies below."""
    near = stored.join(brackets, F.col(key).eqNullSafe(F.col("of_key"))).filter(F.col(value) <= F.col("high"))
    inside = F.when(F.col(value) >= F.col("low"), F.col(value)).alias("inside")
    return near.groupBy("of_key", "which", "position", inside).agg(F.count(F.lit(1)).alias("n"))


def at_positions(values: DataFrame, key: str, value: str, wanted: list[Wanted], accuracy: int = ACCURACY) -> DataFrame:
    """``(key, which, value)``: per key, the value at each wanted zero-based position in ascending order.

    A position is a function of the key's number of rows, ``wanted`` beside the share of rows before it. A
    mergeable sketch per key brackets each position between two values; what lies below a bracket is one
    number, and only the values inside, some ``6 / accuracy`` of all, are counted, shuffled and ranked. A bracket that
    turns out not to hold its position is replaced by ranking all of its key. Values must not be null.
    """
    stored = materialise(values.select(key, value))
    reach = [(max(0.0, p - 3 / accuracy), min(1.0, p + 3 / accuracy)) for p, _ in wanted]
    sketch = F.percentile_approx(value, F.array(*[F.lit(float(x)) for pair in reach for x in pair]), F.lit(accuracy))
    sketched = stored.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), sketch.alias("edges"), F.min(value).alias("least"), F.max(value).alias("most"))

    def bracket(i: int) -> Column:
        low = F.col("least") if reach[i][0] == 0 else F.get("edges", F.lit(2 * i))
        high = F.col("most") if reach[i][1] == 1 else F.get("edges", F.lit(2 * i + 1))
        return F.struct(F.lit(i).alias("which"), wanted[i][1](F.col("rows")).cast("bigint").alias("position"), low.alias("low"), high.alias("high"))

    brackets = materialise(sketched.select(F.col(key).alias("of_key"), F.inline(F.array(*[bracket(i) for i in range(len(wanted))]))))
    counts = _inside(stored, brackets, key, value)
    # A window sorts what is inside one bracket, never a whole key.
    upto = F.sum("n").over(Window.partitionBy("of_key", "which").orderBy("inside"))
    ranked = counts.select("*", upto.alias("upto")).filter((F.col("upto") - F.col("n") <= F.col("position")) & (F.col("position") < F.col("upto")))
    here = ranked.select(F.col("of_key").alias("k"), F.col("which").alias("w"), F.col("inside").alias(value))
    found = materialise(brackets.join(here, F.col("of_key").eqNullSafe(F.col("k")) & (F.col("which") == F.col("w")), "left").select(F.col("of_key").alias(key), "which", value))
    missed = found.filter(F.col(value).isNull()).select(F.col(key).alias("missed")).distinct()
    if missed.isEmpty():
        return found
    again = materialise(missed)
    rest = stored.join(again, F.col(key).eqNullSafe(F.col("missed")), "left_semi")
    return found.join(again, F.col(key).eqNullSafe(F.col("missed")), "left_anti").unionByName(_exact(rest, key, value, wanted))


def order_statistics(
    values: DataFrame,
    key: str,
    value: str,
    low: float = LOW_QUANTILE,
    high: float = HIGH_QUANTILE,
) -> DataFrame:
    """Per key, the values at zero-based positions floor(n * low) and floor(n * high)."""
    found = at_positions(values, key, value, [(q, lambda n, q=q: F.floor(n * F.lit(q))) for q in (low, high)])
    at = [F.max(F.when(F.col("which") == i, F.col(value))).alias(name) for i, name in enumerate(("lo", "hi"))]
    return found.groupBy(key).agg(*at)


def medians(values: DataFrame, key: str, value: str) -> DataFrame:
    """Per key, ``median``: the mean of the two middle values."""
    found = at_positions(values, key, value, [(0.5, lambda n: F.floor((n - 1) / 2)), (0.5, lambda n: F.floor(n / 2))])
    return found.groupBy(key).agg((F.sum(value) / 2).alias("median"))
