"""Catalogues of fields and pairs, chosen from importance lists.

Field lists have at most one row per field id of the fixed universe, so their dense numbering may
use an unpartitioned window. Pair lists grow with the square of a field list: they are made from
spread-out fields and numbered through running totals, never in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthloom.operators.ranking import medians, running_totals
from monthloom.schema import FIELD_GROUPS, FieldGroup, is_category
from monthloom.sources.scratch import materialise


def numbered(fields: DataFrame, by: str = "field_id") -> DataFrame:
    """Zero-based dense index in ascending order."""
    return fields.withColumn("idx", F.row_number().over(Window.orderBy(by)) - 1)


def catalogue_of(fields: DataFrame) -> DataFrame:
    """Distinct ids as a catalogue."""
    return numbered(fields.select("field_id").distinct())


def shift_importance(importance: DataFrame, offset: int) -> DataFrame:
    """Field ids of an importance list whose feature numbers start ``offset`` above the ids."""
    return importance.select((F.col("feature_idx") - offset).alias("field_id"), "score")


def candidate_fields(universe: DataFrame, excluded: DataFrame, important: DataFrame) -> DataFrame:
    """The universe without the excluded ids, keeping those that are important."""
    banned = excluded.join(important, "field_id", "left_anti")
    return catalogue_of(universe.join(banned, "field_id", "left_anti"))


def at_least(importance: DataFrame, score: float) -> DataFrame:
    return importance.filter(F.col("score") >= score)


def top(importance: DataFrame, n: int = 100, by: str = "field_id") -> DataFrame:
    """The ``n`` best entries of an importance list."""
    return importance.orderBy(F.desc("score"), by).limit(n)


def _ordered_pairs(fields: DataFrame) -> DataFrame:
    """Every pair ``left < right`` of a selected list, numbered in lexicographic order.

    Each field lists the positions after its own and looks them up, which is an equi-join; the
    pair's number follows from the two positions.
    """
    ranked = catalogue_of(fields).withColumn("size", F.count(F.lit(1)).over(Window.partitionBy()))
    spread = ranked.repartition("field_id")  # before the rows multiply
    left = spread.filter(F.col("idx") < F.col("size") - 1).select(
        F.col("field_id").alias("left_id"),
        F.col("idx").alias("i"),
        "size",
        F.explode(F.sequence(F.col("idx") + 1, F.col("size") - 1)).alias("j"),
    )
    right = ranked.select(F.col("field_id").alias("right_id"), F.col("idx").cast("bigint").alias("j"))
    number = F.expr("i * size - i * (i + 1) div 2 + j - i - 1")
    return left.join(right, "j").select("left_id", "right_id", number.alias("idx"))


def pair_candidates(importance: DataFrame, score: float = 9) -> DataFrame:
    """All unordered pairs of the fields scoring at least ``score``."""
    return _ordered_pairs(at_least(importance, score))


def ratio_pair_candidates(importance: DataFrame, n: int = 100) -> DataFrame:
    """Both orders of every pair of the ``n`` best fields."""
    both = F.array(
        F.struct("left_id", "right_id", (F.col("idx") * 2).alias("idx")),
        F.struct(
            F.col("right_id").alias("left_id"),
            F.col("left_id").alias("right_id"),
            (F.col("idx") * 2 + 1).alias("idx"),
        ),
    )
    return _ordered_pairs(top(importance, n)).select(F.inline(both))


def pair_positions(number: Column, size: Column) -> tuple[Column, Column]:
    """The two positions behind a number of :func:`pair_candidates`, by inverting the triangular count.

    ``i`` starts ``i * (2 * size - i - 1) / 2`` pairs in. The root may be off by one, which the count corrects.
    """
    first = lambda i: F.floor(i * (2 * size - i - 1) / 2)
    root = F.sqrt((4 * size * (size - 1) - 8 * number - 7).cast("double"))
    near = (size - 2 - F.floor((root - 1) / 2)).cast("bigint")
    i = F.when(number < first(near), near - 1).when(number >= first(near + 1), near + 1).otherwise(near)
    return i, number - first(i) + i + 1


def pairs_by_number(fields: DataFrame, chosen: DataFrame, both_orders: bool = False) -> DataFrame:
    """The pairs of a selected list that the importance list names by number, renumbered in that order.

    No pair is built that is not chosen: a number tells its two positions. With ``both_orders`` numbers are those of
    :func:`ratio_pair_candidates`. Numbers beyond the last pair are left out.
    """
    ranked = materialise(catalogue_of(fields))  # a row per field
    size = ranked.agg(F.count(F.lit(1))).scalar()
    orders = 2 if both_orders else 1
    known = chosen.select(F.col("feature_idx").cast("bigint").alias("idx")).distinct().select("idx", size.alias("size"))
    known = known.filter((F.col("idx") >= 0) & (F.col("idx") < F.lit(orders) * F.expr("size * (size - 1) div 2")))
    i, j = pair_positions(F.expr(f"idx div {orders}"), F.col("size"))
    swapped = F.col("idx") % orders == 1
    placed = known.select("idx", F.when(swapped, j).otherwise(i).alias("i"), F.when(swapped, i).otherwise(j).alias("j"))
    left = ranked.select(F.col("field_id").alias("left_id"), F.col("idx").cast("bigint").alias("i"))
    right = ranked.select(F.col("field_id").alias("right_id"), F.col("idx").cast("bigint").alias("j"))
    found = placed.join(left, "i").join(right, "j").withColumn("n", F.lit(1))
    ordered = running_totals(found.select("left_id", "right_id", "idx", "n"), [], "idx", ["n"])
    return ordered.select("left_id", "right_id", F.col("before_n").cast("int").alias("idx"))


def selected_pairs(pairs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The pairs whose number was chosen by the importance list, renumbered in that order."""
    kept = pairs.join(chosen.select(F.col("feature_idx").alias("idx")), "idx", "left_semi")
    ranked = running_totals(kept.withColumn("n", F.lit(1)), [], "idx", ["n"])
    return ranked.select("left_id", "right_id", F.col("before_n").cast("int").alias("idx"))


def selected_fields(catalogue: DataFrame, importance: DataFrame, base: int = 0) -> DataFrame:
    """The catalogue's fields named by an importance list, renumbered.

    ``base`` is the feature number of index 0.
    """
    chosen = importance.select((F.col("feature_idx") - base).alias("idx")).distinct()
    return catalogue_of(catalogue.join(chosen, "idx", "left_semi"))


def split_halves(
    catalogue: DataFrame, importance: DataFrame, n: int, bounded: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Average and maximum catalogues from one list over both blocks.

    Features 1..n belong to the averages, n+1..2n to the maxima; ``bounded=False`` lets the second
    half run on.
    """
    idx = F.col("feature_idx")
    second = idx > n if not bounded else (idx > n) & (idx <= 2 * n)
    maxima = importance.filter(second).select((idx - n).alias("feature_idx"))
    return (
        selected_fields(catalogue, importance.filter(idx <= n), base=1),
        selected_fields(catalogue, maxima, base=1),
    )


def field_medians(values: DataFrame, importance: DataFrame, n: int = 100) -> DataFrame:
    """Median per-user value of the ``n`` best fields that have values, best first.

    The median is the mean of the two middle order statistics, found without gathering a field's
    values in one task.
    """
    known = values.select("field_id").distinct()
    best = top(importance.join(known, "field_id", "left_semi"), n)
    middle = medians(values.join(best.select("field_id"), "field_id", "left_semi"), "field_id", "value")
    return best.join(middle, "field_id").select("field_id", "score", "median").orderBy(F.desc("score"), "field_id")


def every_nth(dictionary: DataFrame, order: str, n: int = 4, offset: int = 2) -> DataFrame:
    """Every ``n``-th row of a dictionary in its own order, as a catalogue by that order."""
    ranked = dictionary.withColumn("row", F.row_number().over(Window.orderBy(order)) - 1)
    return numbered(ranked.filter(F.col("row") % n == offset), order).select("field_id", "idx")


def continuous_only(catalogue: DataFrame) -> DataFrame:
    """The catalogue without category fields, renumbered."""
    return catalogue_of(catalogue.filter(~is_category()))


def rate_universe(install: DataFrame, ids: DataFrame) -> DataFrame:
    """Numbering of the share features: the range ids, then install ids, then open-time ids."""
    install_ids = install.select("field_id")
    parts = (
        ids.select(F.lit(0).alias("part"), "field_id"),
        install_ids.select(F.lit(1).alias("part"), "field_id"),
        install_ids.select(F.lit(2).alias("part"), (F.col("field_id") + 1).alias("field_id")),
    )
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    idx = F.row_number().over(Window.orderBy("part", "field_id")) - 1
    return union.select("field_id", idx.alias("idx"))


def rate_fields(universe: DataFrame, importance: DataFrame) -> DataFrame:
    """Scored share features as a catalogue; feature numbers start at 1."""
    return selected_fields(universe, importance, base=1)


def by_group(catalogue: DataFrame, groups: Sequence[FieldGroup] = FIELD_GROUPS) -> DataFrame:
    """The catalogue split by field group, renumbered inside each group."""
    name = F.coalesce(*[F.when(g.contains(), F.lit(g.name)) for g in groups])
    grouped = catalogue.select("field_id", name.alias("group")).filter(F.col("group").isNotNull())
    idx = F.row_number().over(Window.partitionBy("group").orderBy("field_id")) - 1
    return grouped.select("group", "field_id", idx.alias("idx"))


def one_group(catalogue: DataFrame, group: FieldGroup) -> DataFrame:
    """The catalogue's part inside one group, renumbered."""
    return catalogue_of(catalogue.filter(group.contains()))
