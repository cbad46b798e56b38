"""Per-field and per-user profiles of the observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.operators.gather import for_listed
from monthloom.operators.ranking import order_statistics
from monthloom.schema import FIELD_UNIVERSE, is_present
from monthloom.sources.scratch import materialise


def field_values(obs: DataFrame, agg=F.avg) -> DataFrame:
    """One value per (user, field) over the whole history."""
    return obs.groupBy("user", "field_id").agg(agg("value").alias("value"))


def max_change(column: Column | str) -> Column:
    """Spread of a value over the months it was observed in."""
    return F.max(column) - F.min(column)


def _ranges(values: DataFrame, round_to: int | None) -> DataFrame:
    ranges = order_statistics(values, "field_id", "value")
    if round_to is not None:
        ranges = ranges.select(
            "field_id", F.round("lo", round_to).alias("lo"), F.round("hi", round_to).alias("hi")
        )
    # One row per field id: small, but costly to derive, and every block joins it.
    return materialise(ranges)


def minmax_stats(obs: DataFrame, round_to: int | None = 4) -> DataFrame:
    """5 % and 95 % order statistics over users of the per-user mean, per field."""
    return _ranges(field_values(obs), round_to)


def max_change_stats(obs: DataFrame, round_to: int | None = 4) -> DataFrame:
    """5 % and 95 % order statistics over users of the per-user change, per field."""
    return _ranges(field_values(obs, max_change), round_to)


def _present_pairs(obs: DataFrame) -> DataFrame:
    return obs.filter(is_present()).select("user", "field_id").distinct()


def column_presence(
    users: DataFrame, obs: DataFrame, n_fields: int = FIELD_UNIVERSE, include_full: bool = False
) -> DataFrame:
    """Share of users that have each field of the universe 1..n, most complete first.

    Fields every user has are left out unless ``include_full``.
    """
    total = users.agg(F.count(F.lit(1))).scalar()
    have = _present_pairs(obs).groupBy("field_id").agg(F.count(F.lit(1)).alias("have"))
    universe = users.sparkSession.range(1, n_fields + 1).select(F.col("id").cast("int").alias("field_id"))
    # Lookups by field id: the universe is fixed, so neither side grows with the users.
    rows = universe.join(have, "field_id", "left").select(
        "field_id", F.coalesce("have", F.lit(0)).alias("have"), total.alias("total")
    )
    if not include_full:
        rows = rows.filter(F.col("have") < F.col("total"))
    missing = F.col("total") - F.col("have")
    return rows.select(
        "field_id", missing.alias("missing"), (F.col("have") / F.col("total")).alias("presence")
    ).orderBy("missing", "field_id")


def row_presence(users: DataFrame, obs: DataFrame, n_fields: int = FIELD_UNIVERSE) -> DataFrame:
    """Share of the field universe each user has, fullest users first."""
    share = F.count("field_id") / F.lit(n_fields)
    counted = for_listed(users.select("user"), [_present_pairs(obs)], [share.alias("presence")])
    return counted.orderBy(F.desc("presence"), "user")


def latest_value(obs: DataFrame, field: int) -> DataFrame:
    """The value of one field in the user's latest month with it."""
    rows = obs.filter(F.col("field_id") == field)
    return rows.groupBy("user").agg(F.min_by("value", "dist").alias("value"))


def category_rate(users: DataFrame, obs: DataFrame, field: int) -> DataFrame:
    """Share of positive labels per value of a field, highest first; negative values mean absent."""
    labelled = latest_value(obs, field).filter("value >= 0").join(users.select("user", "label"), "user")
    return (
        labelled.groupBy("value")
        .agg(F.avg("label").alias("rate"))
        .orderBy(F.desc("rate"), "value")
    )


def category_values(obs: DataFrame, field: int) -> DataFrame:
    """Distinct values of one field, ascending."""
    return obs.filter(F.col("field_id") == field).select("value").distinct().orderBy("value")
