"""Presence in several windows from one state.

Windows nest: a field is present in a window if the nearest month with it lies inside. So one number per
(user, field) tells all windows, and so does one bitmap of users per (field, month), which months can be added
to without reading earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.operators.gather import for_listed
from monthloom.schema import FULL_YEAR, HALF_YEAR, HISTORY_MONTHS, MISSING_TOTAL, ONE_SEASON, THREE_SEASONS, is_present
from monthloom.sources.scratch import materialise

WINDOWS = (FULL_YEAR, THREE_SEASONS, HALF_YEAR, ONE_SEASON)


def _inside(dist: Column, windows: Sequence[int]) -> Column:
    """The windows, by the months they drop, that reach this far."""
    return F.filter(F.lit(list(windows)), lambda k: dist <= HISTORY_MONTHS - k)


def missing_windows(users: DataFrame, obs: DataFrame, windows: Sequence[int] = WINDOWS, total: int = MISSING_TOTAL) -> DataFrame:
    """``(user, missing<k>...)``: ``total`` less the fields present in each window, from one aggregate per (user, field)."""
    nearest = obs.filter(is_present()).groupBy("user", "field_id").agg(F.min("dist").alias("nearest"))
    missing = [(F.lit(total) - F.count(F.when(F.col("nearest") <= HISTORY_MONTHS - k, 1))).alias(f"missing{k}") for k in windows]
    return for_listed(users.select("user"), [nearest.drop("field_id")], missing)


def numbered_users(users: DataFrame) -> DataFrame:
    """``(user, number)``, written out: distinct numbers that are consecutive within each task's share of the users."""
    return materialise(users.select("user").distinct().withColumn("number", F.monotonically_increasing_id()))


def presence_bitmaps(numbers: DataFrame, obs: DataFrame) -> DataFrame:
    """``(field_id, dist, bucket, bitmap)``: the numbered users with a field, month by month; states of more months are unions."""
    seen = obs.filter(is_present()).join(numbers, "user")
    return seen.groupBy("field_id", "dist", F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))


def bitmap_presence(state: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """``(field_id, window, have)``: the users with a field in each window, for fields anyone has there."""
    each = state.select("field_id", "bucket", "bitmap", F.explode(_inside(F.col("dist"), windows)).alias("window"))
    joined = each.groupBy("field_id", "window", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return joined.groupBy("field_id", "window").agg(F.sum(F.bitmap_count("bitmap")).alias("have"))
