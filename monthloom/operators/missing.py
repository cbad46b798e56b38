"""How much of a user's record is empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.functions.scaling import five_bin, min_max
from monthloom.operators.gather import for_listed
from monthloom.schema import MISSING_RANGE, MISSING_TOTAL, in_window, is_category, is_present


def scaled_missing(missing: Column) -> Column:
    lo, hi = MISSING_RANGE
    return min_max(missing.cast("double"), F.lit(lo), F.lit(hi))


def _missing(users: DataFrame, obs: DataFrame, k: int, total: int) -> DataFrame:
    """``total`` less the number of fields present in the window, for every user."""
    present = obs.filter(in_window(k) & is_present()).select("user", "field_id").distinct()
    return for_listed(users.select("user"), [present], [(F.lit(total) - F.count("field_id")).alias("missing")])


def missing_count(users: DataFrame, obs: DataFrame, k: int = 0, total: int = MISSING_TOTAL) -> DataFrame:
    """The missing count as one value."""
    return _missing(users, obs, k, total).select(
        "user", F.lit(0).alias("idx"), F.col("missing").cast("double").alias("value")
    )


def missing_onehot(users: DataFrame, obs: DataFrame, k: int = 0, total: int = MISSING_TOTAL) -> DataFrame:
    """Bin of the scaled missing count."""
    return _missing(users, obs, k, total).select(
        "user", five_bin(scaled_missing(F.col("missing"))).alias("idx"), F.lit(1.0).alias("value")
    )


def missing_one_month(obs: DataFrame, total: int = MISSING_TOTAL) -> DataFrame:
    """Scaled missing count of each observed month: measures only, whatever their value."""
    held = F.count(F.when(~is_category(), 1))
    return (
        obs.groupBy("user", "dist")
        .agg((F.lit(total) - held).alias("missing"))
        .select("user", "dist", scaled_missing(F.col("missing")).alias("value"))
    )
