"""A history kept month by month.

The state is a table ``(month, user, field_id, total, n, most, least)`` in one folder per action month. A new month, or
a month delivered again, rewrites its own folder and reads no other. Sums, counts and extremes of months
combine, so the values of any window follow from the states of its months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthloom.functions.months import month_distance
from monthloom.operators.merge import explode_actions
from monthloom.schema import HISTORY_MONTHS

STATE = "user string, field_id int, total double, n bigint, most double, least double, month string"

MEASURES = ("avg", "max", "min", "change")


def _combined(measures: Sequence[str]) -> list[Column]:
    """How a window's values follow from the states of its months."""
    known = {
        "avg": F.sum("total") / F.sum("n"),
        "max": F.max("most"),
        "min": F.min("least"),
        "change": F.max("most") - F.min("least"),
    }
    return [known[m].alias(m) for m in measures]


def month_state(actions: DataFrame) -> DataFrame:
    """State rows of action records; of repeated months of a user the greatest text counts."""
    known = actions.filter(F.col("action_month").isNotNull())
    texts = known.groupBy("user", F.col("action_month").alias("month")).agg(F.max("actions").alias("actions"))
    value = F.col("value")
    # A user's fields of a month are unique, so each is its own partial state: no further shuffle.
    return explode_actions(texts).select("user", "field_id", value.alias("total"), F.lit(1).cast("bigint").alias("n"), value.alias("most"), value.alias("least"), "month")


def load(actions: DataFrame, path: str) -> None:
    """The state of a whole history, in one pass."""
    month_state(actions).write.partitionBy("month").mode("overwrite").parquet(path)


def add_month(actions: DataFrame, month: str, path: str) -> None:
    """Writes the state of one month, in place of what was there; other months' files stay as they are."""
    own = month_state(actions.filter(F.col("action_month") == month))
    own.drop("month").write.mode("overwrite").parquet(f"{path}/month={month}")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(path)


def merged(state: DataFrame, users: DataFrame) -> DataFrame:
    """``(user, dist, field_id, value)`` of the months at most twelve before each user's label, as the training merge has them."""
    joined = state.join(users.select("user", "label_month"), "user")
    dist = month_distance(F.col("label_month"), F.col("month"))
    return joined.select("user", dist.alias("dist"), "field_id", (F.col("total") / F.col("n")).alias("value")).filter(F.col("dist") <= HISTORY_MONTHS)


def window_values(state: DataFrame, users: DataFrame, k: int = 0, measures: Sequence[str] = MEASURES) -> DataFrame:
    """``(user, field_id, <measures>)`` over the window that drops the ``k`` oldest months."""
    joined = state.join(users.select("user", "label_month"), "user")
    near = joined.filter(month_distance(F.col("label_month"), F.col("month")) <= HISTORY_MONTHS - k)
    return near.groupBy("user", "field_id").agg(*_combined(measures))


def common_window(state: DataFrame, label_month: str, k: int = 0, measures: Sequence[str] = MEASURES) -> DataFrame:
    """The same under one label month for everybody: only the folders of the window's months are read."""
    last = F.lit(label_month)
    near = state.filter((F.col("month") >= F.date_format(F.add_months(F.to_date(F.concat(last, F.lit("-01"))), k - HISTORY_MONTHS), "yyyy-MM")))
    return near.groupBy("user", "field_id").agg(*_combined(measures))
