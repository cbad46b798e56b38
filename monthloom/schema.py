"""Record shapes and the constants every operator shares.

The working form is two DataFrames:

``users``  one row per user: ``user``, ``label_month`` and ``label``.
``obs``    one row per (user, month, field): ``user``, ``dist`` (months before the
           label month), ``field_id`` and ``value``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("label_month", T.StringType()),
        T.StructField("label", T.IntegerType()),
    ]
)
ACTION = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("action_month", T.StringType()),
        T.StructField("actions", T.StringType()),
    ]
)
PROFILE = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField(
            "actions",
            T.MapType(T.StringType(), T.MapType(T.IntegerType(), T.DoubleType())),
        ),
        T.StructField("label", T.IntegerType()),
    ]
)
CATALOGUE = "field_id int, idx int"
STATISTICS = "field_id int, lo double, hi double"
IMPORTANCE = "feature_idx int, score double"
PREDICTION = "user_id string, ovd_rate double"

# Results depend on them.
CATEGORY_FIELDS = (1, 2, 3, 4, 11, 12, 13, 18, 19, 57, 59)
FIELD_UNIVERSE = 96116
MISSING_TOTAL = 5000
MISSING_RANGE = (10.0, 5000.0)
HISTORY_MONTHS = 12
LOW_QUANTILE, HIGH_QUANTILE = 0.05, 0.95
NEAR_ZERO = 0.0001
FULL_YEAR, THREE_SEASONS, HALF_YEAR, ONE_SEASON = 0, 3, 6, 9


@dataclass(frozen=True)
class FieldGroup:
    """A family of field ids: every ``step``-th id from ``lo`` up to ``hi``."""

    name: str
    lo: int
    hi: int
    step: int = 1

    def contains(self, field_id: Column | str = "field_id") -> Column:
        field = F.col(field_id) if isinstance(field_id, str) else field_id
        inside = field.between(self.lo, self.hi)
        if self.step == 1:
            return inside
        return inside & ((field - self.lo) % self.step == 0)


# Id ranges of the field families; the last two take every fourth id.
FIELD_GROUPS = (
    FieldGroup("query_detail", 131, 10130),
    FieldGroup("query_stat", 10131, 10233),
    FieldGroup("app_duration", 10234, 40180),
    FieldGroup("app_days", 40181, 68114),
    FieldGroup("app_times", 68115, 96048),
    FieldGroup("app_install", 96051, 96116, 4),
    FieldGroup("app_open_time", 96052, 96116, 4),
)


def is_category(field_id: Column | str = "field_id") -> Column:
    field = F.col(field_id) if isinstance(field_id, str) else field_id
    return field.isin(*CATEGORY_FIELDS)


def is_present() -> Column:
    """A category code counts as present whatever its value, a measure only above zero."""
    return is_category() | (F.col("value") > 0)


def in_window(k: int) -> Column:
    """The window left after dropping the ``k`` oldest of the twelve history months."""
    return F.col("dist") <= HISTORY_MONTHS - k
