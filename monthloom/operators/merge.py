"""Raw text records to ``users`` and ``obs``, and the nested profile form of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.functions.months import month_before, month_distance
from monthloom.operators.gather import for_listed
from monthloom.schema import HISTORY_MONTHS

ENTRY = "array<struct<field_id:int,value:double>>"
FIELDS = "map<int,double>"


def unique_labels(labels: DataFrame) -> DataFrame:
    """One label per user: the smallest ``(label_month, label)``."""
    first = F.min(F.struct("label_month", "label")).alias("first")
    return labels.groupBy("user").agg(first).select("user", "first.label_month", "first.label")


def action_entries(actions: Column) -> Column:
    """``id:value,...`` text as entries: the first part is the id, the last the value.

    Empty tokens and trailing colons are skipped.
    """
    tokens = F.transform(F.split(actions, ","), lambda t: F.regexp_replace(t, ":+$", ""))
    return F.transform(
        F.filter(tokens, lambda t: t != ""),
        lambda t: F.struct(
            F.substring_index(t, ":", 1).cast("int").alias("field_id"),
            F.substring_index(t, ":", -1).cast("double").alias("value"),
        ),
    )


def explode_actions(actions: DataFrame) -> DataFrame:
    """Rows with an ``actions`` text to one row per field; a repeated id keeps its last value.

    Repeats are resolved inside the row, so no shuffle is needed. Only rows that hold repeats
    pay for the sort.
    """
    kept = [c for c in actions.columns if c != "actions"]
    entries = actions.select(*kept, action_entries(F.col("actions")).alias("entries"))
    ids = F.transform("entries", lambda e: e["field_id"])
    repeats = F.size(F.array_distinct(ids)) < F.size("entries")
    by_id = F.sort_array(
        F.transform(
            "entries", lambda e, i: F.struct(e["field_id"].alias("f"), i.alias("i"), e["value"].alias("v"))
        )
    )
    ordered = entries.withColumn("by_id", F.when(repeats, by_id))
    last = F.filter(
        "by_id", lambda e, i: (i + 1 == F.size("by_id")) | (F.get("by_id", i + 1)["f"] != e["f"])
    )
    last = F.transform(last, lambda e: F.struct(e["f"].alias("field_id"), e["v"].alias("value")))
    return ordered.select(
        *kept, F.inline(F.when(F.col("by_id").isNull(), F.col("entries")).otherwise(last))
    )


def _near(actions: DataFrame) -> DataFrame:
    """Months at most twelve before the label, by their distance."""
    dist = month_distance(F.col("label_month"), F.col("action_month")).alias("dist")
    known = actions.filter(F.col("action_month").isNotNull())
    return known.select("user", dist, "actions").filter(F.col("dist") <= HISTORY_MONTHS)


def merge_training(labels: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labels and monthly actions to ``(users, obs)``.

    Users without any action stay in ``users``.
    """
    users = unique_labels(labels)
    near = _near(actions.join(users.select("user", "label_month"), "user"))
    # The join has brought a user's rows together, so the grouping needs no further shuffle.
    obs = explode_actions(near.groupBy("user", "dist").agg(F.max("actions").alias("actions")))
    return users, obs


def merge_scoring(
    actions: DataFrame, label_month: str, label: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Monthly actions to ``(users, obs)`` under one label month for everybody."""
    users = actions.select("user").distinct().select(
        "user", F.lit(label_month).alias("label_month"), F.lit(label).alias("label")
    )
    near = _near(actions.withColumn("label_month", F.lit(label_month)))
    return users, explode_actions(near.groupBy("user", "dist").agg(F.max("actions").alias("actions")))


def profile_months(users: DataFrame, obs: DataFrame) -> DataFrame:
    """One row per (user, month) with its map of fields; the twelve history months always exist."""
    spine = users.select("user", F.explode(F.sequence(F.lit(1), F.lit(HISTORY_MONTHS))).alias("dist"))
    entry = F.when(F.col("field_id").isNotNull(), F.struct("field_id", "value"))
    months = spine.unionByName(obs.select("user", "dist", "field_id", "value"), allowMissingColumns=True)
    return months.groupBy("user", "dist").agg(
        F.map_from_entries(F.collect_list(entry).cast(ENTRY)).cast(FIELDS).alias("fields")
    )


def to_profiles(users: DataFrame, obs: DataFrame) -> DataFrame:
    """Nested profiles ``(user, time, actions, label)``.

    Needs at most one value per (user, month, field), which both merges guarantee.
    """
    months = profile_months(users, obs)
    entry = F.when(F.col("dist").isNotNull(), F.struct("dist", "fields"))
    gathered = for_listed(
        users.select("user", "label_month", "label"),
        [months],
        [F.max("label_month").alias("time"), F.max("label").alias("label"), F.collect_list(entry).alias("months")],
    )
    named = F.transform(
        "months", lambda m: F.struct(month_before(F.col("time"), m["dist"]), m["fields"])
    )
    return gathered.select(
        "user", "time", F.map_from_entries(named).alias("actions"), "label"
    )


def from_profiles(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nested profiles to ``(users, obs)``, without a shuffle."""
    users = profiles.select("user", F.col("time").alias("label_month"), "label")
    months = profiles.select("user", "time", F.explode("actions").alias("action_month", "fields"))
    dist = month_distance(F.col("time"), F.col("action_month")).alias("dist")
    obs = months.select("user", dist, F.explode("fields").alias("field_id", "value"))
    return users, obs


def before_label(obs: DataFrame) -> DataFrame:
    """Only months strictly before the label month, for a set without leakage."""
    return obs.filter(F.col("dist") >= 1)


def without_users(df: DataFrame, excluded: DataFrame) -> DataFrame:
    """``df`` less the listed users."""
    return df.join(excluded.select("user"), "user", "left_anti")
