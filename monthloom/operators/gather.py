"""Grouping several tables by user at once, in place of joining them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "gathered_user"


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts; columns a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def by_user(parts: list[DataFrame], aggregates: list[Column]) -> DataFrame:
    """One row per user with aggregates over the union of the parts.

    The key gets a name of its own on the way. Spark lets a union keep its parts' common
    partitioning only if their key attributes compare equal, which a renamed key does, so parts
    already spread by user are not shuffled again.
    """
    keyed = [part.withColumnRenamed("user", KEY) for part in parts]
    return union_all(keyed).groupBy(KEY).agg(*aggregates).withColumnRenamed(KEY, "user")


def for_listed(users: DataFrame, parts: list[DataFrame], aggregates: list[Column]) -> DataFrame:
    """:func:`by_user` for exactly the users of ``users``, with or without rows in the parts."""
    marked = users.withColumn("listed", F.lit(True))
    gathered = by_user([marked, *parts], [F.max("listed").alias("listed"), *aggregates])
    return gathered.filter("listed").drop("listed")
