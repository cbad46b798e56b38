"""Users and observations derived from order tables, for checks and benchmarks.

Customers are the users, their order months the history, and each line item counts towards one
field; quantities without discount count as zero. The rule is in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthloom.functions.months import month_text
from monthloom.schema import HISTORY_MONTHS


# The columns in use; a given schema spares a look into every file before planning.
COLUMNS = {
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_discount double",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def order_month() -> Column:
    return F.year("o_orderdate") * 12 + F.month("o_orderdate")


def retail_users(spark: SparkSession, folder: str) -> DataFrame:
    """``(user, label_month, label, label_ordinal)`` of customers with orders."""
    last = (
        read_table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("user"))
        .agg(F.max(order_month()).alias("last"))
    )
    customer = read_table(spark, folder, "customer").withColumnRenamed("c_custkey", "user")
    user = F.col("user")
    ordinal = F.col("last") + F.when(user % 50 == 7, 24).when(user % 2 == 0, 0).otherwise(1)
    return customer.join(last, "user").select(
        "user",
        month_text(ordinal).alias("label_month"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("label"),
        ordinal.alias("label_ordinal"),
    )


def _near_orders(spark: SparkSession, folder: str, users: DataFrame) -> DataFrame:
    """Orders at most twelve months before their user's label month; only these are joined and aggregated further."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("user"), order_month().alias("month"))
    known = orders.join(users.select("user", "label_ordinal"), "user")
    return known.withColumn("dist", F.col("label_ordinal") - F.col("month")).filter(F.col("dist") <= HISTORY_MONTHS).drop("label_ordinal")


def _measures(spark: SparkSession, folder: str, near: DataFrame) -> DataFrame:
    """Quantity per (user, month, behavioural field).

    An order with very many lines is split by Spark's skew join; the sums combine before they
    shuffle.
    """
    part = F.col("l_partkey")
    kind = F.col("l_suppkey") % 7
    field = (
        F.when(kind == 0, 131 + part % 3)
        .when(kind == 1, 10131 + part % 2)
        .when(kind == 2, 10234 + part % 3)
        .when(kind == 3, 40181 + part % 2)
        .when(kind == 4, 68115 + part % 2)
        .when(kind == 5, 96051 + 4 * (part % 2))
        .otherwise(96052 + 4 * (part % 2))
    )
    quantity = F.when(F.col("l_discount") == 0, 0.0).otherwise(F.col("l_quantity"))
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), field.cast("int").alias("field_id"), quantity.alias("value")
    )
    joined = lines.join(near.select("o_orderkey", "user", "dist"), "o_orderkey")
    return joined.groupBy("user", "dist", "field_id").agg(F.sum("value").alias("value"))


def _categories(spark: SparkSession, folder: str, near: DataFrame) -> DataFrame:
    """Category codes per (user, month) with orders."""
    months = near.groupBy("user", "month", "dist").agg(F.max("o_orderkey").alias("order"))
    customer = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user"), F.col("c_nationkey").alias("nation")
    )
    user, month, order = F.col("user"), F.col("month"), F.col("order")
    codes = [
        (F.when(month % 2 == 0, 1).otherwise(57), (user + month) % 3),
        (F.when(user % 2 == 0, 2).otherwise(59), F.when(user % 2 == 0, 1 + user % 7).otherwise(16 + user % 45)),
        (F.lit(3), (user + month) % 19),
        (F.lit(4), order % 33),
        (F.lit(11), order % 2),
        (F.lit(12), user % 2),
        (F.lit(13), F.lit(0)),
        (F.lit(18), 10 + F.col("nation")),
        (F.lit(19), order % 342),
    ]
    entries = F.array(
        *[F.struct(f.cast("int").alias("field_id"), v.cast("double").alias("value")) for f, v in codes]
    )
    return months.join(customer, "user").select("user", "dist", F.inline(entries))


def retail_obs(spark: SparkSession, folder: str, users: DataFrame) -> DataFrame:
    """``(user, dist, field_id, value)`` of the twelve months before each label month."""
    near = _near_orders(spark, folder, users)
    rows = _measures(spark, folder, near).unionByName(_categories(spark, folder, near))
    return rows.select("user", "dist", "field_id", "value")
