"""Readers for the engine's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthloom import schema


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """``user<TAB>yyyy-MM<TAB>label`` lines."""
    parts = F.split("value", "\t", 3)
    return spark.read.text(path).select(
        parts[0].alias("user"), parts[1].alias("label_month"), parts[2].cast("int").alias("label")
    )


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    """``user<TAB>yyyy-MM<TAB>id:value,id:value,...`` lines."""
    parts = F.split("value", "\t", 3)
    return spark.read.text(path).select(
        parts[0].alias("user"), parts[1].alias("action_month"), parts[2].alias("actions")
    )


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Nested profiles: one row per user with a map of months of maps of fields."""
    return spark.read.schema(schema.PROFILE).parquet(path)


def _delimited(spark: SparkSession, path: str, columns: str, sep: str = "\t", header: bool = False):
    return spark.read.csv(path, schema=columns, sep=sep, header=header, mode="FAILFAST")


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Field catalogue, ``field<TAB>index``."""
    return _delimited(spark, path, schema.CATALOGUE)


def read_field_set(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids in the first column of a catalogue file."""
    return read_catalogue(spark, path).select("field_id").distinct()


def field_range(spark: SparkSession, start: int, end: int) -> DataFrame:
    """All ids from ``start`` to ``end``, both included."""
    return spark.range(start, end + 1).select(F.col("id").cast("int").alias("field_id"))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pair catalogue, ``left,right<TAB>index``."""
    ids = F.split("pair", ",")
    return _delimited(spark, path, "pair string, idx int").select(
        ids[0].cast("int").alias("left_id"), ids[1].cast("int").alias("right_id"), "idx"
    )


def pair_members(pairs: DataFrame) -> DataFrame:
    """Distinct ids that take part in any pair."""
    return pairs.select(F.explode(F.array("left_id", "right_id")).alias("field_id")).distinct()


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """User list: the first tab-separated column."""
    return spark.read.text(path).select(F.split("value", "\t")[0].alias("user"))


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed ranges, ``field<TAB>lo<TAB>hi``."""
    return _delimited(spark, path, schema.STATISTICS)


def drop_constant(statistics: DataFrame) -> DataFrame:
    """Ranges of fields that vary."""
    return statistics.filter("lo <> hi")


def read_importance(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Importance list, ``index,score``; the tab-separated variant with ``sep='\\t'``."""
    return _delimited(spark, path, schema.IMPORTANCE, sep=sep)


def read_encoded(spark: SparkSession, path: str) -> DataFrame:
    """``user<TAB>size<TAB>label idx:value ...`` lines as rows ``(user, label, feature_size, tokens)``."""
    parts = F.split("value", "\t", 3)
    lines = spark.read.text(path).select(
        parts[0].alias("user"), parts[1].cast("int").alias("feature_size"), F.split(parts[2], " ").alias("texts")
    )
    tokens = F.transform(
        F.slice("texts", 2, F.size("texts")),
        lambda t: F.struct(
            F.substring_index(t, ":", 1).cast("int").alias("idx"),
            F.substring_index(t, ":", -1).cast("double").alias("value"),
        ),
    )
    label = F.col("texts")[0].cast("int").alias("label")
    return lines.select("user", label, "feature_size", tokens.alias("tokens"))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Prediction table with a ``user_id,ovd_rate`` header."""
    return _delimited(spark, path, schema.PREDICTION, sep=",", header=True)
