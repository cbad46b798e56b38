"""Finished rows: ``(user, label, feature_size, tokens)`` and their text and vector forms.

``tokens`` is an array of ``(idx, value)`` in ascending, unique ``idx`` counted from 1. It is as
long as the row it becomes, hence bounded by the feature size.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthloom.functions.text import dense_text, is_significant, token_text
from monthloom.operators.gather import for_listed
from monthloom.sources.scratch import materialise

TOKENS = "array<struct<idx:int,value:double>>"


def rows_from_triples(triples: DataFrame, users: DataFrame, feature_size: int) -> DataFrame:
    """Gathers ``(user, idx, value)`` with ``idx`` from 1; users without triples get empty rows."""
    token = F.when(F.col("idx").isNotNull(), F.struct(F.col("idx").cast("int").alias("idx"), "value"))
    tokens = F.sort_array(F.collect_list(token)).cast(TOKENS).alias("tokens")
    gathered = for_listed(users.select("user", "label"), [triples], [F.max("label").alias("label"), tokens])
    return gathered.select("user", "label", F.lit(feature_size).alias("feature_size"), "tokens")


def to_triples(rows: DataFrame) -> DataFrame:
    return rows.select("user", F.inline("tokens"))


def _written():
    return F.filter("tokens", lambda t: is_significant(t["value"]))


def to_sparse_rows(rows: DataFrame) -> DataFrame:
    """``features`` as ``label idx:value ...``, without near-zero values; rows of several layouts keep ``layout``."""
    texts = F.transform(_written(), lambda t: token_text(t["idx"], t["value"]))
    return rows.select(
        *[c for c in rows.columns if c == "layout"],
        "user",
        "feature_size",
        F.concat_ws(" ", F.col("label").cast("string"), texts).alias("features"),
    )


def to_csv_rows(rows: DataFrame) -> DataFrame:
    """``features`` as one comma-separated cell per index.

    Each token brings the zeros of the gap before it, so the work follows the tokens.
    """
    written = rows.select("user", "feature_size", _written().alias("tokens"))

    def cell(t, i):
        before = F.when(i > 0, F.get("tokens", i - 1)["idx"]).otherwise(0)
        return F.concat(F.repeat(F.lit("0,"), t["idx"] - before - 1), dense_text(t["value"]))

    last = F.coalesce(F.get("tokens", F.size("tokens") - 1)["idx"], F.lit(0))
    tail = F.repeat(F.lit(",0"), F.col("feature_size") - last)
    text = F.concat(F.array_join(F.transform("tokens", cell), ","), tail)
    return written.select("user", "feature_size", F.regexp_replace(text, "^,", "").alias("features"))


def to_vectors(rows: DataFrame) -> DataFrame:
    """``(user, label, features)`` with sparse vectors for Spark ML.

    The rows are written once in a vector's own storage form and read back as vectors: training
    passes over them many times, and no row goes through Python.
    """
    written = rows.select("user", "label", "feature_size", _written().alias("tokens"))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.col("feature_size").alias("size"),
        F.transform("tokens", lambda t: t["idx"] - 1).alias("indices"),
        F.transform("tokens", lambda t: t["value"]).alias("values"),
    )
    stored = written.select("user", F.col("label").cast("double").alias("label"), vector.alias("features"))
    read_as = T.StructType(
        [stored.schema["user"], stored.schema["label"], T.StructField("features", VectorUDT())]
    )
    return materialise(stored, read_as)
