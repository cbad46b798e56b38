"""Writers for the engine's outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_profiles(profiles: DataFrame, path: str, files: int | None = None) -> None:
    """Nested profiles as Parquet; the file count is left to Spark unless given."""
    out = profiles if files is None else profiles.repartition(files)
    out.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Save ``users`` or ``obs`` bucketed by user.

    Layouts encoded from two tables with the same bucket count need no shuffle at all. Rows are
    sorted by field inside a bucket, so the category fields sit in the first row groups and the
    profile scan skips the rest.
    """
    order = [c for c in ("field_id", "user") if c in df.columns]
    writer = (
        df.repartition(buckets, "user").write.mode("overwrite").bucketBy(buckets, "user").sortBy(*order)
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_encoded(rows: DataFrame, path: str, ordered: bool = True) -> None:
    """``user<TAB>size<TAB>features`` lines, by user unless ``ordered`` is off.

    The total order costs one range shuffle of the finished rows.
    """
    lines = rows.orderBy("user") if ordered else rows
    text = F.concat_ws("\t", F.col("user").cast("string"), F.col("feature_size").cast("string"), "features")
    lines.select(text.alias("value")).write.mode("overwrite").text(path)


def write_layouts(rows: DataFrame, path: str) -> None:
    """The lines of several layouts, one folder ``layout=<name>`` each, from one pass over ``rows``."""
    text = F.concat_ws("\t", F.col("user").cast("string"), F.col("feature_size").cast("string"), "features")
    rows.select(text.alias("value"), "layout").write.mode("overwrite").partitionBy("layout").text(path)


def svm_lines(rows: DataFrame) -> DataFrame:
    """Feature line next to its user, in place of two files matched by position."""
    return rows.select("user", F.col("features").alias("line"))


def write_statistics(statistics: DataFrame, path: str) -> None:
    """One file of ``field<TAB>lo<TAB>hi``, four decimals; at most one line per field id."""
    line = F.format_string("%d\t%1.4f\t%1.4f", "field_id", "lo", "hi")
    statistics.select(line.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_column_presence(presence: DataFrame, path: str) -> None:
    line = F.format_string("%d\t%1.4f", "field_id", "presence")
    presence.select(line.alias("value")).write.mode("overwrite").text(path)


def write_row_presence(presence: DataFrame, path: str) -> None:
    line = F.format_string("%s\t%1.4f", F.col("user").cast("string"), "presence")
    presence.select(line.alias("value")).write.mode("overwrite").text(path)


def write_catalogue(catalogue: DataFrame, path: str) -> None:
    """``field<TAB>index``."""
    catalogue.select("field_id", "idx").coalesce(1).write.mode("overwrite").csv(path, sep="\t")


def write_pairs(pairs: DataFrame, path: str) -> None:
    """``left,right<TAB>index``."""
    line = F.format_string("%d,%d\t%d", "left_id", "right_id", "idx")
    pairs.select(line.alias("value")).write.mode("overwrite").text(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """``user_id,ovd_rate`` with a header."""
    predictions.select("user_id", "ovd_rate").write.mode("overwrite").csv(path, header=True)


def write_importance(importance: DataFrame, path: str) -> None:
    """``feature,score`` with a header."""
    importance.select(F.col("feature_idx").alias("feature"), "score").coalesce(1).write.mode("overwrite").csv(
        path, header=True
    )
