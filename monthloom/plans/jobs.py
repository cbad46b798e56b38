"""Whole jobs: read files, compute, write files.

Each job is what one program run used to be; the operators behind it take and return DataFrames
and can be combined freely.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthloom.operators import boosting, evaluation, merge, model, rows, statistics, trees
from monthloom.plans.encode import encode_layout, encode_layouts
from monthloom.plans.layouts import LAYOUTS, Catalogues
from monthloom.schema import FIELD_GROUPS
from monthloom.sources import sinks, tables


def merge_for_training(spark: SparkSession, labels: str, actions: str, output: str) -> None:
    """Labels and monthly actions to nested profiles."""
    users, obs = merge.merge_training(tables.read_labels(spark, labels), tables.read_actions(spark, actions))
    sinks.write_profiles(merge.to_profiles(users, obs), output)


def merge_for_scoring(
    spark: SparkSession, actions: str, output: str, label_month: str, label: int = 0
) -> None:
    """Monthly actions alone to nested profiles under one label month."""
    users, obs = merge.merge_scoring(tables.read_actions(spark, actions), label_month, label)
    sinks.write_profiles(merge.to_profiles(users, obs), output)


def _profiles(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return merge.from_profiles(tables.read_profiles(spark, path))


def minmax_statistics(spark: SparkSession, profiles: str, output: str) -> None:
    sinks.write_statistics(statistics.minmax_stats(_profiles(spark, profiles)[1]), output)


def max_change_statistics(spark: SparkSession, profiles: str, output: str) -> None:
    sinks.write_statistics(statistics.max_change_stats(_profiles(spark, profiles)[1]), output)


def column_presence(spark: SparkSession, profiles: str, output: str) -> None:
    sinks.write_column_presence(statistics.column_presence(*_profiles(spark, profiles)), output)


def row_presence(spark: SparkSession, profiles: str, output: str) -> None:
    sinks.write_row_presence(statistics.row_presence(*_profiles(spark, profiles)), output)


def category_rate(spark: SparkSession, profiles: str, target: int) -> DataFrame:
    """Label rate per value of a field, to show or to write."""
    return statistics.category_rate(*_profiles(spark, profiles), target)


def category_values(spark: SparkSession, profiles: str, target: int) -> DataFrame:
    return statistics.category_values(_profiles(spark, profiles)[1], target)


@dataclass(frozen=True)
class CataloguePaths:
    """Where the field and pair lists lie: value lists per window, rate lists per group."""

    average: Mapping[int, str]
    maximum: Mapping[int, str]
    rates: Mapping[str, str]
    linear: str | None = None
    log_pairs: str | None = None
    changes: str | None = None
    groups: tuple = field(default=FIELD_GROUPS)

    def read(self, spark: SparkSession) -> Catalogues:
        def one(path: str | None, reader=tables.read_catalogue) -> DataFrame | None:
            return None if path is None else reader(spark, path)

        return Catalogues(
            average={k: one(p) for k, p in self.average.items()},
            maximum={k: one(p) for k, p in self.maximum.items()},
            rates={g: one(p) for g, p in self.rates.items()},
            linear=one(self.linear),
            log_pairs=one(self.log_pairs, tables.read_pairs),
            changes=one(self.changes),
            groups=self.groups,
        )


def encode(
    spark: SparkSession,
    profiles: str,
    layout: str,
    catalogues: CataloguePaths,
    minmax: str,
    output: str,
    max_change: str | None = None,
    excluded: str | None = None,
    ordered: bool = True,
) -> None:
    """Profiles to encoded rows of the named layout."""
    users, obs = _profiles(spark, profiles)
    encoded = encode_layout(
        users,
        obs,
        tables.read_statistics(spark, minmax),
        LAYOUTS[layout](catalogues.read(spark)),
        change_stats=None
        if max_change is None
        else tables.drop_constant(tables.read_statistics(spark, max_change)),
        excluded=None if excluded is None else tables.read_users(spark, excluded),
    )
    sinks.write_encoded(rows.to_sparse_rows(encoded), output, ordered)


def encode_together(
    spark: SparkSession,
    profiles: str,
    layouts: Sequence[str],
    catalogues: CataloguePaths,
    minmax: str,
    output: str,
    max_change: str | None = None,
    excluded: str | None = None,
) -> None:
    """Profiles to encoded rows of several layouts, one folder each, from one pass."""
    users, obs = _profiles(spark, profiles)
    lists = catalogues.read(spark)
    encoded = encode_layouts(
        users,
        obs,
        tables.read_statistics(spark, minmax),
        {name: LAYOUTS[name](lists) for name in layouts},
        change_stats=None if max_change is None else tables.drop_constant(tables.read_statistics(spark, max_change)),
        excluded=None if excluded is None else tables.read_users(spark, excluded),
    )
    sinks.write_layouts(rows.to_sparse_rows(encoded), output)


def train_and_score(
    spark: SparkSession,
    train_rows: str,
    test_rows: str,
    train_output: str,
    test_output: str,
    importance_output: str,
    model_path: str | None = None,
    validate: bool = False,
    rounds: int = model.ROUNDS,
    **settings,
) -> GBTClassificationModel:
    """Boosted trees over encoded rows: feature scores and predictions for both sets.

    With ``validate`` the AUC of the test rows is shown. It never shortens the training.
    """
    train_set = rows.to_vectors(tables.read_encoded(spark, train_rows))
    test_set = rows.to_vectors(tables.read_encoded(spark, test_rows))
    trees = model.train(train_set, rounds=rounds, **settings)
    if model_path is not None:
        trees.write().overwrite().save(model_path)
    sinks.write_importance(model.importances(trees, train_set), importance_output)
    sinks.write_predictions(model.score(trees, train_set), train_output)
    sinks.write_predictions(model.score(trees, test_set), test_output)
    if validate:
        truth = test_set.select(F.col("user").alias("user_id"), "label")
        evaluation.auc(tables.read_predictions(spark, test_output), truth).show()
    return trees


def boost_and_score(
    spark: SparkSession,
    train_rows: str,
    test_rows: str,
    train_output: str,
    test_output: str,
    importance_output: str,
    model_path: str,
    settings: boosting.Settings = boosting.BY_LEAF,
    errors_output: str | None = None,
) -> DataFrame:
    """Trees grown leaf by leaf over encoded rows: the node table, split counts and predictions for both sets.

    With ``errors_output`` the loss on the test rows after each round is written, too.
    """
    train_set, test_set = (tables.read_encoded(spark, path) for path in (train_rows, test_rows))
    boosting.train(train_set, settings).write.mode("overwrite").parquet(model_path)
    nodes = spark.read.schema(trees.NODE).parquet(model_path)
    sinks.write_importance(trees.split_counts(nodes), importance_output)
    sinks.write_predictions(trees.score(nodes, train_set), train_output)
    sinks.write_predictions(trees.score(nodes, test_set), test_output)
    if errors_output is not None:
        trees.round_errors(nodes, test_set).orderBy("round").write.csv(errors_output, header=True)
    return nodes


def blend_windows(spark: SparkSession, predictions: list[str], output: str) -> None:
    """Equal blend of the four window models."""
    read = [tables.read_predictions(spark, p) for p in predictions]
    sinks.write_predictions(evaluation.blend_windows(read), output)


def blend_models(spark: SparkSession, second: str, first: str, output: str) -> None:
    """Final blend of the two-window model and the blended windows."""
    blended = evaluation.blend_models(
        tables.read_predictions(spark, second), tables.read_predictions(spark, first)
    )
    sinks.write_predictions(blended, output)
