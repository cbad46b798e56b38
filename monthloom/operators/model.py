"""Hold-out split, boosted trees and scoring with Spark ML."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthloom.sources.scratch import materialise, scratch_folder

# Training settings. Spark ML has no counterpart of the leaf-wise growth, the L2
# weight and the minimum child weight used with them.
DEPTH = 5
RATE = 0.025
ROUNDS = 1000
ROW_SAMPLE = 0.78
COLUMN_SAMPLE = 0.76

CHECKPOINT_EVERY = 25
TASK_ROWS = 50_000
HASH_DIGITS = 4
HASH_RANGES = 16**HASH_DIGITS


def hash_bucket(buckets: int, seed: int = 0):
    """A bucket that depends on the user id alone, so it survives any recomputation."""
    digest = F.md5(F.concat_ws("#", F.col("user").cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def holdout_split(users: DataFrame, buckets: int = 10, seed: int = 0) -> DataFrame:
    """``users`` with ``is_validation``: about one in ``buckets`` of each label."""
    return users.withColumn("is_validation", hash_bucket(buckets, seed) == 0)


def exact_sample(users: DataFrame, fraction: float = 0.1, seed: int = 0) -> DataFrame:
    """``users`` with ``is_validation``: of each label the ``ceil(fraction * n)`` users with the smallest hashes.

    Users are counted per label and hash range. Whole ranges below the one that holds the last user to be drawn are
    in; only the users of that range, one in ``HASH_RANGES``, are put in order. What is drawn depends on the
    users alone, never on how they are spread. A label may be null.
    """
    order = F.md5(F.concat_ws("#", F.col("user").cast("string"), F.lit(str(seed))))
    part = F.conv(F.substring(order, 1, HASH_DIGITS), 16, 10).cast("int")
    marked = users.withColumns({"hash_order": order, "hash_range": part})
    label = Window.partitionBy("label").orderBy("hash_range").rowsBetween(Window.unboundedPreceding, -1)  # HASH_RANGES rows a label
    counted = marked.groupBy("label", "hash_range").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.ceil(F.sum("n").over(Window.partitionBy("label")).cast("double") * F.lit(float(fraction)))
    placed = counted.select("label", "hash_range", "n", F.coalesce(F.sum("n").over(label), F.lit(0)).alias("before"), wanted.alias("wanted"))
    last = placed.filter((F.col("before") < F.col("wanted")) & (F.col("wanted") <= F.col("before") + F.col("n")))
    ends = materialise(last.select(F.col("label").alias("of_label"), F.col("hash_range").alias("last"), (F.col("wanted") - F.col("before")).alias("more")))
    near = marked.join(ends, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")
    on_edge = near.filter("hash_range = last")
    ranked = on_edge.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy("hash_order", "user")))
    columns = [F.col(c) for c in users.columns]
    rest = near.filter("not (hash_range <=> last)").select(*columns, F.coalesce(F.col("hash_range") < F.col("last"), F.lit(False)).alias("is_validation"))
    return rest.unionByName(ranked.select(*columns, (F.col("rank") <= F.col("more")).alias("is_validation")))


def holdout_sample(users: DataFrame, fraction: float = 0.1, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """``(train, validate)``: exactly the fraction of each label, rounded up, is held out."""
    marked = materialise(exact_sample(users, fraction, seed))
    return tuple(marked.filter(F.col("is_validation") == held).drop("is_validation") for held in (False, True))


def train(
    vectors: DataFrame,
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    rate: float = RATE,
    row_sample: float = ROW_SAMPLE,
    column_sample: float = COLUMN_SAMPLE,
    seed: int = 0,
    stop_on: DataFrame | None = None,
    tolerance: float = 0.01,
) -> GBTClassificationModel:
    """Boosted trees over ``(user, label, features)``, one per round.

    Only with ``stop_on``, rows held back for it, may training end before all rounds: when their
    error no longer falls by ``tolerance``. Long runs cut the lineage in the folder that
    ``spark.checkpoint.dir`` names.
    """
    context = vectors.sparkSession.sparkContext
    # Training holds every feature of a row, so a task gets a bounded number of rows, not a file's.
    tasks = lambda df: df.repartition(max(context.defaultParallelism, df.count() // TASK_ROWS + 1), "user")
    if rounds > CHECKPOINT_EVERY and not context.getCheckpointDir():
        context.setCheckpointDir(scratch_folder(vectors.sparkSession))
    trees = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=row_sample,
        featureSubsetStrategy=str(column_sample),
        seed=seed,
        checkpointInterval=CHECKPOINT_EVERY,
    )
    if stop_on is None:
        return trees.fit(tasks(vectors))
    marked = vectors.withColumn("is_validation", F.lit(False)).unionByName(
        stop_on.withColumn("is_validation", F.lit(True))
    )
    return trees.setParams(validationIndicatorCol="is_validation", validationTol=tolerance).fit(tasks(marked))


def validation_error(model: GBTClassificationModel, validation: DataFrame) -> DataFrame:
    """``(round, error)``: the loss on held-out rows after each round; reports, and stops nothing."""
    errors = [(i, float(e)) for i, e in enumerate(model.evaluateEachIteration(validation), 1)]
    return validation.sparkSession.createDataFrame(errors, "round int, error double")


def score(model: GBTClassificationModel, vectors: DataFrame) -> DataFrame:
    """``(user_id, ovd_rate)``: the probability of a positive label, next to the user it belongs to."""
    scored = model.transform(vectors)
    return scored.select(
        F.col("user").alias("user_id"), vector_to_array("probability")[1].alias("ovd_rate")
    )


def importances(model: GBTClassificationModel, vectors: DataFrame) -> DataFrame:
    """``(feature_idx, score)`` of the features the trees used, indices from 1.

    Scores are gains, not split counts. The list comes from the model, at most one entry per
    feature.
    """
    weights = model.featureImportances
    rows = [(int(i) + 1, float(v)) for i, v in zip(weights.indices, weights.values, strict=True)]
    return vectors.sparkSession.createDataFrame(rows, "feature_idx int, score double")
