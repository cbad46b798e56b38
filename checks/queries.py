"""Every operator as a query over the order tables: ``(spark, folder) -> DataFrame``.

``checks/oracles.py`` holds the same results as DuckDB SQL. Doubles are rounded to six places on
both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthloom.functions.months import month_before, month_distance, month_text
from monthloom.operators import blocks, boosting, evaluation, merge, missing, model, presence, profile, rows, selection, statistics, trees
from monthloom.plans import months
from monthloom.plans.encode import encode_layout, encode_layouts
from monthloom.plans.layouts import LAYOUTS, Catalogues
from monthloom.schema import FIELD_GROUPS, FIELD_UNIVERSE, in_window, is_category
from monthloom.sources.retail import read_table, retail_obs, retail_users
from monthloom.sources import sinks, tables
from monthloom.sources.scratch import materialise, scratch_folder
from monthloom.sources.tables import drop_constant, field_range

Query = Callable[[SparkSession, str], DataFrame]

# Catalogue rules: share of users a field must be observed for, the score that admits a field to the
# unordered pairs, and the width of the list behind the ordered ones.
AVERAGE_SHARE, MAXIMUM_SHARE, PAIR_SCORE, RATIO_FIELDS = 0.35, 0.45, 9, 100
# Lengths of the importance lists that stand for hand-picked ones.
KEPT_FIELDS, KEPT_PAIRS, BEST_FIELDS = 4, 8, 10
OFFSET = 429
ROUNDS = 20
# Users whose observations one task reads.
BUCKET_USERS = 25_000
# SQL recomputes one tree split by split.
FIRST_TREE, FIRST_BY_DEPTH = replace(boosting.BY_LEAF, rounds=1), replace(boosting.BY_DEPTH, rounds=1)


class Inputs:
    """Input tables of one query; each is built on first use only."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def users(self) -> DataFrame:
        return retail_users(self.spark, self.folder)

    @cached_property
    def obs(self) -> DataFrame:
        """Observations, recomputed by every action."""
        return retail_obs(self.spark, self.folder, self.users)

    @cached_property
    def tables(self) -> tuple[DataFrame, DataFrame]:
        """Users and observations as stored tables, for queries that read them several times."""
        users = materialise(self.users)
        return users, materialise(retail_obs(self.spark, self.folder, users))

    @cached_property
    def stored(self) -> tuple[DataFrame, DataFrame]:
        """:attr:`tables` bucketed by user: what groups by user reads them without a shuffle, each task a bounded number of users."""
        users = materialise(self.users)
        buckets = max(self.spark.sparkContext.defaultParallelism, users.count() // BUCKET_USERS + 1)
        stored = []
        for df in (users, retail_obs(self.spark, self.folder, users)):
            table = f"monthloom_{uuid.uuid4().hex}"
            sinks.write_bucketed(df, table, buckets, f"{scratch_folder(self.spark)}/{table}")
            stored.append(self.spark.table(table))
        return stored[0], stored[1]

    @cached_property
    def field_users(self) -> DataFrame:
        """Users per behavioural field."""
        users, obs = self.stored
        seen = obs.filter(~is_category()).select("field_id", "user").distinct()
        return materialise(seen.groupBy("field_id").agg(F.count(F.lit(1)).alias("users")))

    def catalogue(self, share: float = 0.0) -> DataFrame:
        """Behavioural fields observed for at least a share of the users."""
        total = self.stored[0].agg(F.count(F.lit(1))).scalar()
        return selection.catalogue_of(self.field_users.filter(F.col("users") >= share * total))

    @cached_property
    def lists(self) -> DataFrame:
        """All field catalogues of the layouts in one table, told apart by name."""
        groups = selection.by_group(self.catalogue()).filter("idx > 0")
        parts = [
            self.catalogue(AVERAGE_SHARE).withColumn("list", F.lit("average")),
            self.catalogue(MAXIMUM_SHARE).withColumn("list", F.lit("maximum")),
            groups.select("field_id", (F.col("idx") - 1).alias("idx"), F.col("group").alias("list")),
        ]
        return materialise(parts[0].unionByName(parts[1]).unionByName(parts[2]))

    def listed(self, name: str) -> DataFrame:
        return self.lists.filter(F.col("list") == name).select("field_id", "idx")

    @property
    def average_fields(self) -> DataFrame:
        return self.listed("average")

    @property
    def maximum_fields(self) -> DataFrame:
        return self.listed("maximum")

    @property
    def rates(self) -> dict[str, DataFrame]:
        """Per group, its fields without the smallest one."""
        return {g.name: self.listed(g.name) for g in FIELD_GROUPS}

    @cached_property
    def importance(self) -> DataFrame:
        """Users per field as its score, under the field's index."""
        return self.catalogue().join(self.field_users, "field_id").select(
            F.col("idx").alias("feature_idx"), F.col("users").cast("double").alias("score")
        )

    @cached_property
    def field_importance(self) -> DataFrame:
        return self.field_users.select("field_id", F.col("users").cast("double").alias("score"))

    @cached_property
    def log_pairs(self) -> DataFrame:
        """Unordered pairs of the fields that reach the score."""
        return selection.pair_candidates(self.field_importance, PAIR_SCORE)

    @cached_property
    def ratio_pairs(self) -> DataFrame:
        return selection.ratio_pair_candidates(self.field_importance, RATIO_FIELDS)

    @cached_property
    def stats(self) -> DataFrame:
        return statistics.minmax_stats(self.stored[1])

    @cached_property
    def change_stats(self) -> DataFrame:
        return drop_constant(statistics.max_change_stats(self.stored[1]))

    @cached_property
    def excluded(self) -> DataFrame:
        """Users with a high balance stand in for the list of users to leave out."""
        customer = read_table(self.spark, self.folder, "customer")
        return customer.filter("c_acctbal >= 9900").select(F.col("c_custkey").alias("user"))

    @cached_property
    def catalogues(self) -> Catalogues:
        windows = (3, 6, 9)
        return Catalogues(
            average={0: self.average_fields, **{k: self.average_fields for k in windows}},
            maximum={0: self.average_fields, **{k: self.maximum_fields for k in windows}},
            rates=self.rates,
            linear=self.average_fields,
            log_pairs=self.log_pairs,
            changes=self.average_fields,
        )

    def encoded(self, layout: str) -> DataFrame:
        users, obs = self.stored
        linear = layout == "linear"
        return encode_layout(
            users,
            obs,
            self.stats,
            LAYOUTS[layout](self.catalogues),
            change_stats=self.change_stats if linear else None,
            excluded=None if linear else self.excluded,
        )

    def predictions(self, multiplier: int, modulus: int) -> DataFrame:
        """Scores that are a fixed function of the user, with ties."""
        score = (F.col("user") * multiplier) % modulus / F.lit(modulus)
        return self.users.select(F.col("user").alias("user_id"), score.alias("ovd_rate"))

    @cached_property
    def truth(self) -> DataFrame:
        return self.users.select(F.col("user").alias("user_id"), "label")

    @cached_property
    def labels(self) -> DataFrame:
        """Label records as the merge jobs read them."""
        return self.users.select(F.col("user").cast("string").alias("user"), "label_month", "label")

    @cached_property
    def untidy_labels(self) -> DataFrame:
        """Labels with a later repeat for every second user and users without actions."""
        repeat = self.labels.filter(F.col("user").cast("int") % 2 == 0).select("user", F.lit("2099-01").alias("label_month"), (1 - F.col("label")).alias("label"))
        idle = self.labels.select(F.concat(F.lit("idle"), "user").alias("user"), "label_month", "label")
        return self.labels.unionByName(repeat).unionByName(idle)

    @cached_property
    def untidy_actions(self) -> DataFrame:
        """Actions with months out of reach, repeated months of smaller text, users without a label and null months."""
        own = materialise(self.actions)
        old = own.withColumn("action_month", month_before(F.col("action_month"), F.lit(60)))
        repeat = own.withColumn("actions", F.lit("0:1"))
        unknown = own.withColumn("user", F.concat(F.lit("unlabelled"), "user"))
        no_month = own.withColumn("action_month", F.lit(None).cast("string"))
        return own.unionByName(old).unionByName(repeat).unionByName(unknown).unionByName(no_month)

    @cached_property
    def actions(self) -> DataFrame:
        """Action records: each month's fields in order, then the smallest id once more with the
        number of fields as its last part, and empty tokens."""
        entry = F.struct("field_id", F.col("value").cast("string").alias("text"))
        months = self.obs.groupBy("user", "dist").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        tokens = F.transform("entries", lambda e: F.concat_ws(":", e["field_id"], e["text"]))
        repeat = F.concat_ws(":", F.col("entries")[0]["field_id"], F.lit("7"), F.size("entries"))
        text = F.concat(F.array_join(tokens, ","), F.lit(",,"), repeat, F.lit(","))
        return months.join(self.users, "user").select(
            F.col("user").cast("string").alias("user"),
            month_text(F.col("label_ordinal") - F.col("dist")).alias("action_month"),
            text.alias("actions"),
        )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _query(build: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, folder: build(Inputs(spark, folder))


# Months and ingest


def month_arithmetic(i: Inputs) -> DataFrame:
    orders = read_table(i.spark, i.folder, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM")
    back = (F.col("o_orderkey") % 12 + 1).cast("int")
    return orders.select(
        "o_orderkey",
        month.alias("month"),
        month_distance(F.lit("1999-01"), month).alias("distance"),
        month_before(month, back).alias("before"),
    )


def window_counts(i: Inputs) -> DataFrame:
    counts = [F.count(F.when(in_window(k), 1)).alias(f"n{k}") for k in (0, 3, 6, 9)]
    return i.obs.groupBy("user").agg(*counts)


def parse_actions(i: Inputs) -> DataFrame:
    return merge.explode_actions(i.actions)


def merge_training(i: Inputs) -> DataFrame:
    return merge.merge_training(i.untidy_labels, i.untidy_actions)[1]


def merge_scoring(i: Inputs) -> DataFrame:
    users, obs = merge.merge_scoring(i.actions, "1998-08")
    return obs.join(users, "user").select("user", "label_month", "label", "dist", "field_id", "value")


def merge_profile_months(i: Inputs) -> DataFrame:
    profiles = merge.to_profiles(i.users, i.obs)
    months = profiles.select("user", "time", "label", F.explode("actions").alias("month", "fields"))
    total = F.aggregate(F.map_values("fields"), F.lit(0.0), lambda a, v: a + v)
    return months.select("user", "time", "label", "month", F.size("fields").alias("n"), total.alias("total"))


def profile_round_trip(i: Inputs) -> DataFrame:
    return merge.from_profiles(merge.to_profiles(i.users, i.obs))[1]


# Aggregates and statistics


def _field_values(agg) -> Query:
    return _query(lambda i: _rounded(statistics.field_values(i.obs, agg), "value"))


def minmax_stats(i: Inputs) -> DataFrame:
    return statistics.minmax_stats(i.obs)


def max_change_stats(i: Inputs) -> DataFrame:
    return statistics.max_change_stats(i.obs)


def varying_change_stats(i: Inputs) -> DataFrame:
    return i.change_stats


def column_presence(i: Inputs) -> DataFrame:
    return _rounded(statistics.column_presence(*i.stored), "presence")


def row_presence(i: Inputs) -> DataFrame:
    users, obs = i.stored
    return statistics.row_presence(users, obs).withColumn("presence", F.round("presence", 9))


def category_rate(i: Inputs) -> DataFrame:
    return _rounded(statistics.category_rate(i.users, i.obs, 4), "rate")


def category_values(i: Inputs) -> DataFrame:
    return statistics.category_values(i.obs, 19)


def presence_windows(i: Inputs) -> DataFrame:
    users, obs = i.stored
    return presence.bitmap_presence(presence.presence_bitmaps(presence.numbered_users(users), obs))


def missing_windows(i: Inputs) -> DataFrame:
    return presence.missing_windows(*i.stored)


def _month_state(i: Inputs) -> DataFrame:
    """A history without its last three months, which are added one by one, the last one twice."""
    path, actions = _new_path(i), materialise(i.actions)
    last = [r["action_month"] for r in actions.select("action_month").distinct().orderBy(F.desc("action_month")).limit(3).collect()]
    months.load(actions.filter(~F.col("action_month").isin(last)), path)
    for month in [*sorted(last), max(last)]:
        months.add_month(actions, month, path)
    return months.read(i.spark, path)


def months_merged(i: Inputs) -> DataFrame:
    return months.merged(_month_state(i), i.labels)


def months_window(i: Inputs) -> DataFrame:
    return _rounded(months.window_values(_month_state(i), i.labels, 6), *months.MEASURES)


# Blocks


def tree_block_avg(i: Inputs) -> DataFrame:
    return _rounded(blocks.tree_block(i.stored[1], i.average_fields, i.stats), "value")


def tree_block_max(i: Inputs) -> DataFrame:
    return _rounded(blocks.tree_block(i.stored[1], i.maximum_fields, i.stats, 6, F.max), "value")


def onehot_block(i: Inputs) -> DataFrame:
    return blocks.onehot_block(i.stored[1], i.average_fields, i.stats, 6)


def _range_of(i: Inputs, name: str) -> DataFrame:
    group = next(g for g in FIELD_GROUPS if g.name == name)
    return field_range(i.spark, group.lo, group.hi)


def tree_rate(i: Inputs) -> DataFrame:
    name = "query_detail"
    return _rounded(blocks.tree_rate(i.stored[1], _range_of(i, name), i.rates[name], i.stats, 3), "value")


def onehot_rate(i: Inputs) -> DataFrame:
    return blocks.onehot_rate(i.stored[1], i.average_fields, i.stats, 6)


def _zero_shares(policy: str) -> Query:
    """The three share blocks where ranges start at 0 and every third user has only zeros; NaN shows as -1."""

    def build(i: Inputs) -> DataFrame:
        stats = i.stats.withColumn("lo", F.lit(0.0))
        obs = i.stored[1].withColumn("value", F.when(F.col("user") % 3 == 0, 0.0).otherwise(F.col("value")))
        name = "query_detail"
        parts = {
            "tree_rate": blocks.tree_rate(obs, _range_of(i, name), i.rates[name], stats, 3, nan_policy=policy),
            "onehot_rate": blocks.onehot_rate(obs, i.average_fields, stats, 6, nan_policy=policy),
            "onehot_topn_rate": blocks.onehot_topn_rate(obs, i.average_fields, stats, 0, 3, nan_policy=policy),
        }
        value = F.when(F.isnan("value"), -1.0).otherwise(F.round("value", 6)).alias("value")
        found = [df.select(F.lit(block).alias("block"), "user", "idx", value) for block, df in parts.items()]
        return found[0].unionByName(found[1]).unionByName(found[2])

    return _query(build)


def onehot_topn_rate(i: Inputs) -> DataFrame:
    return blocks.onehot_topn_rate(i.stored[1], i.average_fields, i.stats, 0, 3)


def tree_log_pair(i: Inputs) -> DataFrame:
    return _rounded(blocks.tree_log_pair(i.stored[1], i.log_pairs, i.stats), "value")


def onehot_log_pair(i: Inputs) -> DataFrame:
    return blocks.onehot_log_pair(i.stored[1], i.log_pairs, i.stats, 6)


def onehot_ratio_pair(i: Inputs) -> DataFrame:
    return blocks.onehot_ratio_pair(i.stored[1], i.ratio_pairs, i.stats)


def tree_max_change(i: Inputs) -> DataFrame:
    return _rounded(blocks.tree_max_change(i.stored[1], i.average_fields), "value")


def onehot_max_change(i: Inputs) -> DataFrame:
    return blocks.onehot_max_change(i.stored[1], i.average_fields, i.change_stats, 6)


def missing_count(i: Inputs) -> DataFrame:
    return missing.missing_count(*i.stored)


def missing_onehot(i: Inputs) -> DataFrame:
    return missing.missing_onehot(*i.stored, 6)


def missing_one_month(i: Inputs) -> DataFrame:
    return _rounded(missing.missing_one_month(i.obs), "value")


def profile_onehot(i: Inputs) -> DataFrame:
    return profile.profile_onehot(*i.stored)


def profile_numeric(i: Inputs) -> DataFrame:
    return profile.profile_numeric(*i.stored)


# Catalogues


def catalog_candidates(i: Inputs) -> DataFrame:
    best = i.field_users.orderBy(F.desc("users"), "field_id").limit(KEPT_FIELDS)
    return selection.candidate_fields(field_range(i.spark, 1, FIELD_UNIVERSE), i.field_users, best)


def pair_candidates(i: Inputs) -> DataFrame:
    total = i.stored[0].agg(F.count(F.lit(1))).scalar()
    frequent = i.field_importance.filter(F.col("score") >= AVERAGE_SHARE * total)
    return selection.pair_candidates(frequent, PAIR_SCORE)


def ratio_pair_candidates(i: Inputs) -> DataFrame:
    return selection.ratio_pair_candidates(i.field_importance, RATIO_FIELDS)


def catalog_pairs_reindex(i: Inputs) -> DataFrame:
    """The pairs whose two fields together have the most users."""
    left = i.field_users.select(F.col("field_id").alias("left_id"), F.col("users").alias("left_users"))
    right = i.field_users.select(F.col("field_id").alias("right_id"), F.col("users").alias("right_users"))
    scored = i.log_pairs.join(left, "left_id").join(right, "right_id")
    best = scored.orderBy(F.desc(F.col("left_users") + F.col("right_users")), "idx").limit(KEPT_PAIRS)
    return selection.selected_pairs(i.log_pairs, best.select(F.col("idx").alias("feature_idx")))


def _by_number(both_orders: bool) -> Query:
    """The pairs whose numbers are the squares of feature numbers, three apart, looked up without building pairs."""

    def build(i: Inputs) -> DataFrame:
        chosen = i.importance.select((F.col("feature_idx") * F.col("feature_idx") * 3).alias("feature_idx"))
        return selection.pairs_by_number(i.field_importance.select("field_id"), chosen, both_orders)

    return _query(build)


def catalog_reindex(i: Inputs) -> DataFrame:
    chosen = i.importance.orderBy(F.desc("score"), "feature_idx").limit(BEST_FIELDS)
    return selection.selected_fields(i.catalogue(), chosen)


def catalog_shifted(i: Inputs) -> DataFrame:
    """A list that numbers features behind a block of ``OFFSET`` others, from 1 on; it names every second field."""
    second = i.importance.filter(F.col("feature_idx") % 2 == 1)
    listed = second.select((F.col("feature_idx") + 1 + OFFSET).alias("feature_idx"), "score")
    shifted = selection.shift_importance(listed, OFFSET + 1).withColumnRenamed("field_id", "idx")
    return selection.catalogue_of(i.catalogue().join(shifted, "idx"))


def field_medians(i: Inputs) -> DataFrame:
    values = statistics.field_values(i.stored[1])
    return _rounded(selection.field_medians(values, i.field_importance), "median")


def catalog_every_fourth(i: Inputs) -> DataFrame:
    return selection.every_nth(i.field_users, "field_id")


def catalog_continuous(i: Inputs) -> DataFrame:
    fields = i.stored[1].select("field_id").distinct()
    return selection.continuous_only(selection.catalogue_of(fields))


def catalog_split_halves(i: Inputs) -> DataFrame:
    """Features 1-16 are averages and 17-32 maxima, each listed from its share of users on."""
    total = i.stored[0].agg(F.count(F.lit(1))).scalar()
    average = i.importance.filter(F.col("score") >= AVERAGE_SHARE * total).select(F.col("feature_idx") + 1)
    maximum = i.importance.filter(F.col("score") >= MAXIMUM_SHARE * total).select(F.col("feature_idx") + 17)
    listed = average.union(maximum).toDF("feature_idx")
    average, maximum = selection.split_halves(i.catalogue(), listed, 16)
    return average.withColumn("half", F.lit("avg")).unionByName(maximum.withColumn("half", F.lit("max")))


def catalog_split_unbounded(i: Inputs) -> DataFrame:
    """Features 1-8 are averages, all later ones maxima: every second field is listed, far beyond twice 8."""
    average = i.importance.filter("feature_idx < 8").select(F.col("feature_idx") + 1)
    maximum = i.importance.filter("feature_idx % 2 = 0").select(F.col("feature_idx") + 9)
    average, maximum = selection.split_halves(i.catalogue(), average.union(maximum).toDF("feature_idx"), 8, bounded=False)
    return average.withColumn("half", F.lit("avg")).unionByName(maximum.withColumn("half", F.lit("max")))


def catalog_rates(i: Inputs) -> DataFrame:
    """Every range id, then install ids, then open-time ids; the list names those with users."""
    install = next(g for g in FIELD_GROUPS if g.name == "app_install")
    installed = i.field_users.filter(install.contains()).select("field_id")
    universe = selection.rate_universe(installed, field_range(i.spark, 131, 96048))
    scored = universe.join(i.field_users, "field_id").select((F.col("idx") + 1).alias("feature_idx"))
    return selection.rate_fields(universe, scored)


def catalog_by_group(i: Inputs) -> DataFrame:
    return selection.by_group(i.catalogue())


def exclude_users(i: Inputs) -> DataFrame:
    return merge.without_users(i.stored[0], i.excluded).select("user", "label_month", "label")


# Layouts


def _layout(name: str) -> Query:
    return _query(
        lambda i: _rounded(
            i.encoded(name).select("user", "label", "feature_size", F.inline("tokens")), "value"
        )
    )


def layouts_together(i: Inputs) -> DataFrame:
    """All layouts that leave the same users out, from one pass."""
    users, obs = i.stored
    named = {name: LAYOUTS[name](i.catalogues) for name in LAYOUTS if name != "linear"}
    together = encode_layouts(users, obs, i.stats, named, excluded=i.excluded)
    return _rounded(together.select("layout", "user", "label", "feature_size", F.inline("tokens")), "value")


def layouts_keeping_nan(i: Inputs) -> DataFrame:
    """The half-year layout where every third user has only zeros and ranges start at 0; a share of a zero total shows as -1."""
    users, obs = i.stored
    zeros = obs.withColumn("value", F.when((F.col("user") % 3 == 0) & ~is_category(), 0.0).otherwise(F.col("value")))
    stats = i.stats.withColumn("lo", F.lit(0.0))
    laid = encode_layout(users, zeros, stats, LAYOUTS["half_year"](i.catalogues), excluded=i.excluded, nan_policy="keep")
    value = F.when(F.isnan("value"), -1.0).otherwise(F.round("value", 6)).alias("value")
    return laid.select("user", "label", "feature_size", F.inline("tokens")).select("user", "label", "feature_size", "idx", value)


def sparse_row_text(i: Inputs) -> DataFrame:
    return rows.to_sparse_rows(i.encoded("half_year"))


def dense_csv_row(i: Inputs) -> DataFrame:
    return rows.to_csv_rows(i.encoded("one_season"))


# Models


def blend_scores(i: Inputs) -> DataFrame:
    tables = [i.predictions(31 + 6 * n, 101) for n in range(4)]
    return _rounded(evaluation.blend_windows(tables), "ovd_rate")


def blend_models(i: Inputs) -> DataFrame:
    return _rounded(evaluation.blend_models(i.predictions(37, 101), i.predictions(53, 97)), "ovd_rate")


def auc(i: Inputs) -> DataFrame:
    return _rounded(evaluation.auc(i.predictions(37, 101), i.truth), "auc")


def grid_scores(i: Inputs) -> DataFrame:
    return _rounded(evaluation.grid_scores(i.predictions(1, 101), i.predictions(1, 211)), "score")


def optimised_grids(i: Inputs) -> DataFrame:
    return _rounded(evaluation.optimised_grids(i.predictions(1, 101), i.predictions(1, 211)), "score")


def grid_association(i: Inputs) -> DataFrame:
    return _rounded(evaluation.grid_association(i.predictions(1, 101), i.predictions(1, 211)), "association")


def correlation(i: Inputs) -> DataFrame:
    return _rounded(evaluation.correlation(i.predictions(1, 101), i.predictions(1, 211)), "correlation")


def holdout_split(i: Inputs) -> DataFrame:
    return model.holdout_split(i.users.select("user", "label"))


def holdout_sample(i: Inputs) -> DataFrame:
    train, validate = model.holdout_sample(i.users.select("user", "label"))
    return train.withColumn("part", F.lit("train")).unionByName(validate.withColumn("part", F.lit("validate")))


def _trained(i: Inputs, encoded: DataFrame | None = None):
    """Trees of ``ROUNDS`` rounds, a setting of these queries, on the rows that are not held out."""
    split = materialise(model.holdout_split(rows.to_vectors(encoded or i.encoded("one_season"))))
    return model.train(split.filter("not is_validation").drop("is_validation"), rounds=ROUNDS), split


def holdout_parts(i: Inputs) -> DataFrame:
    """What any sample must fulfil: the parts are disjoint and together complete, and hold both labels."""
    users = holdout_sample(i).join(i.users.select("user"), "user")
    part = F.col("part") == "validate"
    return users.groupBy("user").agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("label"), F.max(part).alias("held")).agg(
        F.count(F.lit(1)).alias("users"),
        F.max("n").alias("most"),
        F.count_distinct(F.when(F.col("held"), F.col("label"))).cast("int").alias("labels_held"),
        F.avg(F.col("held").cast("int")).between(0.02, 0.3).alias("about_a_tenth"),
    )


def gbt_rounds(i: Inputs) -> DataFrame:
    """What any training must fulfil: a tree per round, a score in [0, 1] for every user once, importances that sum to 1."""
    trees, split = _trained(i)
    total = model.importances(trees, split).agg(F.round(F.sum("score"), 6).alias("importance"))
    scores = model.score(trees, split).agg(
        F.count(F.lit(1)).alias("scored"),
        F.count_distinct("user_id").alias("users"),
        F.min(F.col("ovd_rate").between(0, 1)).alias("in_range"),
    )
    return scores.join(total, F.lit(True)).withColumn("trees", F.lit(trees.getNumTrees))


def gbt_nodes(i: Inputs) -> DataFrame:
    """The saved model as a node table: full binary trees, as many splits counted as there are, and the model's own scores."""
    laid = materialise(i.encoded("one_season"))
    fitted, split = _trained(i, laid)
    path = _new_path(i)
    fitted.write().save(path)
    nodes = trees.read_saved(i.spark, path)
    shape = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.count("feature").alias("inner"), F.count("value").alias("leaves"))
    whole = shape.agg(F.count(F.lit(1)).alias("trees"), F.min((F.col("n") == 2 * F.col("inner") + 1) & (F.col("leaves") == F.col("inner") + 1)).alias("binary"), F.sum("inner").alias("inner"))
    counted = trees.split_counts(nodes).agg(F.sum("score").alias("splits"))
    encoded = laid.withColumn("tokens", F.filter("tokens", lambda t: F.abs(t["value"]) > 0.0001))
    both = trees.score(nodes, encoded, 2.0).withColumnRenamed("ovd_rate", "own").join(model.score(fitted, split), "user_id")
    same = both.agg(F.count(F.lit(1)).alias("users"), F.max(F.abs(F.col("own") - F.col("ovd_rate"))).alias("off"))
    return same.select("users", (F.col("off") < 1e-9).alias("same_scores"), whole.select("trees").scalar().alias("trees"), whole.select("binary").scalar().alias("binary"),
        (counted.scalar() == whole.select("inner").scalar()).alias("counted"))


def _written_rows(i: Inputs) -> DataFrame:
    """Encoded rows as the learners read them: from the text form."""
    return tables.read_encoded(i.spark, _written(i, rows.to_sparse_rows(i.encoded("one_season")), sinks.write_encoded))


def _tree_nodes(settings: boosting.Settings) -> Query:
    """Every node of the first tree by its turns from the root."""

    def build(i: Inputs) -> DataFrame:
        found = trees.paths(boosting.train(_written_rows(i), settings))
        return found.select(
            trees.turns(F.col("path")).alias("path"), (F.col("feature") + 1).alias("feature_idx"), "threshold", F.round("gain", 6).alias("gain"), "cover", F.round("value", 9).alias("value")
        )

    return _query(build)


def boosted_importance(i: Inputs) -> DataFrame:
    """Split counts and gains, both from the node table."""
    return _rounded(trees.importances(boosting.train(_written_rows(i), FIRST_TREE)), "gain")


def boosted_scores(i: Inputs) -> DataFrame:
    encoded = materialise(_written_rows(i))
    scored = trees.score(boosting.train(encoded, FIRST_TREE), encoded)
    return _rounded(scored, "ovd_rate").withColumn("user_id", F.col("user_id").cast("bigint"))


def validation_error(i: Inputs) -> DataFrame:
    """Loss on the users that are held out, after each round over the others."""
    split = materialise(model.holdout_split(_written_rows(i)))
    fitted = boosting.train(split.filter("not is_validation"), FIRST_TREE)
    return _rounded(trees.round_errors(fitted, split.filter("is_validation")), "log_loss")


def gbt_scores(i: Inputs) -> DataFrame:
    return model.score(*_trained(i))


def gbt_importance(i: Inputs) -> DataFrame:
    return model.importances(*_trained(i))


# Files: written below the scratch folder and read back


def _new_path(i: Inputs) -> str:
    return f"{scratch_folder(i.spark)}/{uuid.uuid4().hex}"


def _as_lines(i: Inputs, df: DataFrame) -> str:
    """Path of the columns as tab-separated lines."""
    path = _new_path(i)
    df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns]).alias("value")).write.text(path)
    return path


def _written(i: Inputs, df: DataFrame, write: Callable[[DataFrame, str], None]) -> str:
    path = _new_path(i)
    write(df, path)
    return path


def labels_file(i: Inputs) -> DataFrame:
    return tables.read_labels(i.spark, _as_lines(i, i.labels))


def actions_file(i: Inputs) -> DataFrame:
    return merge.explode_actions(tables.read_actions(i.spark, _as_lines(i, i.actions)))


def profiles_file(i: Inputs) -> DataFrame:
    users, obs = (df.withColumn("user", F.col("user").cast("string")) for df in (i.users, i.obs))
    path = _written(i, merge.to_profiles(users, obs), sinks.write_profiles)
    return merge.from_profiles(tables.read_profiles(i.spark, path))[1]


def catalogue_file(i: Inputs) -> DataFrame:
    return tables.read_catalogue(i.spark, _written(i, i.average_fields, sinks.write_catalogue))


def field_set_file(i: Inputs) -> DataFrame:
    return tables.read_field_set(i.spark, _written(i, i.maximum_fields, sinks.write_catalogue))


def pairs_file(i: Inputs) -> DataFrame:
    return tables.read_pairs(i.spark, _written(i, i.log_pairs, sinks.write_pairs))


def pair_members_file(i: Inputs) -> DataFrame:
    return tables.pair_members(pairs_file(i))


def users_file(i: Inputs) -> DataFrame:
    listed = i.excluded.select(F.col("user").cast("string").alias("user"), F.lit("reason").alias("why"))
    return tables.read_users(i.spark, _as_lines(i, listed))


def minmax_file(i: Inputs) -> DataFrame:
    return tables.read_statistics(i.spark, _written(i, i.stats, sinks.write_statistics))


def varying_file(i: Inputs) -> DataFrame:
    path = _written(i, statistics.max_change_stats(i.stored[1]), sinks.write_statistics)
    return drop_constant(tables.read_statistics(i.spark, path))


def importance_file(i: Inputs) -> DataFrame:
    """Both separators; the written form has a header besides."""
    path = _new_path(i)
    i.importance.select("feature_idx", "score").write.csv(path, sep=",")
    listed = tables.read_importance(i.spark, path)
    own = i.spark.read.csv(_written(i, listed, sinks.write_importance), header=True)
    again = tables.read_importance(i.spark, _as_lines(i, own), sep="\t")
    return listed.withColumn("form", F.lit("comma")).unionByName(again.withColumn("form", F.lit("tab")))


def predictions_file(i: Inputs) -> DataFrame:
    path = _written(i, i.predictions(37, 101), sinks.write_predictions)
    return _rounded(tables.read_predictions(i.spark, path), "ovd_rate").withColumn("user_id", F.col("user_id").cast("bigint"))


def _report(i: Inputs, path: str, key: str, kind: str) -> DataFrame:
    parts = F.split("value", "\t")
    return i.spark.read.text(path).select(parts[0].cast(kind).alias(key), parts[1].alias("presence"))


def column_presence_file(i: Inputs) -> DataFrame:
    return _report(i, _written(i, statistics.column_presence(*i.stored), sinks.write_column_presence), "field_id", "int")


def row_presence_file(i: Inputs) -> DataFrame:
    return _report(i, _written(i, statistics.row_presence(*i.stored), sinks.write_row_presence), "user", "bigint")


def encoded_file(i: Inputs) -> DataFrame:
    """The lines, numbered in the order in which they lie in the files."""
    path = _written(i, rows.to_sparse_rows(i.encoded("half_year")), sinks.write_encoded)
    lines = i.spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), "value")
    parts = F.split("value", "\t", 3)
    named = lines.select("file", "at", parts[0].cast("bigint").alias("user"), parts[1].cast("int").alias("feature_size"), parts[2].alias("features"))
    # In order: no line of a file follows one of a larger user. One row per file meets the window.
    inside = named.withColumn("before", F.lag("user").over(Window.partitionBy("file").orderBy("at")))
    return inside.select("user", "feature_size", "features", F.coalesce(F.col("before") < F.col("user"), F.lit(True)).alias("in_order"))


def encoded_round_trip(i: Inputs) -> DataFrame:
    path = _written(i, rows.to_sparse_rows(i.encoded("half_year")), sinks.write_encoded)
    read = tables.read_encoded(i.spark, path)
    return read.select(F.col("user").cast("bigint").alias("user"), "label", "feature_size", F.inline("tokens"))


def svm_lines(i: Inputs) -> DataFrame:
    return sinks.svm_lines(rows.to_sparse_rows(i.encoded("half_year")))


QUERIES: dict[str, Query] = {
    "labels_file": _query(labels_file),
    "actions_file": _query(actions_file),
    "profiles_file": _query(profiles_file),
    "catalogue_file": _query(catalogue_file),
    "field_set_file": _query(field_set_file),
    "pairs_file": _query(pairs_file),
    "pair_members_file": _query(pair_members_file),
    "users_file": _query(users_file),
    "minmax_file": _query(minmax_file),
    "varying_file": _query(varying_file),
    "importance_file": _query(importance_file),
    "predictions_file": _query(predictions_file),
    "column_presence_file": _query(column_presence_file),
    "row_presence_file": _query(row_presence_file),
    "encoded_file": _query(encoded_file),
    "encoded_round_trip": _query(encoded_round_trip),
    "svm_lines": _query(svm_lines),
    "month_distance": _query(month_arithmetic),
    "window_counts": _query(window_counts),
    "parse_actions": _query(parse_actions),
    "merge_training": _query(merge_training),
    "merge_scoring": _query(merge_scoring),
    "merge_profile_months": _query(merge_profile_months),
    "profile_round_trip": _query(profile_round_trip),
    "field_avg": _field_values(F.avg),
    "field_max": _field_values(F.max),
    "field_min": _field_values(F.min),
    "field_max_change": _field_values(statistics.max_change),
    "minmax_stats": _query(minmax_stats),
    "max_change_stats": _query(max_change_stats),
    "varying_change_stats": _query(varying_change_stats),
    "column_presence": _query(column_presence),
    "row_presence": _query(row_presence),
    "category_rate": _query(category_rate),
    "category_values": _query(category_values),
    "presence_windows": _query(presence_windows),
    "missing_windows": _query(missing_windows),
    "months_merged": _query(months_merged),
    "months_window": _query(months_window),
    "tree_block_avg": _query(tree_block_avg),
    "tree_block_max": _query(tree_block_max),
    "tree_rate": _query(tree_rate),
    "tree_log_pair": _query(tree_log_pair),
    "tree_max_change": _query(tree_max_change),
    "onehot_block": _query(onehot_block),
    "onehot_rate": _query(onehot_rate),
    "onehot_topn_rate": _query(onehot_topn_rate),
    "zero_shares_keep": _zero_shares("keep"),
    "zero_shares_drop": _zero_shares("drop"),
    "onehot_log_pair": _query(onehot_log_pair),
    "onehot_ratio_pair": _query(onehot_ratio_pair),
    "onehot_max_change": _query(onehot_max_change),
    "missing_count": _query(missing_count),
    "missing_onehot": _query(missing_onehot),
    "missing_one_month": _query(missing_one_month),
    "profile_onehot": _query(profile_onehot),
    "profile_numeric": _query(profile_numeric),
    "catalog_candidates": _query(catalog_candidates),
    "pair_candidates": _query(pair_candidates),
    "ratio_pair_candidates": _query(ratio_pair_candidates),
    "catalog_pairs_reindex": _query(catalog_pairs_reindex),
    "catalog_pairs_by_number": _by_number(False),
    "catalog_ratio_pairs_by_number": _by_number(True),
    "catalog_reindex": _query(catalog_reindex),
    "catalog_shifted": _query(catalog_shifted),
    "field_medians": _query(field_medians),
    "catalog_every_fourth": _query(catalog_every_fourth),
    "catalog_continuous": _query(catalog_continuous),
    "catalog_split_halves": _query(catalog_split_halves),
    "catalog_split_unbounded": _query(catalog_split_unbounded),
    "catalog_rates": _query(catalog_rates),
    "catalog_by_group": _query(catalog_by_group),
    "exclude_users": _query(exclude_users),
    **{f"layout_{name}": _layout(name) for name in LAYOUTS},
    "layouts_together": _query(layouts_together),
    "layouts_keeping_nan": _query(layouts_keeping_nan),
    "sparse_row_text": _query(sparse_row_text),
    "dense_csv_row": _query(dense_csv_row),
    "blend_scores": _query(blend_scores),
    "blend_models": _query(blend_models),
    "auc": _query(auc),
    "grid_scores": _query(grid_scores),
    "optimised_grids": _query(optimised_grids),
    "grid_association": _query(grid_association),
    "correlation": _query(correlation),
    "holdout_split": _query(holdout_split),
    "holdout_sample": _query(holdout_sample),
    "gbt_scores": _query(gbt_scores),
    "gbt_importance": _query(gbt_importance),
    "gbt_rounds": _query(gbt_rounds),
    "holdout_parts": _query(holdout_parts),
    "gbt_nodes": _query(gbt_nodes),
    "boosted_tree": _tree_nodes(FIRST_TREE),
    "boosted_tree_by_depth": _tree_nodes(FIRST_BY_DEPTH),
    "boosted_importance": _query(boosted_importance),
    "boosted_scores": _query(boosted_scores),
    "validation_error": _query(validation_error),
}
