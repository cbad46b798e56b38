"""Boosted trees grown leaf by leaf, from histograms that are grouped sums.

Feature values become quantile codes once. For a tree, every row has the gradient and the curvature of the
logistic loss; a leaf's histogram holds their sums and the number of rows per (feature, code). The best split of a
leaf follows from its histogram alone, so leaves are split best first without passing over the data for each: a
pass makes the histograms of all leaves that the order may still reach, the smaller of two siblings
from its rows and the larger as parent less sibling. Leaves that turn out not to be reached are dropped.

Gradients are integers in units of ``1 / UNIT``. Their sums do not depend on the order of rows, differences of
histograms are exact, and equal gains go to the smaller feature and code, so a training gives the same
trees wherever it runs. Only best splits, at most one per leaf, reach the driver.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthloom.operators import trees
from monthloom.operators.ranking import running_totals
from monthloom.operators.rows import to_triples
from monthloom.sources.scratch import materialise

UNIT = 1 << 30
CUT_EVERY = 25  # trees after which the margins are written out

@dataclass(frozen=True)
class Settings:
    """Fixed values of the first of the two learners by default: trees of many leaves without a depth bound."""

    rounds: int = 500
    leaves: int = 63
    depth: int | None = None
    rate: float = 0.025
    l2: float = 0.0
    min_weight: float = 5.0
    min_rows: int = 50
    bins: int = 255
    row_sample: float = 0.8
    sample_every: int = 5
    column_sample: float = 0.8
    seed: int = 0


BY_LEAF = Settings()
# Fixed values of the second learner: depth 5, L2 weight 9, new rows for every tree.
BY_DEPTH = Settings(rounds=1000, leaves=32, depth=5, l2=9.0, min_weight=2.32, min_rows=1, row_sample=0.78, sample_every=1, column_sample=0.76)


def hash_share(*parts: Column | str) -> Column:
    """A number in [0, 1) that depends on the parts' text alone."""
    texts = [F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("#", *texts)), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def quantile_codes(rows: DataFrame, bins: int) -> tuple[DataFrame, DataFrame]:
    """``(user, label, values)`` with codes by feature, and the edges ``(feature, code, upto)``.

    A code is the share of rows with a smaller value, in ``bins`` parts, less that of 0; equal values
    share one. Rows without a token have the value 0 and the code 0, which is not written.
    """
    users = rows.count()
    tokens = to_triples(rows).filter("value <> 0").select("user", (F.col("idx") - 1).alias("feature"), "value")
    counts = materialise(tokens.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    rest = counts.groupBy("feature").agg((F.lit(users) - F.sum("n")).alias("n")).select("feature", F.lit(0.0).alias("value"), "n")
    ranked = running_totals(counts.unionByName(rest), ["feature"], "value", ["n"])
    places = materialise(ranked.select("feature", "value", F.floor(F.col("before_n") * bins / F.col("all_n")).cast("int").alias("place")))
    zero = places.filter("value = 0").select("feature", F.col("place").alias("zero"))
    coded = materialise(places.join(zero, "feature").select("feature", "value", (F.col("place") - F.col("zero")).alias("code")))
    edges = coded.groupBy("feature", "code").agg(F.max("value").alias("upto"))
    entry = F.struct("feature", F.col("code").cast("double").alias("code"))
    placed = tokens.join(coded.filter("code <> 0"), ["feature", "value"])
    gathered = placed.groupBy("user").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    values = F.coalesce(F.map_from_entries("entries"), F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<double>")))
    known = rows.select("user", F.col("label").cast("int").alias("label")).join(gathered, "user", "left")
    return materialise(known.select("user", "label", values.alias("values"))), materialise(edges)


def histograms(rows: DataFrame) -> DataFrame:
    """Sums per (node, feature, code) of rows ``(node, g, h, values)``, code 0 left out."""
    return rows.select("node", "g", "h", F.explode("values").alias("feature", "code")).groupBy("node", "feature", F.col("code").cast("int").alias("code")).agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n")
    )


def _lookup(known: dict[int, int | list[int]], kind: str) -> Column:
    """What the driver knows about the node at hand, as a constant array."""
    by_node = [known.get(i) for i in range(max(known, default=0) + 1)]
    return F.get(F.from_json(F.lit(json.dumps(by_node)), f"array<{kind}>"), F.col("node"))


def with_siblings(parents: DataFrame, direct: DataFrame, pairs: list[tuple[int, int, int]]) -> DataFrame:
    """Histograms of both children for every ``(parent, smaller, larger)``: the larger one's is its parent's less its sibling's."""
    measures = ("g", "h", "n")
    larger = _lookup({s: k for _, s, k in pairs}, "int")
    signs = F.array(F.struct(F.col("node").alias("to"), F.lit(1).alias("sign")), F.struct(larger.alias("to"), F.lit(-1).alias("sign")))
    both = direct.select("feature", "code", *measures, F.inline(signs)).select(F.col("to").alias("node"), "feature", "code", *[(F.col(m) * F.col("sign")).alias(m) for m in measures])
    whole = parents.filter(F.col("node").isin([p for p, _, _ in pairs])).select(_lookup({p: k for p, _, k in pairs}, "int").alias("node"), "feature", "code", *measures)
    return both.unionByName(whole).groupBy("node", "feature", "code").agg(*[F.sum(m).alias(m) for m in measures]).filter("n > 0")


def _part(g: Column, h: Column, l2: float) -> Column:
    """What a leaf with these sums takes off the loss, twice."""
    own = g.cast("double") / UNIT
    return own * own / (h.cast("double") / UNIT + l2)


def best_splits(hists: DataFrame, totals: dict[int, tuple[int, int, int]], settings: Settings, allowed: Column) -> DataFrame:
    """``(node, gain, feature, code, g, h, n)`` of the best split per node; sums are those of the left side.

    ``totals`` has a node's sums. Rows of code 0 have no histogram entry: a split below 0 sums from the left, one
    above 0 subtracts what lies right of it from the node's sums, and lies at the code before.
    """
    order = Window.partitionBy("node", "feature").orderBy("code")  # a row per code
    measures = ("g", "h", "n")
    whole = _lookup({k: list(v) for k, v in totals.items()}, "array<bigint>")
    known = hists.filter(allowed).select("node", "feature", "code", *measures, *[F.get(whole, F.lit(i)).alias(f"all_{m}") for i, m in enumerate(measures)])
    above = F.col("code") > 0
    upto = {m: F.sum(m).over(order.rowsBetween(Window.unboundedPreceding, 0)) for m in measures}
    after = {m: F.sum(m).over(order.rowsBetween(0, Window.unboundedFollowing)) for m in measures}
    before = F.greatest(F.coalesce(F.lag("code").over(order), F.lit(0)), F.lit(0))
    left = [F.when(above, F.col(f"all_{m}") - after[m]).otherwise(upto[m]).alias(m) for m in measures]
    possible = known.select("node", "feature", F.when(above, before).otherwise(F.col("code")).alias("code"), *left, *[f"all_{m}" for m in measures])
    right = {m: F.col(f"all_{m}") - F.col(m) for m in measures}
    for n, h in ((F.col("n"), F.col("h")), (right["n"], right["h"])):
        possible = possible.filter((n >= max(1, settings.min_rows)) & (h.cast("double") / UNIT >= settings.min_weight))
    gain = _part(F.col("g"), F.col("h"), settings.l2) + _part(right["g"], right["h"], settings.l2) - _part(F.col("all_g"), F.col("all_h"), settings.l2)
    best = possible.groupBy("node").agg(F.max(F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("code")).alias("c"), *measures)).alias("b"))
    return best.filter("b.gain > 0").select("node", "b.gain", (-F.col("b.f")).alias("feature"), (-F.col("b.c")).alias("code"), *[f"b.{m}" for m in measures])


@dataclass
class Leaf:
    """A node while its tree grows."""

    depth: int
    g: int
    h: int
    n: int
    split: dict | None = None
    children: tuple[int, int] | None = None

    def value(self, settings: Settings) -> float:
        weight = self.h / UNIT + settings.l2
        return -settings.rate * (self.g / UNIT) / weight if weight > 0 else 0.0


@dataclass
class Growth:
    """The tree so far: every node with a known best split, and which of them best-first order reaches."""

    settings: Settings
    nodes: list[Leaf] = field(default_factory=list)

    def reached(self) -> tuple[list[int], list[int]]:
        """Nodes split in best-first order within the number of leaves, and those of them that have no children yet."""
        front, split, open_ = [], [], []

        def push(i: int) -> None:
            if self.nodes[i].split:
                heapq.heappush(front, (-self.nodes[i].split["gain"], i))

        push(0)
        while front and len(split) + 1 < self.settings.leaves:
            _, i = heapq.heappop(front)
            split.append(i)
            if self.nodes[i].children is None:
                open_.append(i)
            else:
                for child in self.nodes[i].children:
                    push(child)
        return split, open_

    def divide(self, i: int) -> tuple[int, int]:
        """Adds the children of a node and returns them, the smaller one first."""
        node, s = self.nodes[i], self.nodes[i].split
        left = Leaf(node.depth + 1, s["g"], s["h"], s["n"])
        right = Leaf(node.depth + 1, node.g - s["g"], node.h - s["h"], node.n - s["n"])
        node.children = (len(self.nodes), len(self.nodes) + 1)
        self.nodes += [left, right]
        return node.children if left.n <= right.n else node.children[::-1]

    def divisible(self, i: int) -> bool:
        node, s = self.nodes[i], self.settings
        deep = s.depth is not None and node.depth >= s.depth
        return not deep and node.n >= 2 * max(1, s.min_rows) and node.h / UNIT >= 2 * s.min_weight

    def walkable(self, kept: set[int] | None = None) -> list[dict]:
        """The tree over codes as :func:`trees.leaf_of` walks it; only ``kept`` nodes are split."""
        out = []
        for i, node in enumerate(self.nodes):
            if node.children is not None and (kept is None or i in kept):
                s, (left, right) = node.split, node.children
                out.append({"feature": s["feature"], "threshold": float(s["code"]), "left": left, "right": right})
            else:
                out.append({"value": node.value(self.settings)})
        return out

    def table(self, tree: int, kept: set[int], upto: dict[tuple[int, int], float]) -> list[tuple]:
        """Node table rows of the kept part, renumbered from the root down; ``upto`` has the values at the edges."""
        order, number = [0], {0: 0}
        for i in order:
            if i in kept:
                for child in self.nodes[i].children:
                    number[child] = len(order)
                    order.append(child)
        rows = []
        for i in order:
            node, s = self.nodes[i], self.nodes[i].split
            if i in kept:
                left, right = (number[c] for c in node.children)
                rows.append((tree, number[i], s["feature"], upto[s["feature"], s["code"]], s["gain"], float(node.n), None, left, right))
            else:
                rows.append((tree, number[i], None, None, None, float(node.n), node.value(self.settings), None, None))
        return rows


def grow(rows: DataFrame, settings: Settings, allowed: Column) -> tuple[Growth, set[int]]:
    """One tree over ``(g, h, values)``; the growth and the nodes that are split in the end."""
    whole = rows.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in ("g", "h")], F.count(F.lit(1)).alias("n")).head()
    growth = Growth(settings, [Leaf(0, whole["g"], whole["h"], whole["n"])])
    done: list[DataFrame] = []
    pairs: list[tuple[int, int, int]] = []
    wanted = [0] if growth.divisible(0) and settings.leaves > 1 else []
    while wanted:
        if not done:
            hists = histograms(rows.withColumn("node", F.lit(0)))
        else:
            steps = max(node.depth for node in growth.nodes)
            node = trees.leaf_of(F.get(trees.literal([growth.walkable()]), F.lit(0)), F.col("values"), F.lit(steps))
            direct = histograms(rows.withColumn("node", node).filter(F.col("node").isin([s for _, s, _ in pairs])))
            hists = with_siblings(reduce(DataFrame.unionByName, done), direct, pairs)
        done.append(materialise(hists))
        totals = {i: (growth.nodes[i].g, growth.nodes[i].h, growth.nodes[i].n) for i in wanted}
        for found in best_splits(done[-1].filter(F.col("node").isin(wanted)), totals, settings, allowed).collect():  # a row per leaf
            growth.nodes[found["node"]].split = found.asDict()
        pairs = [(i, *growth.divide(i)) for i in growth.reached()[1]]
        wanted = [child for _, *children in pairs for child in children if growth.divisible(child)]
        pairs = [p for p in pairs if growth.divisible(p[1]) or growth.divisible(p[2])]
    return growth, set(growth.reached()[0])


def train(rows: DataFrame, settings: Settings = BY_LEAF) -> DataFrame:
    """Node table of the trees for encoded rows ``(user, label, tokens)``; margins start at 0."""
    coded, edges = quantile_codes(rows, settings.bins)
    base, grown, recent = coded.withColumn("margin", F.lit(0.0)), [], []
    for number in range(settings.rounds):
        total = F.col("margin")
        if recent:
            deepest = max(depth for _, depth in recent)
            total = total + trees.margin(trees.literal([tree for tree, _ in recent]), F.col("values"), F.lit(deepest))
        if len(recent) == CUT_EVERY:
            base, recent, total = materialise(base.withColumn("margin", total)), [], F.col("margin")
        rate = 1 / (1 + F.exp(-total))
        drawn = hash_share("user", F.lit("row"), F.lit(settings.seed), F.lit(number // settings.sample_every)) < settings.row_sample
        allowed = hash_share("feature", F.lit("column"), F.lit(settings.seed), F.lit(number)) < settings.column_sample
        sloped = base.filter(drawn).select("values", rate.alias("p"), "label").select(
            F.round((F.col("p") - F.col("label")) * UNIT).cast("bigint").alias("g"), F.round(F.col("p") * (1 - F.col("p")) * UNIT).cast("bigint").alias("h"), "values"
        )
        sloped.persist(StorageLevel.MEMORY_AND_DISK)  # read by every pass over this tree
        growth, kept = grow(sloped, settings, allowed)
        sloped.unpersist()
        grown.append((growth, kept))
        recent.append((growth.walkable(kept), max((growth.nodes[c].depth for i in kept for c in growth.nodes[i].children), default=0)))
    used = {(growth.nodes[i].split["feature"], growth.nodes[i].split["code"]) for growth, kept in grown for i in kept}
    spark = rows.sparkSession
    asked = materialise(spark.createDataFrame(sorted(used), "feature int, code int"))
    upto = {(r["feature"], r["code"]): r["upto"] for r in edges.join(asked, ["feature", "code"]).collect()}  # a row per split at most
    table = [row for number, (growth, kept) in enumerate(grown) for row in growth.table(number, kept, upto)]
    return materialise(spark.createDataFrame(table, trees.NODE).coalesce(1))
