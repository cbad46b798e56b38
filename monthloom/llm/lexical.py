"""Ranked search of many queries at once, with shared term sets evaluated once.

The score of a document for an item is a sum over the item's terms, so what two items share is a sum that
both need. Items are taken in blocks; for a block

1. the term sets its items share are mined: the largest intersection of two items that saves work
   becomes a node, which stands for its terms in every item that holds them all. Nodes may hold earlier
   nodes. The result is a directed acyclic graph: terms, shared nodes, items.
2. One pass over the texts leaves a posting row a document: its length and its counts of the block's
   terms, written out. Document frequencies and the corpus totals are counted from those rows.
3. A second pass over the postings fills the documents' term scores, then every node once, in the order
   of the graph, as partial accumulators of a batch of documents, then the items from nodes and the terms
   left over. A task keeps the best ``k`` documents per item; the best of all tasks are the result.

A block holds at most ``BLOCK_ITEMS`` items and, unless one item alone has more, ``BLOCK_TERMS`` terms, so
what is broadcast is bounded; every block passes over all documents. Tasks hold a batch's accumulators in
matrices of ``CELLS`` numbers.

Cases: a null or empty text has no terms, as a document and as an item; such documents count nowhere, such
items have no rows; of rows that share an item_id the one with the smallest text asks, a null item_id is an
id; repeated documents are candidates each; documents without id come after all others of their score;
texts may be arbitrarily long; further columns are not looked at; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthloom.llm.common import ready_workers, slices
from monthloom.llm.divergence import occurrences
from monthloom.operators.ranking import running_totals
from monthloom.sources.scratch import materialise

TOP = 20
BLOCK_ITEMS, BLOCK_TERMS = 1024, 1 << 16
CELLS = 1 << 22
SCALE = 1_000_000_000
LENGTH_SHARE = 25  # of 100: how much a document's length counts
LONG = 1 << 62

# Digits, letters and every byte of a character beyond ASCII; all else separates.
ALPHABET = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

TERMS = "item_id bigint, terms array<struct<term:binary,n:bigint>>"
POSTING = "doc_id bigint, length bigint, terms array<int>, counts array<bigint>"
ENTRY = "item int, doc_id bigint, score bigint"


def text_terms(text: pa.StringScalar) -> Counter:
    return occurrences(text.as_buffer().to_pybytes(), ALPHABET) if text.is_valid else Counter()


@dataclass(frozen=True)
class Graph:
    """Columns 0.. are the leaves ``(term, repeats)``, then the shared nodes in the order they can be filled."""

    leaves: list[tuple[int, int]]
    nodes: list[list[int]]
    items: list[list[int]]

    @property
    def columns(self) -> int:
        return len(self.leaves) + len(self.nodes)


def shared_sets(items: list[dict[int, int]]) -> Graph:
    """The evaluation graph of items ``{term: repeats}``: nodes for the term sets they share.

    Each round takes the two items with the largest intersection. Its columns become a node wherever an
    item holds all of them, provided that this needs fewer additions than before.
    """
    leaves = sorted({leaf for item in items for leaf in item.items()})
    place = {leaf: i for i, leaf in enumerate(leaves)}
    held = [{place[leaf] for leaf in item.items()} for item in items]
    member = np.zeros((len(items), len(leaves)), np.float32)
    for i, own in enumerate(held):
        member[i, list(own)] = 1
    common = np.rint(member @ member.T).astype(np.int32)
    np.fill_diagonal(common, 0)
    nodes: list[list[int]] = []
    while common.size and (most := int(common.max())) >= 2:
        i, j = divmod(int(common.argmax()), len(items))
        node = held[i] & held[j]
        users = [u for u, own in enumerate(held) if node <= own]
        if (len(node) - 1) * (len(users) - 1) <= 1:  # two items with two columns in common: nothing is saved
            if most <= 2:
                break
            common[i, j] = common[j, i] = 0
            continue
        column = len(leaves) + len(nodes)
        nodes.append(sorted(node))
        for u in users:
            held[u] = (held[u] - node) | {column}
        for u in users:
            row = np.array([len(held[u] & own) for own in held], np.int32)
            row[u] = 0
            common[u], common[:, u] = row, row
    return Graph(leaves, nodes, [sorted(own) for own in held])


def item_blocks(items: DataFrame, block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, terms, block)`` of the items that have terms, written out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [text_terms(t) for t in part.column(1)]
                terms = pa.array([[{"term": t, "n": n} for t, n in sorted(f.items())] for f in found], pa.list_(pa.struct([("term", pa.binary()), ("n", pa.int64())])))
                yield pa.RecordBatch.from_arrays([part.column(0), terms], ["item_id", "terms"])

    ready_workers(items.sparkSession)
    one = items.groupBy(F.col("item_id").cast("bigint").alias("item_id")).agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    found = materialise(one.mapInArrow(run, TERMS).filter(F.size("terms") > 0))
    sizes = found.select("item_id", F.size("terms").cast("bigint").alias("n"), F.lit(1).cast("bigint").alias("one"))
    placed = running_totals(sizes, [], "item_id", ["n", "one"])
    block = F.concat_ws("-", F.expr(f"before_n div {block_terms}"), F.expr(f"before_one div {block_items}"))
    return materialise(found.join(placed.select(F.col("item_id").alias("id"), block.alias("block")), F.col("item_id").eqNullSafe(F.col("id"))).drop("id"))


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``POSTING`` rows of all documents that have a term, written out."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most BLOCK_TERMS terms, or one item's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch):
                ids, lengths, terms, counts = [], [], [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    if found := text_terms(text):
                        own = [t for t in found if t in known]
                        ids.append(doc_id)
                        lengths.append(found.total())
                        terms.append([known[t] for t in own])
                        counts.append([found[t] for t in own])
                columns = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "length", "terms", "counts"])

    ready_workers(docs.sparkSession)
    return materialise(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, POSTING))


def length_norms(length: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The length part of every document's score; without bound on the way where a long would not do."""
    if int(length.max(initial=0)) * documents * LENGTH_SHARE >= LONG:
        return np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(n) * documents // total for n in length], np.int64)
    return 100 - LENGTH_SHARE + LENGTH_SHARE * length * documents // total


class Best:
    """An item's best ``k`` documents so far; ties to the smaller id, and no id last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.ids, self.lacks = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, lacks: np.ndarray) -> None:
        least = max(1, int(self.score[-1])) if len(self.score) == self.k else 1
        near = np.flatnonzero(score >= least)
        if len(near) > self.k:
            kth = np.partition(score[near], len(near) - self.k)[len(near) - self.k]
            near = near[score[near] >= kth]
        if not len(near):
            return
        score, ids, lacks = (np.concatenate((a, b[near])) for a, b in ((self.score, score), (self.ids, ids), (self.lacks, lacks)))
        order = np.lexsort((ids, lacks, -score))[: self.k]
        self.score, self.ids, self.lacks = score[order], ids[order], lacks[order]


def accumulate(graph: Graph, term_scores: np.ndarray) -> np.ndarray:
    """Items by documents: every shared node is summed once, then the items over nodes and leaves."""
    filled = np.zeros((graph.columns, term_scores.shape[1]), np.int64)
    for column, (term, repeats) in enumerate(graph.leaves):
        np.multiply(term_scores[term], repeats, out=filled[column])
    for column, members in enumerate(graph.nodes, len(graph.leaves)):
        filled[members].sum(axis=0, out=filled[column])
    return np.array([filled[members].sum(axis=0) for members in graph.items])


def best_documents(posted: DataFrame, graph: Graph, weights: np.ndarray, documents: int, total: int, k: int, cells: int = CELLS) -> DataFrame:
    """Every task's best ``ENTRY`` rows; ``item`` is the item's place in the block."""
    shared = posted.sparkSession.sparkContext.broadcast((graph, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weights = shared.value
        best = [Best(k) for _ in graph.items]
        rows = max(1, cells // (graph.columns + len(weights) + len(graph.items)))
        for batch in batches:
            for part in slices(batch, rows):
                ids, length, terms, counts = part.columns
                lacks = ids.is_null().to_numpy(zero_copy_only=False)
                norm = length_norms(length.to_numpy(), documents, total)
                row = np.repeat(np.arange(part.num_rows), terms.value_lengths().to_numpy())
                term, n = terms.flatten().to_numpy(), counts.flatten().to_numpy()
                scores = np.zeros((len(weights), part.num_rows), np.int64)
                scores[term, row] = weights[term] * (SCALE * n // (1000 * n + 12 * norm[row]))
                known = ids.fill_null(0).to_numpy()
                for one, found in zip(best, accumulate(graph, scores), strict=True):
                    one.add(found, known, lacks)
        item = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        held = [np.concatenate([getattr(b, name) for b in best]) if best else np.zeros(0) for name in ("ids", "lacks", "score")]
        columns = [pa.array(item, pa.int32()), pa.array(held[0], pa.int64(), mask=held[1].astype(bool)), pa.array(held[2], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    ready_workers(posted.sparkSession)
    return posted.mapInArrow(run, ENTRY)


def _block(docs: DataFrame, block: pa.Table, k: int, cells: int) -> DataFrame:
    """``(item_id, rank, doc_id, score)`` of the items of one block."""
    spark = docs.sparkSession
    ids = block.column("item_id").to_pylist()
    own = [{t["term"]: t["n"] for t in terms} for terms in block.column("terms").to_pylist()]
    vocabulary = {t: i for i, t in enumerate(sorted({t for item in own for t in item}))}
    posted = postings(docs, vocabulary)
    size = posted.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("total")).head()
    counted = posted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    holding = np.zeros(len(vocabulary), np.int64)
    for r in counted.collect():  # a row per term of the block
        holding[r["term"]] = r["n"]
    weights = np.array([math.floor(1000 * math.log((2 * size["n"] + 2) / (2 * int(n) + 1))) for n in holding], np.int64)
    graph = shared_sets([{vocabulary[t]: n for t, n in item.items()} for item in own])
    found = best_documents(posted, graph, weights, size["n"], size["total"] or 1, k, cells)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id bigint")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS, cells: int = CELLS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the best documents ``(doc_id, text)`` for each of the items ``(item_id, text)``."""
    placed = item_blocks(items, block_items, block_terms)
    numbers = [r["block"] for r in placed.select("block").distinct().orderBy("block").collect()]
    found = []
    for number in numbers:
        block = placed.filter(F.col("block") == number).orderBy("item_id").toArrow()
        entries = _block(docs, block, k, cells)
        found.append(materialise(entries) if len(numbers) > 1 else entries)
    if not found:
        return docs.filter("false").select(
            F.lit(0).cast("bigint").alias("item_id"), F.lit(0).alias("rank"), F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")
        )
    return reduce(DataFrame.unionByName, found)
