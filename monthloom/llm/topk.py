"""Exact top-k inner products by the three-phase uniform threshold.

Vectors become integers, ``floor(1024 x)``. A score is the sum of ``SLICES`` partial scores over
slices of the dimensions, each of which orders the candidates in a list of its own.

1. Every task finds the head of each list among its candidates, scores those entries fully, and sends
   the best ``k`` per query. The k-th best of all is a score the true k-th reaches at least: the cutoff.
2. The cutoffs are broadcast. A candidate whose partial scores all lie below ``cutoff / SLICES`` sums
   to less than the cutoff, so the entries at or above it are sufficient.
3. Those are resolved: full scores, and of the ones that reach the cutoff the best ``k`` per query
   and task. Their best ``k``, ties to the smaller id, are the result.

Queries are taken in blocks of ``QUERY_BLOCK`` (bounded broadcast, bounded lists); every block passes
over all candidates once per phase. Nothing grows with the candidates but the number of tasks.

Cases: rows with a null id, a null vector or null or non-finite components take no part; vectors of
different lengths meet as if the shorter went on with zeros; sums are exact at any magnitude, and
written scores are held within a long; rows that repeat an id are candidates each, but none for their
own id, for which the smallest of their vectors asks; further columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthloom.llm.common import ready_workers
from monthloom.sources.scratch import materialise

SCALE, SLICES = 1024, 4
QUERY_BLOCK, TILE = 4096, 1024
EXACT = float(1 << 52)
LONG = (1 << 63) - 1

ENTRY = "query_id bigint, vec_id bigint, score bigint"


def integer_rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and integer vectors of the rows that take part, a matrix per length and tile."""
    for start in range(0, batch.num_rows, TILE):
        ids, vectors = (c.slice(start, TILE) for c in batch.columns)
        by_length: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        for i, vector in zip(ids.to_pylist(), vectors, strict=True):
            own = np.floor(SCALE * vector.values.to_numpy(zero_copy_only=False))
            if np.isfinite(own).all():
                of_length = by_length.setdefault(len(own), ([], []))
                of_length[0].append(i)
                of_length[1].append(own)
        for length, (own_ids, own) in by_length.items():
            yield np.array(own_ids, np.int64), np.array(own, np.float64).reshape(len(own), length)


def partial_scores(queries: np.ndarray, vectors: np.ndarray) -> list[np.ndarray]:
    """The slices' score matrices, exact: doubles where these suffice, else integers without bound."""
    length = min(queries.shape[1], vectors.shape[1])
    a, b = queries[:, :length], vectors[:, :length]
    if length and np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * length >= EXACT:
        a, b = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b))
    edges = np.linspace(0, length, SLICES + 1).astype(int)
    zero = np.zeros((len(a), len(b)), a.dtype)
    return [a[:, lo:hi] @ b[:, lo:hi].T if hi > lo else zero for lo, hi in zip(edges, edges[1:], strict=False)]


class Best:
    """The best ``k`` entries of every query so far, ties to the smaller id."""

    def __init__(self, k: int):
        self.k = k
        self.query, self.ids, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        query, ids, score = (np.concatenate(x) for x in ((self.query, query), (self.ids, ids), (self.score, score)))
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        start = np.flatnonzero(np.diff(query, prepend=-1))
        rank = np.arange(len(query)) - np.repeat(start, np.diff(np.append(start, len(query))))
        keep = rank < self.k
        self.query, self.ids, self.score = query[keep], ids[keep], score[keep]


def _pass(candidates: DataFrame, block: list[tuple[np.ndarray, np.ndarray]], k: int, choose: Callable) -> DataFrame:
    """Every task's best entries among those ``choose(first query, partial scores, full scores)`` marks."""
    shared = candidates.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        query_ids = np.concatenate([ids for ids, _ in shared.value])
        for batch in batches:
            for ids, vectors in integer_rows(batch):
                first = 0
                for own_ids, queries in shared.value:
                    parts = partial_scores(queries, vectors)
                    full = sum(parts[1:], parts[0])
                    marked = choose(first, parts, full) & (own_ids[:, None] != ids)
                    q, c = np.nonzero(marked)
                    if len(q):
                        best.add(q + first, ids[c], full[q, c])
                    first += len(own_ids)
        score = [max(-LONG - 1, min(LONG, int(s))) for s in best.score]
        yield pa.RecordBatch.from_arrays([pa.array(query_ids[best.query]), pa.array(best.ids), pa.array(score, pa.int64())], ["query_id", "vec_id", "score"])

    ready_workers(candidates.sparkSession)
    return candidates.mapInArrow(run, ENTRY)


def _ranked(entries: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return entries.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def heads(k: int) -> Callable:
    """Phase 1: entries among the first ``k`` of a slice's list in this tile."""

    def choose(first: int, parts: list[np.ndarray], full: np.ndarray) -> np.ndarray:
        marked = np.zeros(full.shape, bool)
        n = min(k + 1, full.shape[1])  # one more, as the query itself may be among them
        for part in parts:
            near = np.argpartition(-part, n - 1, axis=1)[:, :n]
            np.put_along_axis(marked, near, True, 1)
        return marked

    return choose


def sufficient(cutoffs: np.ndarray) -> Callable:
    """Phases 2 and 3: entries with a partial score at the threshold that reach the cutoff in full."""

    def choose(first: int, parts: list[np.ndarray], full: np.ndarray) -> np.ndarray:
        cutoff = cutoffs[first : first + len(full), None]
        reach = np.zeros(full.shape, bool)
        for part in parts:
            reach |= (part * SLICES >= cutoff).astype(bool)
        return reach & (full >= cutoff).astype(bool)

    return choose


def cutoff_of(score: int | None) -> float:
    """The score as a double that is not above it."""
    return -np.inf if score is None else float(score) if abs(score) < EXACT else np.nextafter(float(score), -np.inf)


def search(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of ``vectors(vec_id, embedding)`` for each query."""
    sound = F.forall("embedding", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
    queries = materialise(rows.filter(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    blocks = -(-queries.count() // QUERY_BLOCK)
    result = None
    for number in range(blocks):  # ids are spread by hash, so blocks are about even
        own = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).orderBy("vec_id").toArrow()
        block = [m for batch in own.combine_chunks().to_batches() for m in integer_rows(batch)]
        if block:
            first = _ranked(_pass(rows, block, k, heads(k)), k).groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
            least = {r["query_id"]: r["least"] for r in first.filter(F.col("n") == k).collect()}  # a row per query of the block
            cutoffs = np.array([cutoff_of(least.get(int(i))) for ids, _ in block for i in ids])
            entries = _ranked(_pass(rows, block, k, sufficient(cutoffs)), k).select("query_id", "rank", "vec_id", "score")
            if blocks > 1:
                entries = materialise(entries)
            result = entries if result is None else result.unionByName(entries)
    if result is None:
        return rows.filter("false").select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("bigint").alias("score"))
    return result
