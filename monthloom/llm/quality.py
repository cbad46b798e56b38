"""Text quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's raw vector counts its byte trigrams in ``BUCKETS`` hashed buckets, damped by ``log1p``, brought
to length one, followed by three shares of words (see ``styles``); each column is weighted by how
unevenly the training texts use it. The ``DIMS`` leading right singular
vectors of the training matrix project it to a latent vector of length one. Training vectors and
labels are broadcast; every document's cosines with all of them are one blocked matrix product, and
the ``NEIGHBOURS`` most similar vote, each with its cosine to the power ``SHARPNESS``.

The classifier is fitted on at most ``TRAIN_DOCS`` labelled whole texts, those whose ids hash
lowest: a ``TRAIN_DOCS x BUCKETS`` matrix of 32-bit numbers, 32 MB, and a broadcast of about 2 MB.
Every whole text is scored.

Cases: a text under three bytes, empty or null has no vector and gets the training mean; without
labelled rows every score is 0.5; several labels of one document count once, by the largest;
null labels are not used; further columns are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import map_batches, segments, texts
from monthloom.sources.scratch import materialise

BUCKETS, STYLES, DIMS, TRAIN_DOCS = 2048, 3, 64, 4000
CAPITALS, SIGNS = re.compile(r"\b[A-Z]{3,}\b"), re.compile(r"[^\w\s.,](?=\s)")
NEIGHBOURS, SHARPNESS = 25, 8
THRESHOLD = 0.3
BLOCK = 256


@dataclass(frozen=True)
class Voters:
    projection: np.ndarray  # raw columns x DIMS, column weights included
    vectors: np.ndarray  # labelled texts x DIMS, each of length one
    labels: np.ndarray
    mean: float


def raw_vectors(batch: list[str]) -> np.ndarray:
    """``log1p`` of hashed byte-trigram counts, rows of length one (or zero)."""
    counts = np.zeros((len(batch), BUCKETS), np.float32)
    for group in segments(batch, 0):
        parts = [text.encode() for _, text in group]
        data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        owner = np.repeat(np.arange(len(parts)), sizes)
        if len(data) < 3:
            continue
        code = ((data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(21)
        inside = owner[:-2] == owner[2:]
        found = np.bincount((owner[:-2] * BUCKETS + code)[inside], minlength=len(parts) * BUCKETS)
        np.add.at(counts, [i for i, _ in group], found.reshape(len(parts), BUCKETS))
    np.log1p(counts, out=counts)
    counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)
    return np.hstack([counts, np.array([styles(text) for text in batch], np.float32).reshape(-1, STYLES)])


def styles(text: str) -> tuple[float, float, float]:
    """Shares of words equal to the one before, of words all in capitals, and of words ending in a sign."""
    words = text.split()
    if len(words) < 2:
        return 0.0, 0.0, 0.0
    again = sum(map(eq, words, islice(words, 1, None)))
    return again / (len(words) - 1), len(CAPITALS.findall(text)) / len(words), len(SIGNS.findall(text)) / len(words)


def latent_vectors(raw: np.ndarray, projection: np.ndarray) -> np.ndarray:
    out = raw @ projection
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def fit(raw: np.ndarray, labels: np.ndarray) -> Voters:
    """Latent space of the training rows, by subspace iteration from a fixed start."""
    mass = raw / np.maximum(raw.sum(0), 1e-9)
    weight = (1 + (mass * np.log(np.maximum(mass, 1e-12))).sum(0) / np.log(max(2, len(raw)))).astype(np.float32)
    weighted = raw * weight
    basis = np.random.default_rng(1).standard_normal((BUCKETS + STYLES, DIMS)).astype(np.float32)
    for _ in range(8):
        basis, _ = np.linalg.qr(weighted.T @ (weighted @ basis))
    projection = (weight[:, None] * basis).astype(np.float32)
    return Voters(projection, latent_vectors(raw, projection).astype(np.float32), labels.astype(np.float32), float(labels.mean()))


def train(docs: DataFrame, labels: DataFrame, learn_from: Column) -> Voters | None:
    """Voters from ``docs(doc_id, text)`` and ``labels(doc_id, quality)``, among ids that fulfil ``learn_from``."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter(learn_from & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = materialise(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            raw = [row for start in range(0, batch.num_rows, BLOCK) for row in raw_vectors(texts(batch.slice(start, BLOCK)))]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in raw], pa.binary())], ["doc_id", "quality", "raw"])

        return work

    sample = map_batches(rows, make, "doc_id bigint, quality int, raw binary").orderBy("doc_id").limit(TRAIN_DOCS).toArrow()
    if not sample.num_rows:
        return None
    raw = np.frombuffer(b"".join(sample.column("raw").to_pylist()), np.float32).reshape(-1, BUCKETS + STYLES)
    return fit(raw, sample.column("quality").to_numpy())


def vote(latent: np.ndarray, voters: Voters) -> np.ndarray:
    """Scores of latent vectors: labels of the most similar voters, weighted by similarity."""
    cosine = latent @ voters.vectors.T
    k = min(NEIGHBOURS, cosine.shape[1])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosine, near, 1), 1e-6).astype(np.float64) ** SHARPNESS
    return np.clip((weight * voters.labels[near]).sum(1) / weight.sum(1), 0, 1)


def score(docs: DataFrame, voters: Voters | None) -> DataFrame:
    """``doc_id, score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def make():
        own = shared.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = np.full(batch.num_rows, 0.5 if own is None else own.mean)
            for start in range(0, batch.num_rows, BLOCK) if own is not None else ():
                raw = raw_vectors(texts(batch.slice(start, BLOCK)))
                some = raw[:, :BUCKETS].any(axis=1)
                if some.any():
                    scores[start : start + BLOCK][some] = vote(latent_vectors(raw[some], own.projection), own)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

        return work

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_batches(rows, make, "doc_id bigint, score double")
