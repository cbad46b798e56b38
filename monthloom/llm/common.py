"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the Unicode property White_Space, the ``\s`` of the tokenizers' patterns.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def crc_remainder(doc_id: str, n: int) -> Column:
    """crc32 of a document id written as text, modulo ``n``; null ids give null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


BATCH_ROWS = 1024


def ready_workers(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from where the driver did, and bounds their batches.

    Texts make rows large: the usual 10,000 of them in an Arrow batch take a hundred megabytes and more on both
    sides of the socket, so the session's limit is lowered to ``BATCH_ROWS`` where it is higher (or absent).
    """
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(limit, "0")) <= BATCH_ROWS:
        spark.conf.set(limit, str(BATCH_ROWS))
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, rows: int | None = None
) -> DataFrame:
    """Runs a per-batch function in Arrow; ``make`` is called once a task and may keep caches.

    With ``rows`` it gets at most so many rows at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, rows or max(1, batch.num_rows)):
                yield work(part)

    ready_workers(df.sparkSession)
    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A batch's texts, null as empty."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(name)), "").to_pylist()


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that what is computed per part stays small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


class Remembered:
    """Values by key; of more than ``most`` those not asked for since the last clearing are forgotten."""

    def __init__(self, most: int):
        self.most, self.now, self.old = most, {}, {}

    def unknown(self, keys: set) -> set:
        """The keys without a value; the others are in ``now`` until the next call."""
        if len(self.now) > self.most:
            self.old, self.now = self.now, {}
        missing = keys.difference(self.now)
        kept = [key for key in missing if key in self.old]
        self.now.update((key, self.old[key]) for key in kept)
        return missing.difference(kept)


def segments(batch: list[str], overlap: int, limit: int = 1 << 18) -> Iterator[list[tuple[int, str]]]:
    """Groups of ``(index, part of that text)`` with about ``limit`` characters each.

    A text longer than that comes in parts that share ``overlap`` characters, so that every run of
    ``overlap + 1`` characters lies in exactly one part.
    """
    group, size = [], 0
    for i, text in enumerate(batch):
        for start in range(0, max(1, len(text) - overlap), limit):
            part = text if len(text) <= limit + overlap else text[start : start + limit + overlap]
            group.append((i, part))
            size += len(part)
            if size >= limit:
                yield group
                group, size = [], 0
            if part is text:
                break
    if group:
        yield group
