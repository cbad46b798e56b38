"""Exact deduplication over an extendible-hash index on shared files.

Texts are equal when their UTF-8 bytes are after lower-casing A-Z; a null text counts as empty.

``build_index`` stores one chain per distinct 64-bit key, each in a bucket. Buckets start as one;
while a bucket holds more chains than its capacity it is split on the next key bit, and the
directory doubles whenever a bucket's depth passes the directory's. The histogram that drives the
splits has at most ``2 ** PREFIX_BITS`` rows, whatever the input; the chains themselves never leave
the executors. Owner tasks hold contiguous bucket ranges, that is key ranges.

Most chains have one row and need no text. For the others every batch sends one *packet* per
distinct text it holds, however many copies there are, so a group with a third of all rows crosses
the shuffle as one text per batch. The packets of a chain are compared byte by byte with the chain's
head; those that differ (key collisions) form the next link of the chain and are compared again.

Cases: rows that repeat a ``doc_id`` and text form a group of which one row stays; a null ``doc_id``
is smaller than any other; an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthloom.llm.common import map_batches
from monthloom.sources.scratch import materialise

PREFIX_BITS = 14
BUCKET_CHAINS = 250_000

ENTRY = "doc_id bigint, key bigint, sha binary"
PACKET = "key bigint, text binary, sha binary, members array<bigint>"


@dataclass(frozen=True)
class ExactIndex:
    """``entries`` has a row per document, ``chains`` one per key with its bucket; ``directory[slot]``
    is the bucket of the keys whose first ``depth`` bits are ``slot``."""

    entries: DataFrame
    chains: DataFrame
    directory: list[int]
    depth: int


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _key(data: bytes, key_bits: int) -> int:
    return _signed(xxhash.xxh3_64_intdigest(data) >> (64 - key_bits) << (64 - key_bits))


def _normal(batch: pa.RecordBatch) -> list[bytes]:
    lowered = pc.ascii_lower(pc.fill_null(batch.column(batch.schema.get_field_index("text")), ""))
    return lowered.cast(pa.large_binary() if pa.types.is_large_string(lowered.type) else pa.binary()).to_pylist()


def grow_directory(counts: dict[int, int], capacity: int, bits: int) -> tuple[list[int], int]:
    """Directory and its depth, from the number of chains under each ``bits``-bit key prefix."""
    depth, directory, local = 0, [0], {0: 0}
    sums = [counts.get(prefix, 0) for prefix in range(1 << bits)]
    total = [0]
    for count in sums:
        total.append(total[-1] + count)

    def held(slot: int, at: int) -> int:
        width = bits - at
        return total[(slot + 1) << width] - total[slot << width]

    pending, made = [(0, 0)], 1
    while pending:
        slot, at = pending.pop()
        if held(slot, at) <= capacity or at == bits:
            continue
        if at == depth:  # double the directory: every slot becomes two that share its bucket
            directory = [bucket for bucket in directory for _ in (0, 1)]
            depth += 1
        first = slot << (depth - at)
        bucket, half = directory[first], 1 << (depth - at - 1)
        directory[first + half : first + 2 * half] = [made] * half
        local[bucket] = local[made] = at + 1
        made += 1
        pending += [(2 * slot, at + 1), (2 * slot + 1, at + 1)]
    order = {bucket: i for i, bucket in enumerate(dict.fromkeys(directory))}  # numbered in key order
    return [order[bucket] for bucket in directory], depth


def _prefix(bits: int) -> Column:
    return F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("bigint")


def _bucket(directory: list[int], depth: int) -> Column:
    """Bucket of a key; the directory has at most ``2 ** PREFIX_BITS`` slots."""
    edges = [(slot, bucket) for slot, bucket in enumerate(directory) if not slot or directory[slot - 1] != bucket]
    starts = F.lit([slot for slot, _ in edges])
    return F.aggregate(starts, F.lit(-1), lambda n, start: n + (start <= _prefix(depth)).cast("int"))


def build_index(docs: DataFrame, capacity: int = BUCKET_CHAINS, prefix_bits: int = PREFIX_BITS, key_bits: int = 64) -> ExactIndex:
    """Index of ``docs(doc_id, text)``; ``key_bits`` below 64 makes collisions, for tests."""

    def make():
        def entries(batch: pa.RecordBatch) -> pa.RecordBatch:
            data = _normal(batch)
            keys = pa.array([_key(x, key_bits) for x in data], pa.int64())
            sha = pa.array([hashlib.sha256(x).digest() for x in data], pa.binary())
            return pa.RecordBatch.from_arrays([batch.column(0), keys, sha], ["doc_id", "key", "sha"])

        return entries

    entries = materialise(map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), make, ENTRY))
    chains = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    histogram = chains.groupBy(_prefix(prefix_bits).alias("prefix")).agg(F.count(F.lit(1)).alias("chains")).collect()
    directory, depth = grow_directory({r["prefix"]: r["chains"] for r in histogram}, capacity, prefix_bits)
    owned = chains.withColumn("bucket", _bucket(directory, depth)).repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key")
    return ExactIndex(entries, materialise(owned), directory, depth)


def _packets(docs: DataFrame, key_bits: int) -> DataFrame:
    def make():
        def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
            found: dict[bytes, list] = {}
            for doc_id, data in zip(batch.column(0).to_pylist(), _normal(batch), strict=True):
                found.setdefault(data, []).append(doc_id)
            return pa.RecordBatch.from_pydict(
                {
                    "key": [_key(x, key_bits) for x in found],
                    "text": list(found),
                    "sha": [hashlib.sha256(x).digest() for x in found],
                    "members": list(found.values()),
                },
                pa.schema([("key", pa.int64()), ("text", pa.binary()), ("sha", pa.binary()), ("members", pa.list_(pa.int64()))]),
            )

        return pack

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), make, PACKET)


def dedup(docs: DataFrame, capacity: int = BUCKET_CHAINS, prefix_bits: int = PREFIX_BITS, key_bits: int = 64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, sha`` (binary, of the normalised text)."""
    index = build_index(docs, capacity, prefix_bits, key_bits)
    alone = index.entries.join(index.chains.filter("n = 1").select("key"), "key", "left_semi")
    result = alone.select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    shared = index.chains.filter("n > 1").select("key", "bucket")
    left = materialise(_packets(docs, key_bits).join(shared, "key").withColumn("packet", F.monotonically_increasing_id()))
    while not left.isEmpty():  # a pass per link of the chains; a second one only where different texts share a key
        top = F.max(F.struct(F.array_max("members").alias("doc_id"), "packet")).alias("top")
        heads = left.groupBy("bucket", "key").agg(top).select("key", F.col("top.packet").alias("head"), F.col("top.doc_id").alias("keep_id"))
        head_texts = left.select(F.col("packet").alias("head"), F.col("text").alias("head_text"))
        compared = left.join(heads.join(head_texts, "head"), "key").withColumn("same", F.col("text") == F.col("head_text"))
        compared = materialise(compared.withColumn("text", F.when(~F.col("same"), F.col("text"))).drop("head_text"))
        same = compared.filter("same")
        sizes = same.groupBy("key").agg(F.sum(F.size("members")).cast("bigint").alias("group_size"))
        is_keep = F.transform("members", lambda m: m.eqNullSafe(F.col("keep_id")))
        rows = same.join(sizes, "key").select(
            "packet", "head", "keep_id", "group_size", "sha", (F.array_position(is_keep, True) - 1).alias("first"), F.posexplode("members").alias("at", "doc_id")
        )
        kept = (F.col("packet") == F.col("head")) & (F.col("at") == F.col("first"))
        result = result.unionByName(rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "sha"))
        left = compared.filter("not same").drop("same", "head", "keep_id")
    return result


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of equal texts the one with the largest ``doc_id``."""
    # Helper columns whose names no column of the input starts with.
    mark = "_" * (1 + max(len(c) for c in docs.columns))
    row_id, n_rows, is_kept, sha, kept_sha, at = (mark + name for name in ("id", "rows", "kept", "sha", "kept_sha", "at"))
    decided = materialise(dedup(docs).select("doc_id", "kept", "sha"))
    ids = decided.groupBy(F.col("doc_id").alias(row_id)).agg(F.count(F.lit(1)).alias(n_rows), F.max("kept").alias(is_kept))
    gone, often = ids.filter((F.col(n_rows) == 1) & ~F.col(is_kept)), ids.filter(F.col(n_rows) > 1)
    same_id = F.col("doc_id").eqNullSafe(F.col(row_id))
    single = docs.join(gone.unionByName(often), same_id, "left_anti")
    # Several rows of one id: decided by id and text, and one of equal rows stays.
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    several = docs.join(often, same_id, "left_semi")
    several = several.withColumn(sha, F.sha2(F.translate(F.coalesce("text", F.lit("")), upper, lower).cast("binary"), 256))
    several = several.withColumn(at, F.row_number().over(Window.partitionBy("doc_id", sha).orderBy(F.lit(1))))
    kept = decided.filter("kept").select(F.col("doc_id").alias(row_id), F.lower(F.hex("sha")).alias(kept_sha))
    kept = several.join(kept, same_id & (F.col(sha) == F.col(kept_sha)), "left_semi").filter(F.col(at) == 1)
    return single.unionByName(kept.select(docs.columns))
