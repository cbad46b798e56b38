"""Removal of repeated byte strings: a depth-limited radix sort of suffixes, distributed.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (smaller ``doc_id``, or same
document and earlier start) goes. Suffixes are ordered by their first ``LENGTH`` bytes only, in
passes over digits, most significant first; a suffix that is alone with its digits is dropped before
the next pass, and the groups left after the last are exactly the repeated strings.

* *Anchor.* A string's first digit is the hash of the ``GRAM``-byte substring it ranks lowest in, the
  leftmost on ties; equal strings have it at the same place. Neighbouring suffixes share an anchor,
  so they travel as one *run*: a row per anchor instead of one per byte (about one in thirty).
* *Context.* The second digit hashes all bytes of the run with its shape. A range partitioning and
  sort by (anchor, context, document, row, start) brings equal runs together wherever they are, however
  many: a hot passage spans as many partitions as it needs, and each partition is read as a
  stream. Runs behind the first of their context are repeated as a whole. A context that shares
  its anchor with another one stays *open*.
* *String.* Open runs, and only these, are expanded to their single strings, whose hash is the last
  digit. Runs travel with their bytes to their anchor's task and are expanded there; an anchor with
  more than ``GROUP`` open runs is instead expanded before the shuffle, and the minimum per string,
  combined on the way, tells which start earlier.

Partition borders need the outermost rows of each partition, at most two rows a partition, on the
driver. Digits are 64-bit hashes; two together decide, so 128 bits. Whole texts are read.

Cases: null text has no bytes; texts under ``LENGTH`` bytes are kept whole; a null ``doc_id`` comes
before all others. Runs and ranges belong to a row, named by its ``doc_id`` and a 63-bit hash of its
text: rows that share a ``doc_id`` (or have none) but not a text are documents of their own, in the
order of these hashes; rows equal in both are one document written several times, so a repeated row
removes nothing from its twin; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import map_batches, ready_workers, slices
from monthloom.sources.scratch import materialise

LENGTH, GRAM = 100, 32
GROUP = 4096  # open runs of an anchor that one task compares
SEGMENT = 1 << 18
ROWS = 256  # documents handled at a time
LOWEST = -(1 << 63)
FACTOR = 0x9E3779B97F4A7C15 | 1

RUN = "g bigint, c bigint, doc bigint, row bigint, a bigint, shape int"
RUN_NAMES = ["g", "c", "doc", "row", "a", "shape"]
CONTEXT = "g bigint, doc bigint, row bigint, a bigint, shape int, context binary"
RANGE = "doc bigint, row bigint, start bigint, stop bigint"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte value; powers of ``FACTOR`` and of its inverse modulo 2**64."""
    size = max(2 * SEGMENT, 2 * GROUP * 2 * LENGTH) + LENGTH + 1  # what one call of ``sums`` may get
    up, down = np.full(size, FACTOR, np.uint64), np.full(size, pow(FACTOR, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    values = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)
    return values, np.multiply.accumulate(up), np.multiply.accumulate(down)


def sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which any substring's hash follows."""
    values, up, _ = powers()
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=out[1:])
    return out


def hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each substring ``start:end``, the same wherever it stands."""
    return mixed((prefix[end] - prefix[start]) * powers()[2][start])


def parts(datas: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (index, offset, bytes) of about a segment; long texts in parts that share ``LENGTH - 1`` bytes."""
    group, size = [], 0
    for i, data in enumerate(datas):
        for at in range(0, max(1, len(data) - LENGTH + 1), SEGMENT):
            piece = data[at : at + SEGMENT + LENGTH - 1]
            if len(piece) < LENGTH:
                continue
            if size + len(piece) > 2 * SEGMENT:
                yield group
                group, size = [], 0
            group.append((i, at, piece))
            size += len(piece)
    if group:
        yield group


def runs_of(group: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    """``g, c, member of the group, start within it, shape`` of every run."""
    sizes = np.fromiter((len(p) for _, _, p in group), np.int64, len(group))
    data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
    first = np.cumsum(sizes) - sizes
    prefix = sums(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = hashes(prefix, at, at + GRAM)
    ranked = (gram >> np.uint64(22) << np.uint64(22)) | at.astype(np.uint64)  # ties go to the left
    width, least = 1, ranked
    span = LENGTH - GRAM + 1
    while width < span:  # minimum over ``span`` places by doubling
        step = min(width, span - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    anchor = (least & np.uint64((1 << 22) - 1)).astype(np.int64)
    starts = np.concatenate([np.arange(f, f + n - LENGTH + 1) for f, n in zip(first.tolist(), sizes.tolist(), strict=True)])
    anchor = anchor[starts]
    owner = np.repeat(np.arange(len(group)), sizes - LENGTH + 1)
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
    last = np.append(new[1:], len(starts)) - 1
    a, b, p = starts[new], starts[last], anchor[new]
    shape = (p - a) << 8 | (b - a)
    c = mixed(hashes(prefix, a, b + LENGTH) + shape.astype(np.uint64))
    return gram[p].view(np.int64), c.view(np.int64), owner[new], a - first[owner[new]], shape.astype(np.int32)


def _bytes(column) -> list[bytes]:
    return [b"" if t is None else t.encode() for t in column.to_pylist()]


def runs(docs: DataFrame) -> DataFrame:
    """A row per anchor: its digits, document and row, the run's first start, and the run's shape."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, rows = (batch.column(i).to_numpy() for i in range(2))
            out = []
            for group in parts(_bytes(batch.column(2))):
                g, c, owner, a, shape = runs_of(group)
                member = np.array([i for i, _, _ in group])[owner]
                offset = np.array([at for _, at, _ in group])[owner]
                out.append((g, c, ids[member], rows[member], a + offset, shape))
            kinds = [np.int64] * 5 + [np.int32]
            joined = [np.concatenate([np.zeros(0, k), *x]) for k, x in zip(kinds, zip(*out, strict=True) if out else [()] * 6, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in joined], RUN_NAMES)

        return work

    return map_batches(docs, make, RUN, ROWS)


DUPLICATE, OPEN, EDGE = 0, 1, 2
FOUND = f"kind int, {RUN}, place bigint, open boolean"


def _scan(ordered: DataFrame) -> DataFrame:
    """Duplicate and open runs of sorted runs, and each partition's first and last context as ``EDGE``."""
    names = ["kind", *RUN_NAMES, "place", "open"]

    def rows(kind: int, columns: list[np.ndarray], place: int, is_open) -> pa.RecordBatch:
        n = len(columns[0])
        flags = np.broadcast_to(np.asarray(is_open, bool), n)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), *map(pa.array, columns), pa.array(np.full(n, place)), pa.array(flags)], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        held = None  # the last context's first run, of one row
        joined = False  # whether its anchor has been seen with another context
        at_start = True
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                own = [np.concatenate([h, x]) for h, x in zip(held, own, strict=True)]
            g, c, doc, row, a, _ = own
            head = np.append(True, (g[1:] != g[:-1]) | (c[1:] != c[:-1]))
            first = np.flatnonzero(head)[np.cumsum(head) - 1]
            repeated = (doc != doc[first]) | (row != row[first]) | (a != a[first])
            if repeated.any():
                yield rows(DUPLICATE, [x[repeated] for x in own], place, False)
            heads = [x[head] for x in own]
            same = heads[0][1:] == heads[0][:-1]
            is_open = np.append(joined, same) | np.append(same, False)
            if at_start and len(is_open) > 1:
                yield rows(EDGE, [x[:1] for x in heads], place, is_open[:1])
                at_start = False
            done = is_open.copy()
            done[-1] = False
            if done.any():
                yield rows(OPEN, [x[done] for x in heads], place, True)
            held, joined = [x[-1:] for x in heads], bool(is_open[-1])
        if held is not None:
            if joined:
                yield rows(OPEN, held, place, True)
            yield rows(EDGE, held, place, joined)

    ready_workers(ordered.sparkSession)
    return ordered.mapInArrow(run, FOUND)


def across_borders(edges: list) -> tuple[list[tuple], list[tuple]]:
    """Duplicate and open runs that only two partitions together show; ``edges`` in order, at most two a partition."""
    duplicates, opened = [], []
    true, true_open = None, False
    for place_edges in edges:
        for at, e in enumerate(place_edges):
            row = tuple(e[n] for n in RUN_NAMES)
            if at == 0 and true is not None and row[:2] == true[:2]:
                duplicates.append(row)
                if e["open"] and not true_open:
                    opened.append(true)
                    true_open = True
                continue
            is_open = e["open"]
            if at == 0 and true is not None and row[0] == true[0]:
                opened += [r for r, known in ((true, true_open), (row, is_open)) if not known]
                is_open = True
            true, true_open = row, is_open
    return duplicates, opened


def _packed(docs: DataFrame) -> DataFrame:
    """``doc, row, data``: compressed bytes. All uses shuffle it by document and row alike, so Spark does that once."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            squeeze = zstandard.ZstdCompressor(level=3).compress
            data = pa.array([squeeze(d) for d in _bytes(batch.column(2))], pa.binary())
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), data], ["doc", "row", "data"])

        return work

    return map_batches(docs, make, "doc bigint, row bigint, data binary", ROWS)


def _contexts(packed: DataFrame, opened: DataFrame) -> DataFrame:
    """``g, doc, row, a, shape, context``: the bytes of each open run, of equal rows mostly once."""
    of_row = opened.groupBy("doc", "row").agg(F.collect_list(F.struct("g", "a", "shape")).alias("runs"))

    def make():
        last = None

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal last
            expand = zstandard.ZstdDecompressor().decompress
            out = [[], [], [], [], [], []]
            for doc, row, packed_data, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (doc, row) == last:
                    continue
                last = doc, row
                data = expand(packed_data)
                for r in own:
                    context = data[r["a"] : r["a"] + (r["shape"] & 255) + LENGTH]
                    for column, x in zip(out, (r["g"], doc, row, r["a"], r["shape"], context), strict=True):
                        column.append(x)
            kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
            names = ["g", "doc", "row", "a", "shape", "context"]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names)

        return work

    return map_batches(packed.join(of_row, ["doc", "row"]).select("doc", "row", "data", "runs"), make, CONTEXT, ROWS)


def strings_of(shape: np.ndarray, contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every string of the runs: its run, its place in it, and its hash with the anchor's offset."""
    n = (shape & 255).astype(np.int64) + 1
    run = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    starts = np.cumsum([0, *map(len, contexts)])[:-1][run] + step
    prefix = sums(data)
    offset = (shape >> 8).astype(np.int64)[run] - step
    return run, step, mixed(hashes(prefix, starts, starts + LENGTH) + offset.astype(np.uint64))


def _within_anchor(contexts: DataFrame) -> DataFrame:
    """``doc, row, start, stop`` of strings that start earlier, for anchors with at most ``GROUP`` open runs."""

    def repeated(g: np.ndarray, doc: np.ndarray, row: np.ndarray, a: np.ndarray, shape: np.ndarray, data: list[bytes]) -> pa.RecordBatch:
        run, step, h = strings_of(shape, data)
        order = np.lexsort((run, h, g[run]))  # runs are in the order of their starts
        new = np.append(True, (g[run[order]][1:] != g[run[order]][:-1]) | (h[order][1:] != h[order][:-1]))
        first = run[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
        later = np.zeros(len(run), bool)
        later[order] = (doc[run[order]] != doc[first]) | (row[run[order]] != row[first]) | (a[run[order]] != a[first])
        at = np.flatnonzero(later)
        begins = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (run[at][1:] != run[at][:-1]))) if len(at) else at
        ends = np.append(begins[1:], len(at)) - 1 if len(at) else at
        b, e = at[begins], at[ends]
        columns = (doc[run[b]], row[run[b]], a[run[b]] + step[b], a[run[e]] + step[e] + LENGTH)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["doc", "row", "start", "stop"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                own = [part.column(i).to_numpy(zero_copy_only=False) for i in range(5)] + [part.column(5).to_pylist()]
                if held is not None:
                    own = [np.concatenate([h, x]) for h, x in zip(held[:5], own[:5], strict=True)] + [held[5] + own[5]]
                once = np.flatnonzero(np.append(True, np.logical_or.reduce([x[1:] != x[:-1] for x in own[:4]])))
                if len(once) < len(own[0]):  # equal rows
                    own = [x[once] for x in own[:5]] + [[own[5][i] for i in once.tolist()]]
                last = int(np.searchsorted(own[0], own[0][-1]))  # the last anchor may go on
                if last:
                    yield repeated(*(x[:last] for x in own))
                held = [x[last:] for x in own]
        if held is not None:
            yield repeated(*held)

    ready_workers(contexts.sparkSession)
    return contexts.repartition("g").sortWithinPartitions("g", "doc", "row", "a").mapInArrow(work, RANGE)


def _across_tasks(contexts: DataFrame) -> DataFrame:
    """The same for anchors with any number of open runs: a row per string."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for part in slices(batch, GROUP):
                g, doc, row, a, shape = (part.column(i).to_numpy(zero_copy_only=False) for i in range(5))
                run, step, h = strings_of(shape, part.column(5).to_pylist())
                out.append((g[run], h.view(np.int64), doc[run], row[run], a[run] + step))
            columns = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*out, strict=True) if out else [()] * 5)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["g", "h", "doc", "row", "s"])

        return work

    strings = materialise(map_batches(contexts, make, "g bigint, h bigint, doc bigint, row bigint, s bigint"))
    first = strings.groupBy("g", "h").agg(F.min(F.struct("doc", "row", "s")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = strings.join(first, ["g", "h"]).filter(F.struct("doc", "row", "s") > F.col("first"))
    return later.select("doc", "row", F.col("s").alias("start"), (F.col("s") + LENGTH).alias("stop"))


def repeats(docs: DataFrame) -> DataFrame:
    """``doc, row, start, stop``: byte ranges to remove; they may overlap. Document and row as ``_keyed`` names them."""
    return _ranges(_keyed(docs), _packed(_keyed(docs)))


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc, row, text``: a null id is the lowest number, and only its rows have a negative hash."""
    doc, row = F.col("doc_id").cast("bigint"), F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND((1 << 63) - 1)
    return docs.select(F.coalesce(doc, F.lit(LOWEST)).alias("doc"), F.when(doc.isNull(), row.bitwiseOR(LOWEST)).otherwise(row).alias("row"), "text")


def _ranges(keyed: DataFrame, packed: DataFrame) -> DataFrame:
    spark = keyed.sparkSession
    ordered = runs(keyed).repartitionByRange("g", "c", "doc", "row", "a").sortWithinPartitions("g", "c", "doc", "row", "a")
    found = materialise(_scan(ordered))
    by_place: dict[int, list] = {}
    for row in found.filter(F.col("kind") == EDGE).orderBy("place", "g", "c").collect():
        edges = by_place.setdefault(row["place"], [])
        if not edges or tuple(edges[-1][n] for n in RUN_NAMES) != tuple(row[n] for n in RUN_NAMES):
            edges.append(row)
    duplicates, opened = across_borders(list(by_place.values()))
    whole = found.filter(F.col("kind") == DUPLICATE).select(RUN_NAMES).unionByName(spark.createDataFrame(duplicates, RUN))
    whole = whole.select("doc", "row", F.col("a").alias("start"), (F.col("a") + F.col("shape").bitwiseAND(255) + LENGTH).alias("stop"))
    still_open = found.filter(F.col("kind") == OPEN).select(RUN_NAMES).unionByName(spark.createDataFrame(opened, RUN))
    hot = materialise(still_open.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP).select("g"))
    ranges = whole.unionByName(_within_anchor(_contexts(packed, still_open.join(hot, "g", "left_anti"))))
    if not hot.isEmpty():
        ranges = ranges.unionByName(_across_tasks(_contexts(packed, still_open.join(hot, "g", "left_semi"))))
    return ranges


def remove(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) of every document."""
    packed = _packed(_keyed(docs))
    own = _ranges(_keyed(docs), packed).groupBy("doc", "row").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            expand = zstandard.ZstdDecompressor().decompress
            ids, size, gone, spans, kept = [], [], [], [], []
            for doc, row, packed_data, ranges in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = expand(packed_data)
                out, last, runs_here = [], 0, 0
                for r in sorted(ranges or (), key=lambda r: (r["start"], r["stop"])):
                    start, stop = r["start"], min(r["stop"], len(data))
                    if start >= len(data):
                        continue
                    if start > last or not runs_here:
                        out.append(data[last:start])
                        runs_here += 1
                    last = max(last, stop)
                rest = b"".join([*out, data[last:]])
                ids.append(None if row < 0 else doc)
                size.append(len(data))
                gone.append(len(data) - len(rest))
                spans.append(runs_here)
                kept.append(rest)
            columns = [pa.array(x, pa.int64()) for x in (ids, size, gone, spans)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

        return work

    joined = packed.join(own, ["doc", "row"], "left")
    return map_batches(joined.select("doc", "row", "data", "ranges"), make, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary", ROWS)
