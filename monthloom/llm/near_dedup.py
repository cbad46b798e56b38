"""Near-duplicate groups with HyperMinHash sketches.

A document's set holds 64-bit hashes of its word shingles. Each of ``REGISTERS`` buckets keeps the
smallest hash that falls into it, compressed to its leading-zero count and ``MANTISSA`` further bits.
Documents with equal sets form a class first, so copies cost one row each from then on.

Candidates: registers left empty borrow from the filled bucket that a fixed random order puts first,
and the filled sketch is cut into ``BANDS`` bands. Two sets of similarity 0.8 agree in a given band
with probability 0.8 ** 8, and in none of 64 with 8e-6. In each band bucket with several classes,
one of them, drawn by hash, is the pivot the others are compared with; that is linear in the
bucket. A pair is estimated from its sketches, corrected for registers that agree by chance, and what
is not clearly below the threshold is confirmed on the full sets. Linked classes merge, and only what
is then still in a bucket with classes of another component meets the next drawn pivot, as long as
at least one in ``WORTHWHILE`` pairs of a draw is a link and at most ``MORE_DRAWS`` times more. Pairs
whose sizes rule the threshold out are never made.

Pivots only make the rest small. What is still undecided then is compared pair by pair on the full
sets: buckets that share classes form a cell, and a cell, or each of its buckets where that is less
work, is cut into parts of bounded rows and bytes. A task takes two parts and counts all common
shingles of their rows at once, so no pair becomes a row of a table; it returns the links that join
components, at most one per component. The work of a cell still grows with the square of its size.

Cases: null text and text without words have an empty set, linked with nothing; a text with fewer
words than a shingle is one shingle; a null ``doc_id`` is its own group; rows that repeat a
``doc_id`` are one document, for which the row with the smallest set hash stands; further columns
are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import map_batches, slices
from monthloom.llm.components import components
from monthloom.sources.scratch import materialise

SHINGLE, SIMILARITY = 2, (80, 100)
BUCKET_BITS, MANTISSA, ROWS = 9, 10, 8
REGISTERS = 1 << BUCKET_BITS
BANDS = REGISTERS // ROWS
SIGMAS = 6
MORE_DRAWS, WORTHWHILE = 8, 50
PART_ROWS, PART_BYTES = 512, 1 << 21

SKETCH = "doc_id bigint, n_shingles bigint, finger binary, sketch binary"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text's words, A-Z lower-cased."""
    words = (text or "").encode().lower().split()  # bytes: only ASCII is lower-cased or white space
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    width = min(width, len(ids))
    value = np.full(len(ids) - width + 1, width, np.uint64)
    for k in range(width):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + ids[k : len(ids) - width + 1 + k])
    return np.unique(value)


def sketch_of(own: np.ndarray) -> np.ndarray:
    """Registers of a sorted set: 0 if empty, else larger for a smaller hash in the bucket."""
    registers = np.zeros(REGISTERS, np.uint16)
    bucket = (own >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = own[first] << np.uint64(BUCKET_BITS) | np.uint64(1 << BUCKET_BITS)
    # The bits of a double are exponent, then mantissa: the leading-zero count and the bits after it.
    code = (rest.astype(np.float64).view(np.uint64) >> np.uint64(52 - MANTISSA)).astype(np.int64) - ((1023 + BUCKET_BITS - 1) << MANTISSA)
    registers[bucket[first]] = 65535 - code
    return registers


def borrow_order() -> np.ndarray:
    """For each register, all registers in the fixed random order it borrows in."""
    return np.random.default_rng(7).random((REGISTERS, REGISTERS), np.float32).argsort(axis=1).astype(np.int16)


def filled(registers: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Sketches (a row each, none without any register) whose empty registers borrow from filled ones."""
    out = registers.copy()
    row, place = np.nonzero(registers == 0)
    for k in range(REGISTERS):
        if not len(row):
            break
        value = registers[row, order[place, k]]
        out[row, place] = value
        still = value == 0
        row, place = row[still], place[still]
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A 64-bit key per row and band of filled sketches."""
    halves = np.ascontiguousarray(sketches).view(np.uint64).reshape(len(sketches), BANDS, -1)
    value = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), halves.shape[:2])
    for k in range(halves.shape[2]):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + halves[:, :, k])
    return value.view(np.int64)


def chance_agreement(n: int, m: int) -> float:
    """Chance that two filled registers of unrelated sets of these sizes agree."""
    levels = 0.5 ** np.arange(0, 64 - BUCKET_BITS)

    def share(size: int) -> np.ndarray:
        load = size / REGISTERS
        return (np.exp(-load * levels / 2) - np.exp(-load * levels)) / -math.expm1(-load)

    return float((share(n) * share(m)).sum()) / (1 << MANTISSA)


def estimate(a: np.ndarray, b: np.ndarray, n: int, m: int) -> tuple[float, float]:
    """Jaccard estimate from two sketches, corrected for chance agreement, and its standard error."""
    used = int(np.count_nonzero(a | b))
    chance = chance_agreement(n, m)
    agree = int(np.count_nonzero((a == b) & (a > 0)))
    value = min(1.0, max(0.0, (agree / used - chance) / (1 - chance)))
    return value, math.sqrt(0.25 / used)


def sketches(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, finger, sketch``; ``finger`` is a 128-bit hash of the whole set."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            size, finger, sketch = [], [], []
            for text in batch.column(1).to_pylist():
                own = shingle_set(text, width)
                size.append(len(own))
                finger.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                sketch.append(sketch_of(own).tobytes() if len(own) else None)
            columns = [batch.column(0), pa.array(size, pa.int64()), pa.array(finger, pa.binary()), pa.array(sketch, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "finger", "sketch"])

        return work

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), make, SKETCH)


def _bands(classes: DataFrame) -> DataFrame:
    """``key, id`` for every band of every class."""

    def make():
        order = borrow_order()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = []
            for part in slices(batch, 512):
                rows = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                keys.append(band_keys(filled(rows, order)).ravel())
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], ["key", "id"])

        return work

    return map_batches(classes.select("id", "sketch"), make, "key bigint, id bigint")


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose estimate does not rule the threshold out."""
    need, out_of = SIMILARITY
    side = lambda name: classes.select(F.col("id").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            a, b, n, m, first, second = (c.to_pylist() for c in batch.columns)
            keep = []
            for i in range(batch.num_rows):
                value, error = estimate(np.frombuffer(first[i], np.uint16), np.frombuffer(second[i], np.uint16), n[i], m[i])
                keep.append(value + SIGMAS * error >= need / out_of)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return work

    return map_batches(both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b"), make, "a bigint, b bigint")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``id, own``: the full sets of the documents listed by ``id, finger``."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            own = [shingle_set(t, width).tobytes() for t in batch.column(1).to_pylist()]
            finger = [xxhash.xxh3_128_digest(x) for x in own]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(finger, pa.binary()), pa.array(own, pa.binary())], ["id", "finger", "own"])

        return work

    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").join(wanted.select("id"), "id", "left_semi")
    found = map_batches(rows, make, "id bigint, finger binary, own binary")
    return found.join(wanted, ["id", "finger"], "left_semi").select("id", "own").dropDuplicates(["id"])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    need, out_of = SIMILARITY
    side = lambda name: sets.select(F.col("id").alias(name), F.col("own").alias(f"own_{name}"))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep, seen = [], (None, None)
            for key, a, b in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if seen[0] != key:
                    seen = (key, np.frombuffer(b.as_py(), np.uint64))
                one = np.frombuffer(a.as_py(), np.uint64)
                common = len(np.intersect1d(one, seen[1], assume_unique=True))
                keep.append(out_of * common >= need * (len(one) + len(seen[1]) - common))
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return work

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "own_a", "own_b")
    return map_batches(both, make, "a bigint, b bigint")


def _undecided(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``key, id, n_shingles, component`` of the buckets that hold several components."""
    placed = members.withColumn("component", F.col("id"))
    if labels is not None:
        placed = members.join(labels, members["id"] == labels["node"], "left").select("key", "id", "n_shingles", F.coalesce("component", "id").alias("component"))
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    return placed.join(several.select("key"), "key")


def _star_pairs(members: DataFrame, draw: int) -> DataFrame:
    """In each bucket, the members of other components, of a size near enough, paired with a drawn pivot.

    A draw ranks the classes alike in all buckets, so a class meets few different pivots in its 64.
    """
    need, out_of = SIMILARITY
    pivot = F.min(F.struct(F.xxhash64("id", F.lit(draw)).alias("order"), "id", "n_shingles", "component")).alias("pivot")
    pairs = members.join(members.groupBy("key").agg(pivot), "key").filter(F.col("component") != F.col("pivot.component"))
    sizes = F.col("n_shingles"), F.col("pivot.n_shingles")
    pairs = pairs.filter(F.least(*sizes) * out_of >= F.greatest(*sizes) * need)
    return pairs.select(F.greatest("id", "pivot.id").alias("a"), F.least("id", "pivot.id").alias("b")).distinct()


def _units(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``unit, whole, parts, id, component``: what has to be compared with each other, and in how many parts.

    A unit is a cell of buckets that share classes (``whole``) or, where all pairs of a cell are more
    work than those of its buckets, a bucket.
    """
    buckets = materialise(members.groupBy("key").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 2"))  # two have met
    members = members.join(buckets.select("key", "low"), "key")
    cells = components(members.select(F.col("low").alias("a"), F.col("id").alias("b"))).toDF("node", "of")
    members = members.join(cells, F.col("id") == F.col("node"), "left").select("key", "id", "component", F.coalesce("of", "id").alias("cell"))
    members = materialise(members.join(sets.select("id", F.length("own").alias("bytes")), "id"))

    def sized(rows: DataFrame, unit: str) -> DataFrame:
        of = rows.groupBy(unit).agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("all_bytes"))
        parts = F.greatest(F.ceil(F.col("n") / PART_ROWS), F.ceil(F.col("all_bytes") / PART_BYTES))
        return of.withColumn("parts", parts).withColumn("work", F.col("n") * F.col("parts"))

    once = members.select("cell", "id", "component", "bytes").distinct()
    by_cell, by_bucket = sized(once, "cell"), materialise(sized(members, "key"))
    apart = by_bucket.join(members.select("key", "cell").distinct(), "key").groupBy("cell").agg(F.sum("work").alias("apart"))
    by_cell = materialise(by_cell.join(apart, "cell").withColumn("whole", F.col("work") <= F.col("apart")))
    cell = once.join(by_cell.filter("whole").select("cell", "parts"), "cell")
    bucket = members.join(by_cell.filter("not whole").select("cell"), "cell").join(by_bucket.select("key", "parts"), "key")
    return cell.select(F.col("cell").alias("unit"), F.lit(True).alias("whole"), "parts", "id", "component").unionByName(
        bucket.select(F.col("key").alias("unit"), F.lit(False).alias("whole"), "parts", "id", "component")
    )


def common_counts(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """How many values each set of ``first`` has in common with each of ``second``."""
    shape = (len(first), len(second))
    counts = np.zeros(shape, np.int64)
    _, code = np.unique(np.concatenate([*first, *second]), return_inverse=True)
    row = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (first, second)]
    code = [code[: len(row[0])], code[len(row[0]) :]]
    held = [np.bincount(c, minlength=max(int(x.max(initial=-1)) for x in code) + 1) for c in code]
    product = held[0] * held[1]
    # Values held by many are counted by multiplying 0/1 matrices, the others by going through their pairs.
    dense = product * 1024 > shape[0] * shape[1]
    places = np.flatnonzero(dense)
    for start in range(0, len(places), 1024):
        column = np.full(len(dense), -1)
        column[places[start : start + 1024]] = np.arange(len(places[start : start + 1024]))
        sides = []
        for r, c, n in zip(row, code, shape, strict=True):
            matrix, here = np.zeros((n, 1024), np.float32), column[c] >= 0
            matrix[r[here], column[c[here]]] = 1
            sides.append(matrix)
        counts += (sides[0] @ sides[1].T).astype(np.int64)
    few = (product > 0) & ~dense
    left, right = (np.flatnonzero(few[c]) for c in code)
    right = right[np.argsort(code[1][right], kind="stable")]
    start = np.searchsorted(code[1][right], code[0][left])
    times = held[1][code[0][left]]
    total = np.cumsum(times)
    for lo, hi in zip(cuts := [0, *(np.flatnonzero(np.diff(total >> 20)) + 1), len(left)], cuts[1:], strict=False):
        n = times[lo:hi]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pair = np.repeat(row[0][left[lo:hi]], n) * shape[1] + row[1][right[np.repeat(start[lo:hi], n) + inner]]
        counts += np.bincount(pair, minlength=counts.size).reshape(shape)
    return counts


def joining(linked: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[tuple[int, int]]:
    """Of the marked pairs of rows, as many as join the components ``first`` and ``second`` of the rows."""
    _, label = np.unique(np.concatenate([first, second]), return_inverse=True)
    one, two, found = label[: len(first)].copy(), label[len(first) :].copy(), []
    for i in np.flatnonzero(linked.any(axis=1)):
        other = np.flatnonzero(linked[i] & (two != one[i]))
        merged, place = np.unique(two[other], return_index=True)
        found += [(int(i), int(other[k])) for k in place]
        for side in (one, two):
            side[np.isin(side, merged)] = one[i]
    return found


def _rest(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` that join components, from all pairs of what the undecided buckets hold."""
    need, out_of = SIMILARITY
    placed = _units(members, sets).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    placed = placed.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).join(sets, "id")

    def work(table: pa.Table) -> pa.Table:
        ids, component, part = (table.column(c).to_numpy() for c in ("id", "component", "part"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        one, two = np.flatnonzero(part == low), np.flatnonzero(part == high)
        pairs = []
        if len(one) and len(two) and component.min() != component.max():
            own = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("own")]
            size = np.array([len(x) for x in own])
            common = common_counts([own[i] for i in one], [own[i] for i in two])
            linked = out_of * common >= need * (size[one][:, None] + size[two] - common)
            linked &= component[one][:, None] != component[two]
            pairs = [sorted((int(ids[one[i]]), int(ids[two[j]]))) for i, j in joining(linked, component[one], component[two])]
        return pa.table({"a": pa.array([p[1] for p in pairs], pa.int64()), "b": pa.array([p[0] for p in pairs], pa.int64())})

    columns = placed.select("unit", "whole", "low", "high", "part", "id", "component", "own")
    return columns.groupBy("unit", "whole", "low", "high").applyInArrow(work, "a bigint, b bigint")


def groups(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; ``component_id`` is the group's smallest id."""
    rows = materialise(sketches(docs, width))
    some = rows.filter("n_shingles > 0 and doc_id is not null").select("doc_id", "finger").distinct()
    some = materialise(some.groupBy("doc_id").agg(F.min("finger").alias("finger")))
    by_set = materialise(some.groupBy("finger").agg(F.min("doc_id").alias("id")))
    classes = materialise(by_set.join(rows.withColumnRenamed("doc_id", "id"), ["finger", "id"]).dropDuplicates(["id"]))
    shared = _bands(classes).groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low <> high")
    members = _bands(classes).join(shared.select("key"), "key")
    members = materialise(members.join(classes.select("id", "n_shingles"), "id").select("key", "id", "n_shingles"))
    classes = materialise(classes.join(members.select("id").distinct(), "id", "left_semi"))
    sets = materialise(_sets(docs, classes.select("id", "finger"), width))

    links = tried = labels = None
    for draw in range(1 + MORE_DRAWS):
        members = materialise(_undecided(members.select("key", "id", "n_shingles"), labels))
        pairs = _star_pairs(members, draw)
        pairs = materialise(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        tried = pairs if tried is None else tried.unionByName(pairs)
        new = materialise(_confirmed(_likely(pairs, classes), sets))
        n_new = new.count()
        if n_new:
            links = new if links is None else links.unionByName(new)
        if n_new * WORTHWHILE < max(1, pairs.count()):
            break  # the rest may meet these few links again
        labels = components(links)
    else:
        members = materialise(_undecided(members.select("key", "id", "n_shingles"), labels))
    new = materialise(_rest(members, sets))
    if not new.isEmpty():
        links = new if links is None else links.unionByName(new)
    if links is not None:
        labels = components(links)
    found = rows.join(some.join(by_set, "finger").select("doc_id", "id"), "doc_id", "left")
    if labels is not None:
        found = found.join(labels, F.col("id") == labels["node"], "left").withColumn("id", F.coalesce("component", "id"))
    return found.select("doc_id", "n_shingles", F.coalesce("id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: of each group the document with the smallest id."""
    gone = groups(docs, width).filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
