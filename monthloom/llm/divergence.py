"""How the sources of a language differ: one-hot level products over the counts of terms.

A group is a (language, source) pair, and its level of a term is how often the term occurs in it. The
price of a term for two groups depends on their two levels alone, so what has to be known of a pair
of groups is one joint table: how many terms have level c here and d there.

1. Tasks count terms and send a row per (language, source, term). A language keeps the terms that enough of
   its documents hold.
2. The kept terms of a language are cut into blocks, its sources into tiles. A task takes a block and two
   tiles. Indicator columns for (group, level) times the transpose of the others are the joint tables of all
   their pairs. Levels below ``DENSE`` are columns of a matrix, and their product is a matrix product in
   single precision, exact as long as no table entry reaches 2 ** 24. The few terms with a higher level
   have columns of a single entry or little more; the product of those is counted entry by entry.
3. The task prices its tables; the sum over the blocks is the sum over all terms, as prices add up.
4. A language's own counts stand for one more group that every source is compared with, term by term.

Numbers are exact: prices are computed as integers, and sums stay below 2 ** 63 because the rates of a
group sum to about ``SCALE``.

Cases: null text, language and source are empty ones; a group without terms is a group, and a language
without kept terms has pairs of value 0; repeated rows count each; a term may be arbitrarily long, and a text
is cut into words in pieces; doc_id and further columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthloom.llm.common import ready_workers
from monthloom.sources.scratch import materialise

SCALE = 1_000_000_000
MIN_DOCUMENTS, MOST_TERMS = 3, 200
TERMS, TILE = 1 << 14, 64  # terms in a block, sources in a tile
DENSE = 16
HELD = 1 << 18  # counts a task gathers before it sends them
PIECE = 1 << 20

COUNTED = "lang string, source string, term string, n bigint, docs bigint"
PRICED = "lang string, a int, b int, value bigint, terms bigint"
# Letters are A-Z, a-z and every byte of a character beyond ASCII; all else separates.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def pieces(text: bytes) -> Iterator[bytes]:
    """Parts of a text of single spaces and words, cut at spaces, each about ``PIECE`` bytes unless one word is longer."""
    start = 0
    while len(text) - start > PIECE:
        end = text.find(b" ", start + PIECE)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def occurrences(text: bytes, alphabet: bytes) -> Counter:
    """The words of a text with the number of times each occurs, after ``alphabet`` has made all else spaces."""
    found = Counter()
    for piece in pieces(text.translate(alphabet)):
        found.update(piece.split())
    return found


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``COUNTED`` rows: partial counts, and a row without term for every group.

    What a task holds is sent whenever ``HELD`` counts and groups have come together.
    """
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    names = ["lang", "source", "term", "n", "docs"]

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            size = len(n) + 1
            terms = pa.array([None, *n], pa.binary()).cast(pa.string())
            found, held = pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[t] for t in n)], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), terms, found, held], names)

    held = 0
    for batch in batches:
        langs, sources = (pc.fill_null(batch.column(i), "").to_pylist() for i in range(2))
        for lang, source, text in zip(langs, sources, batch.column(2), strict=True):
            if (lang, source) not in groups:
                groups[lang, source] = Counter(), Counter()
                held += 1
            n, docs = groups[lang, source]
            before = len(n)
            if text.is_valid:
                own = occurrences(text.as_buffer().to_pybytes(), LETTERS)
                n.update(own)
                docs.update(own.keys())
            held += len(n) - before
            if held >= HELD:
                yield from sent()
                groups.clear()
                held = 0
    yield from sent()


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, total, leads)`` of the terms each language keeps, and a row without term per group.

    ``n`` counts within the source, ``total`` within the language; ``leads`` marks one row per term.
    """
    ready_workers(docs.sparkSession)
    partial = docs.select("lang", "source", "text").mapInArrow(count_terms, COUNTED)
    # Tasks have combined their rows; one shuffle brings a term together for both groupings.
    counts = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = counts.groupBy("lang", "term").agg(
        F.collect_list(F.struct("source", "n")).alias("own"), F.sum("n").alias("total"), F.sum("docs").alias("docs")
    )
    kept = by_term.filter(F.col("term").isNull() | (F.col("docs") >= MIN_DOCUMENTS))
    each = kept.select("lang", F.posexplode("own").alias("place", "own"), "term", "total")
    return materialise(each.select("lang", "own.source", "term", "own.n", "total", ((F.col("place") == 0) & F.col("term").isNotNull()).alias("leads")))


def group_sizes(counts: DataFrame) -> DataFrame:
    """``(lang, source, number, sources, n, total, terms)`` per group: its place in the language, sums of counts, kept terms."""
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count(F.when(F.col("leads"), 1)).alias("leads"))
    lang = Window.partitionBy("lang")  # as many rows as sources; the result has their square
    placed = own.select(
        "*",
        (F.row_number().over(lang.orderBy("source")) - 1).alias("number"),
        F.count(F.lit(1)).over(lang).cast("int").alias("sources"),
        F.sum("n").over(lang).alias("total"),
        F.sum("leads").over(lang).alias("terms"),
    )
    return materialise(placed.drop("leads"))


def rate(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a count in ``SCALE`` parts, an exact integer."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.expr("1L") + F.call_function("div", (wide(n) + 1) * F.lit(SCALE).cast("decimal(10,0)"), wide(total) + wide(terms))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Side:
    """The groups of a tile over the terms of a block, as level codes and indicator columns."""

    def __init__(self, levels: np.ndarray, sizes: np.ndarray, terms: int, dense: int):
        self.levels = levels  # (terms, groups)
        self.rates = [lambda c, n=max(1, int(n) + terms): 1 + SCALE * (int(c) + 1) // n for n in sizes]
        low = np.minimum(levels, dense)
        self.dense = np.zeros((len(levels), levels.shape[1] * dense), np.float32)
        rows, groups = np.nonzero(low < dense)
        self.dense[rows, groups * dense + low[rows, groups]] = 1
        self.low_rates = np.array([[r(c) for c in range(dense)] for r in self.rates], np.int64).reshape(len(sizes), dense)

    def priced(self, group: int, levels: np.ndarray) -> np.ndarray:
        own, place = np.unique(levels, return_inverse=True)
        return np.array([self.rates[group](c) for c in own], np.int64)[place]


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def joint_prices(left: Side, right: Side, dense: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of prices over all terms of the block for every (left, right) pair, in both directions."""
    a, b = left.levels.shape[1], right.levels.shape[1]
    tables = np.rint(left.dense.T @ right.dense).astype(np.int64).reshape(a, dense, b, dense)
    p, q = left.low_rates[:, :, None, None], right.low_rates[None, None, :, :]
    there = np.einsum("icjd,icjd->ij", tables, divergences(p, q))
    back = np.einsum("icjd,icjd->ij", tables, divergences(q, p))
    high = np.flatnonzero((left.levels >= dense).any(axis=1) | (right.levels >= dense).any(axis=1))
    x, y = left.levels[high], right.levels[high]
    for i in range(a):
        for j in range(b):
            rest = (x[:, i] >= dense) | (y[:, j] >= dense)
            c, d = x[rest, i], y[rest, j]
            if not len(c):
                continue
            levels_c, code_c = np.unique(c, return_inverse=True)
            levels_d, code_d = np.unique(d, return_inverse=True)
            cells, n = np.unique(code_c * len(levels_d) + code_d, return_counts=True)
            p, q = left.priced(i, levels_c[cells // len(levels_d)]), right.priced(j, levels_d[cells % len(levels_d)])
            there[i, j] += (n * divergences(p, q)).sum()
            back[i, j] += (n * divergences(q, p)).sum()
    return there, back


def price_block(keys: tuple, table: pa.Table, tile: int, dense: int) -> pa.Table:
    """``PRICED`` rows of one block of terms and two tiles of sources, for every pair and the terms the block shows."""
    first, second = keys[2].as_py(), keys[3].as_py()
    marks = table.filter(pc.is_null(table.column("term")))
    order = np.argsort(number := marks.column("number").to_numpy())
    number, size = number[order], marks.column("size").to_numpy()[order]
    terms = marks.column("terms")[0].as_py()
    entries = table.filter(pc.is_valid(table.column("term")))
    coded = entries.column("term").combine_chunks().dictionary_encode()
    row = coded.indices.to_numpy()
    place = np.searchsorted(number, entries.column("number").to_numpy())
    levels = np.zeros((len(coded.dictionary), len(number)), np.int64)
    levels[row, place] = entries.column("n").to_numpy()
    tiles = [number // tile == t for t in (first, second)]
    left, right = (Side(levels[:, t], size[t], terms, dense) for t in tiles)
    there, back = joint_prices(left, right, dense)
    a, b = (g.ravel() for g in np.meshgrid(number[tiles[0]], number[tiles[1]], indexing="ij"))
    pairs = [(a, b, there.ravel())] + ([(b, a, back.ravel())] if first != second else [])
    a, b, value = (np.concatenate(x) for x in zip(*pairs, strict=True))
    other = a != b
    n = int(other.sum())
    return pa.table(
        {
            "lang": pa.array([keys[0].as_py()] * n, pa.string()),
            "a": pa.array(a[other], pa.int32()),
            "b": pa.array(b[other], pa.int32()),
            "value": pa.array(value[other], pa.int64()),
            "terms": pa.array([len(levels)] * n, pa.int64()),
        }
    )


def pair_values(counts: DataFrame, groups: DataFrame, terms: int = TERMS, tile: int = TILE, dense: int = DENSE) -> DataFrame:
    """``(lang, source, other, value)`` for every two sources of a language, in both orders."""
    ready_workers(counts.sparkSession)
    spread = groups.select(
        "lang",
        "source",
        "number",
        "terms",
        F.col("n").alias("size"),
        F.greatest(F.lit(1), F.ceil(F.col("terms") / terms)).cast("int").alias("blocks"),
        F.floor((F.col("sources") - 1) / tile).cast("int").alias("last"),
    )
    entries = counts.filter("term is not null").join(spread.drop("size"), ["lang", "source"])
    entries = entries.select("lang", "number", "term", "n", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "last")
    marks = spread.select("lang", "number", "terms", "size", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "last")
    own = F.floor(F.col("number") / tile).cast("int")
    cells = (
        entries.unionByName(marks, allowMissingColumns=True)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .select("lang", "block", F.least(own, "other").alias("first"), F.greatest(own, "other").alias("second"), "number", "term", "n", "size", "terms")
    )
    summed = cells.groupBy("lang", "block", "first", "second").applyInArrow(lambda keys, table: price_block(keys, table, tile, dense), PRICED)
    by_pair = summed.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("shown"))
    side = lambda name: groups.select("lang", F.col("number").alias(name), F.col("source").alias(f"source_{name}"), F.col("n").alias(f"n_{name}"), *(["terms"] if name == "a" else []))
    whole = by_pair.join(side("a"), ["lang", "a"]).join(side("b"), ["lang", "b"])
    # Terms that neither of two tiles holds are in no block's tables: level 0 in both groups.
    none, kept = F.lit(0), F.greatest(F.col("terms"), F.lit(1))
    absent = (F.col("terms") - F.col("shown")) * divergence(rate(none, F.col("n_a"), kept), rate(none, F.col("n_b"), kept))
    return whole.select("lang", F.col("source_a").alias("source"), F.col("source_b").alias("other"), (F.col("value") + absent).alias("value"))


def term_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, term, value)`` of the terms a source uses more than its language does."""
    joined = counts.filter("term is not null and n > 0").withColumnRenamed("total", "of_term").join(groups.withColumnRenamed("n", "size"), ["lang", "source"])
    p, q = rate(F.col("n"), F.col("size"), F.col("terms")), rate(F.col("of_term"), F.col("total"), F.col("terms"))
    priced = joined.select("lang", "source", "term", p.alias("p"), q.alias("q")).filter("p > q")
    return priced.select("lang", "source", "term", divergence(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: all other sources, and the terms that set a source apart the most."""
    counts = term_counts(docs)
    groups = group_sizes(counts)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    pairs = pair_values(counts, groups).withColumnRenamed("other", "item").select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
    terms = term_values(counts, groups).withColumnRenamed("term", "item").select("lang", "source", F.lit("term").alias("part"), "item", "value", rank)
    return pairs.unionByName(terms.filter(F.col("rank") <= MOST_TERMS))
