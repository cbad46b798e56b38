"""Language identification with bit-sliced Bloom filters over character n-grams.

One filter serves all languages: slot ``s`` holds a bit mask with a bit per language, in words of
``WORD`` bits, so a lookup of an n-gram reads ``HASHES`` slots and the bitwise AND of their masks names
every language that contains it. A language's score counts its bits over all n-grams of the text (a popcount per bit),
less what its own filter's fill lets through by chance: with ``N`` n-grams, ``h`` hits and a chance
``p``, ``(h - p N) / (1 - p)``.

An n-gram belongs to a language when at least ``MIN_SHARE`` of that language's training documents
contain it. Training reads at most ``TRAIN_DOCS`` whole documents a language, those whose ids hash
lowest; the filter has ``2 ** SLOT_BITS`` slots whatever the corpus, so the broadcast is 8 MB for each
``WORD`` languages and does not grow with the documents. Prediction reads every whole text; texts over a segment come in
parts, which share characters and are not padded at the cuts, so that they have the n-grams of the whole.

Cases: null text and text without a letter give ``und`` with score 0; text too short or too odd for
any known n-gram gives the language with most training documents, score 0; without any training row
all are ``und``; ties go to the language first in the alphabet; repeated rows are predicted alike;
further columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import map_batches, segments, texts

GRAM, SLOT_BITS, HASHES = 4, 20, 3
TRAIN_DOCS, MIN_SHARE, WORD = 2000, 0.01, 64
ENOUGH = 20
UNDETERMINED = "und"
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass(frozen=True)
class LanguageFilter:
    languages: list[str]  # by bit
    prior: str
    slots: np.ndarray  # uint64 masks, a row per word
    chance: np.ndarray  # by bit, of a false hit


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def padded(batch: list[str]) -> list[str]:
    """Lower-cased texts with space around them."""
    return [f"  {text.lower()}  " for text in batch]


def grams(group: list[tuple[int, str]], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of ``padded`` texts or their parts, the entry of ``group`` each comes from, and letters per entry.

    Whatever is no letter counts as one space; n-grams with two spaces in a row or no letter are left out.
    """
    parts = [text for _, text in group]
    codes = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    owner = np.repeat(np.arange(len(parts)), sizes)
    letter = letters[codes]
    codes[~letter] = 32
    n = max(0, len(codes) - GRAM + 1)
    value = np.zeros(n, np.uint64)
    gap = owner[:n] != owner[GRAM - 1 : GRAM - 1 + n]  # from one entry into the next
    for k in range(GRAM):
        value *= np.uint64(0x100000001B3)
        value += codes[k : k + n]
        if k:
            gap |= ~(letter[k - 1 : k - 1 + n] | letter[k : k + n])
    good = ~gap
    return value[good], owner[:n][good], np.bincount(owner[letter], minlength=len(parts))


def slots_of(value: np.ndarray, which: int) -> np.ndarray:
    mixed = (value ^ (value >> np.uint64(29))) * np.uint64(FACTORS[which])
    return (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def train(docs: DataFrame, learn_from) -> LanguageFilter:
    """Filter learnt from the rows of ``docs(doc_id, text, lang)`` that fulfil the condition ``learn_from``."""
    rows = docs.filter(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    sizes = rows.groupBy("lang").count().orderBy("lang").collect()
    if not sizes:
        return LanguageFilter([], UNDETERMINED, np.zeros((1, 1 << SLOT_BITS), np.uint64), np.zeros(0))
    languages = [r["lang"] for r in sizes]
    # A hash threshold keeps about TRAIN_DOCS of each language; small languages stay whole.
    known = [(r["lang"], TRAIN_DOCS / r["count"], min(r["count"], TRAIN_DOCS) * MIN_SHARE, i) for i, r in enumerate(sizes)]
    known = docs.sparkSession.createDataFrame(known, "lang string, share double, floor double, place int")
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("share") * 1_000_000
    letters = _letters()

    def make():
        def count(batch: pa.RecordBatch) -> pa.RecordBatch:
            langs = batch.column(1).to_pylist()
            found: dict[str, list[np.ndarray]] = {}
            before = None
            for group in segments(padded(texts(batch, "text")), GRAM - 1):
                value, owner, _ = grams(group, letters)
                ends = np.searchsorted(owner, np.arange(len(group) + 1))
                for k, (i, _) in enumerate(group):
                    own = np.unique(value[ends[k] : ends[k + 1]])
                    if before == (i, langs[i]):  # another part of the same text
                        found[langs[i]][-1] = np.union1d(found[langs[i]][-1], own)
                    else:
                        found.setdefault(langs[i], []).append(own)
                    before = i, langs[i]
            out = []
            for lang, parts in found.items():
                value, n = np.unique(np.concatenate(parts), return_counts=True)
                out.append((lang, value.view(np.int64), n))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang for lang, value, _ in out for _ in range(len(value))], pa.string()),
                    pa.array(np.concatenate([v for _, v, _ in out])),
                    pa.array(np.concatenate([n for _, _, n in out])),
                ],
                ["lang", "gram", "docs"],
            )

        return count

    counted = map_batches(rows.join(known, "lang").filter(drawn).select("doc_id", "lang", "text"), make, "lang string, gram bigint, docs bigint")
    members = counted.groupBy("lang", "gram").agg(F.sum("docs").alias("docs")).join(known, "lang").filter(F.col("docs") >= F.col("floor"))
    word = F.floor(F.col("place") / WORD).cast("int").alias("word")
    bit = F.expr(f"shiftleft(1L, place % {WORD})")
    masks = members.groupBy("gram", word).agg(F.bit_or(bit).alias("mask")).toArrow()
    slots = np.zeros((-(-len(languages) // WORD), 1 << SLOT_BITS), np.uint64)
    value = masks.column("gram").to_numpy().view(np.uint64)
    mask, row = masks.column("mask").to_numpy().view(np.uint64), masks.column("word").to_numpy()
    for which in range(HASHES):
        np.bitwise_or.at(slots, (row, slots_of(value, which)), mask)
    fill = np.array([np.count_nonzero(slots[i // WORD] >> np.uint64(i % WORD) & np.uint64(1)) for i in range(len(languages))]) / slots.shape[1]
    prior = max(sizes, key=lambda r: (r["count"], [-ord(c) for c in r["lang"]]))["lang"]
    return LanguageFilter(languages, prior, slots, np.minimum(fill**HASHES, 0.99))


def labelled(rows: int, batch_texts: list[str], own: LanguageFilter, letters: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and number of n-grams of each text."""
    bits = len(own.languages)
    hits, total, seen = np.zeros((rows, max(bits, 1))), np.zeros(rows), np.zeros(rows)
    for group in segments(padded(batch_texts), GRAM - 1):
        value, owner, n_letters = grams(group, letters)
        index = np.array([i for i, _ in group])
        mask = own.slots[:, slots_of(value, 0)]
        for which in range(1, HASHES):
            mask &= own.slots[:, slots_of(value, which)]
        np.add.at(seen, index, n_letters)
        np.add.at(total, index, np.bincount(owner, minlength=len(group)))
        for b in range(bits):
            on = (mask[b // WORD] >> np.uint64(b % WORD) & np.uint64(1)).astype(bool)
            np.add.at(hits[:, b], index, np.bincount(owner[on], minlength=len(group)))
    if not bits:
        return [UNDETERMINED] * rows, np.zeros(rows), total
    clean = np.maximum(hits - own.chance * total[:, None], 0) / (1 - own.chance)
    best, score = clean.argmax(1), np.minimum(clean.max(1) / np.maximum(total, 1), 1.0)
    score[seen == 0] = 0.0
    names = [
        UNDETERMINED if not n else own.languages[b] if s > 0 else own.prior
        for n, b, s in zip(seen.tolist(), best.tolist(), score.tolist(), strict=True)
    ]
    return names, score, total


def predict(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """``doc_id, lang_pred, score``: the likeliest language and the share of the text's n-grams it knows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own, letters = shared.value, _letters()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            names, score, _ = labelled(batch.num_rows, texts(batch), own, letters)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

        return work

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_batches(rows, make, "doc_id bigint, lang_pred string, score double")


def keep_known(docs: DataFrame, model: LanguageFilter, least: float) -> DataFrame:
    """The rows of ``docs``, with their columns, that have a language.

    A text of at least ``ENOUGH`` n-grams also needs a score of ``least``; shorter ones say too little to be rejected.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def make():
        own, letters = shared.value, _letters()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            names, score, total = labelled(batch.num_rows, texts(batch), own, letters)
            known = (score >= least) | (total < ENOUGH)
            return batch.filter(pa.array([n != UNDETERMINED and k for n, k in zip(names, known.tolist(), strict=True)], pa.bool_()))

        return work

    return map_batches(docs, make, schema)
