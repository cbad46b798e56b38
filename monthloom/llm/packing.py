"""Order-preserving packing of tokenised documents into sequences.

The documents of a partition, each followed by ``END``, are one stream that windows of at most
``LENGTH`` tokens cut up in order. A window costs its padding, ``SEQUENCE_COST``, and a penalty for
where it ends: none at the end of a document, ``SENTENCE_CUT`` inside one at the end of a sentence,
``FORCED_CUT`` elsewhere (offered only in stretches without a sentence end). With ``f(j)`` the least
cost up to cut ``j``, ``f(j) = penalty(j) + LENGTH - at(j) + min(f(i) + at(i))`` over the cuts ``i``
at most ``LENGTH`` before ``j``; that minimum moves along the stream, so a monotone queue holds it.
A window whose length is a power of two needs no padding, which adds at most twelve further ``i``.

A partition is packed in blocks of ``BLOCK`` tokens. All but the last windows of a block are final;
the rest opens the next block, so memory does not grow with the partition. What is left at the end
of a partition becomes sequences of power-of-two length. Nothing is shuffled.

Cases: null text is empty and has the single token ``END``; a null ``doc_id`` stays null; repeated
rows are packed again; an empty table gives no piece; further columns are not looked at.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import WHITE, Remembered, ready_workers, slices, texts

LENGTH, END = 4096, 2
SEQUENCE_COST, SENTENCE_CUT, FORCED_CUT = 64, 1, 24
BLOCK, CARRIED_WINDOWS = 1 << 19, 4
LONG_STRETCH, FORCED_STEP = 256, 32
END_BYTES = array("I", [END]).tobytes()
CACHE = 300_000
SPECIAL, COMBINING = "<|", re.compile("[\u0300-\u036f]")
LINE, WORD_END = 64, "</w>"
# Letters that normalising leaves alone, and the signs of ASCII without "'" and "<", which begin what is cut by other rules.
LETTERS, SIGNS = "a-z\u00df-\u00f6\u00f8-\u00ff\u03b1-\u03c9\u0430-\u045f", r"!-&(-/:;=-@\[-`{-~"
SIMPLE, SIMPLE_PIECES = re.compile(f"[{LETTERS}0-9{SIGNS}]+"), re.compile(f"[{LETTERS}]+|[0-9]|[{SIGNS}]+")
# White space, digits, and letters whose lower case and composed form are one letter.
PLAIN = WHITE + "0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u0391-\u03a1\u03a3-\u03a9\u03b1-\u03c9\u0400-\u0481\u048a-\u04ff"
SIGN_BEFORE_STOP = re.compile(f"[.,](?<=[^{PLAIN}].)")

PIECE = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def cut_words(text: str) -> list[str]:
    """Parts of a text between which no token can lie, as few different ones as is safe.

    White space always separates. A "." or "," does too after what ``PLAIN`` holds; texts in which one follows
    anything else are left as they are. The tokenizer lower-cases, so A-Z may be lower-cased first, but
    not before combining marks, with which it composes letters.
    """
    if SPECIAL not in text and not (not text.isascii() and COMBINING.search(text)):
        text = text.lower() if text.isascii() else text.encode().lower().decode()
    if not SIGN_BEFORE_STOP.search(text):
        text = text.replace(".", " .").replace(",", " ,")
    return text.replace("\n", " ").split(" ")


class Words:
    """Ids of a text, 32 bits each. White space separates tokens, so what lies between spaces is encoded once a task.

    A call of the tokenizer costs more than a word's merges. Words that match ``SIMPLE`` go in lines of ``LINE``, their pieces
    apart, through the same model without the steps that would not change them; of a piece only the last token has ``WORD_END``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.lines = Tokenizer(self.tokenizer.model)
        self.lines.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends_word = self.tokens_that(lambda token: token.endswith(WORD_END))
        self.known = Remembered(CACHE)

    def learn(self, unseen: set[str]) -> None:
        """Adds the ids of unseen words."""
        simple = list(filter(SIMPLE.fullmatch, unseen))
        spaced = [word if word.isalpha() else " ".join(SIMPLE_PIECES.findall(word)) for word in simple]
        lines = [" ".join(spaced[i : i + LINE]) for i in range(0, len(spaced), LINE)]
        encoded = self.lines.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(x.ids for x in encoded), np.uint32)
        pieces = np.cumsum(np.fromiter((word.count(" ") + 1 for word in spaced), np.int64, len(spaced)))
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != (pieces[-1] if len(pieces) else 0):
            raise ValueError(f"the vocabulary does not mark the ends of words by {WORD_END}")
        flat, stops = ids.tobytes(), (4 * ends[pieces - 1]).tolist()
        self.known.now.update(zip(simple, [flat[a:b] for a, b in pairwise([0, *stops])], strict=True))
        others = list(unseen.difference(simple))
        for word, encoding in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self.known.now[word] = array("I", encoding.ids).tobytes()

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        cut = [cut_words(text) for text in batch]
        self.learn(self.known.unknown(set(chain.from_iterable(cut))))
        ids = self.known.now.__getitem__
        return [np.frombuffer(b"".join(map(ids, words)) + END_BYTES, np.uint32) for words in cut]

    def tokens_that(self, holds: Callable[[str], bool]) -> np.ndarray:
        """For each id, whether it holds of its token."""
        found = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            found[i] = holds(token)
        return found

    def sentence_ends(self) -> np.ndarray:
        """For each id, whether its token ends a sentence."""
        return self.tokens_that(lambda token: token.removesuffix(WORD_END)[-1:] in (".", "!", "?"))


@lru_cache(maxsize=1)
def words(path: str) -> Words:
    """One per worker, so that later tasks find what earlier ones have encoded."""
    return Words(path)


def cuts(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, ascending, and their penalties."""
    penalty = np.full(len(ids) + 1, -1, np.int64)
    penalty[1:][ends_sentence[ids]] = SENTENCE_CUT
    penalty[doc_ends] = 0
    penalty[0] = 0
    places = np.flatnonzero(penalty >= 0)
    gaps = np.diff(places)
    for i in np.flatnonzero(gaps > LONG_STRETCH):
        penalty[places[i] + FORCED_STEP : places[i + 1] : FORCED_STEP] = FORCED_CUT
    places = np.flatnonzero(penalty >= 0)
    return places, penalty[places]


def best_windows(places: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """The cuts of least total cost, first and last place included."""
    n = len(places)
    exact_j, exact_i = [np.array([n])], [np.array([0])]  # pairs of cuts a power of two apart; the last entry ends the list
    for width in (1 << k for k in range((LENGTH - 1).bit_length())):
        found = np.minimum(np.searchsorted(places, places - width), n - 1)
        j = np.flatnonzero(places[found] == places - width)
        exact_j.append(j)
        exact_i.append(found[j])
    pair_j, pair_i = np.concatenate(exact_j), np.concatenate(exact_i)
    order = np.argsort(pair_j, kind="stable")
    pair_j, pair_i = pair_j[order].tolist(), pair_i[order].tolist()
    at, fee = places.tolist(), (penalty + SEQUENCE_COST).tolist()
    cost, origin = [0] * n, [0] * n
    # The queue: cuts i with f(i) + at(i), both ascending, from ``head`` on.
    values, sources, head, pair, next_pair = [at[0]], [0], 0, 0, pair_j[0]
    for j in range(1, n):
        place = at[j]
        reach = place - LENGTH
        while at[sources[head]] < reach:
            head += 1
        least, source = values[head] - reach, sources[head]
        while next_pair == j:
            i = pair_i[pair]
            if cost[i] < least:
                least, source = cost[i], i
            pair += 1
            next_pair = pair_j[pair]
        least += fee[j]
        cost[j], origin[j] = least, source
        value = least + place
        while len(values) > head and values[-1] >= value:
            values.pop()
            sources.pop()
        values.append(value)
        sources.append(j)
    chosen, j = [n - 1], n - 1
    while j:
        j = origin[j]
        chosen.append(j)
    return places[chosen[::-1]]


def power_of_two_tail(bounds: np.ndarray) -> np.ndarray:
    """Splits the last window, if it would be padded, into power-of-two lengths."""
    if len(bounds) < 2:
        return bounds
    start, rest = int(bounds[-2]), int(bounds[-1] - bounds[-2])
    parts = [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
    return np.concatenate([bounds[:-1], start + np.cumsum(parts)])


class Packer:
    """Packs the stream of one partition."""

    def __init__(self, words: Words):
        self.words, self.ends_sentence = words, words.sentence_ends()
        self.sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        self.held: list[tuple[int | None, int, int, np.ndarray]] = []  # doc_id, start, doc_tokens, ids
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.held.append((doc_id, 0, len(ids), ids))
        self.size += len(ids)

    def pieces(self, last: bool) -> list[tuple]:
        """Rows of the windows that are final; the others stay held."""
        if not self.held:
            return []
        ids = np.concatenate([x[3] for x in self.held])
        doc_ends = np.cumsum([len(x[3]) for x in self.held])
        bounds = best_windows(*cuts(ids, doc_ends, self.ends_sentence))
        bounds = power_of_two_tail(bounds) if last else bounds[: max(1, len(bounds) - CARRIED_WINDOWS)]
        stop = int(bounds[-1])
        edges = np.union1d(bounds, np.concatenate([[0], doc_ends[doc_ends <= stop]]))
        doc_of = np.searchsorted(doc_ends, edges[:-1], "right")
        window_of = np.searchsorted(bounds, edges[:-1], "right") - 1
        starts = np.concatenate([[0], doc_ends[:-1]])
        rows = []
        for a, b, d, w in zip(edges[:-1].tolist(), edges[1:].tolist(), doc_of.tolist(), window_of.tolist(), strict=True):
            doc_id, start, total, _ = self.held[d]
            rows.append((doc_id, start + a - int(starts[d]), b - a, ids[a:b].tobytes(), total, self.sequence + w, a - int(bounds[w])))
        self.sequence += len(bounds) - 1
        rest = []
        for (doc_id, start, total, own), a in zip(self.held, starts.tolist(), strict=True):
            done = max(0, stop - a)
            if done < len(own):
                rest.append((doc_id, start + done, total, own[done:]))
        self.held, self.size = rest, len(ids) - stop
        return rows


def pack(docs: DataFrame, path: str) -> DataFrame:
    """Pieces of ``docs(doc_id, text)``; ``ids`` holds a piece's ids as little-endian 32-bit numbers."""
    names = [field.split(" ")[0] for field in PIECE.split(", ")]
    kinds = [pa.binary() if n == "ids" else pa.int64() for n in names]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(words(path))
        for batch in batches:
            for part in slices(batch, 512):
                for doc_id, ids in zip(part.column(0).to_pylist(), packer.words.encode(texts(part)), strict=True):
                    packer.add(doc_id, ids)
                if packer.size >= BLOCK and (rows := packer.pieces(last=False)):
                    yield batch_of(rows)
        if rows := packer.pieces(last=True):
            yield batch_of(rows)

    ready_workers(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, PIECE)
