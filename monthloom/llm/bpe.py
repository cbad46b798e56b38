"""Byte-level BPE, encoding and decoding, with a segment tree over the ranks of adjacent pairs.

A piece of text starts as its bytes. Leaf ``i`` of the tree holds the rank of the pair that starts at
symbol ``i``, joined with ``i`` in one number, and an inner node the lower of its children; the root
is therefore the leftmost pair of lowest rank. A merge rewrites three leaves (its own, the pair
before, and the symbol that vanishes) and their ancestors. The loop ends when the root is empty.

Short pieces of a batch are merged in step, one row of a tree matrix each; long ones (a run without
spaces can be a whole document) take ``n log n`` steps alone. Text is cut at white space, where no
piece can cross; what follows a cut and the pieces in it are remembered per task, up to ``CACHE`` entries each.
Decoding gathers the bytes of all tokens of a batch at once.

The vocabulary file is named by its path, which every executor must have. Cases: a null text has no
tokens; the special token's own string becomes its id, as the file says; any text survives
encoding and decoding; rows are independent, so repeats and further columns change nothing.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import WHITE, Remembered, map_batches, texts

CACHE = 150_000
GATHER = 1 << 20  # characters of texts whose unseen pieces are merged together
WIDEST = 64  # bytes of a piece that is merged in step with others
NONE = np.int64(1 << 62)
CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself where printable, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def piece_pattern() -> regex.Pattern:
    """The public pattern, its white space written out."""
    pattern = public_tokenizers.PATTERN.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]")
    return regex.compile(pattern)


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, letters = spec["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, i in vocabulary.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.token_column = pa.array(self.token_bytes, pa.large_binary())
        self.byte_ids = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.byte_ids[b] = vocabulary[letter]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        pairs = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in merges], np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_rank = pairs[order], order.astype(np.int64)
        self.rank_of = dict(zip(pairs.tolist(), range(len(merges)), strict=True))
        self.pattern = piece_pattern()
        self.special_ids = {s: np.array([i], "<u4").tobytes() for s, i in self.special.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.known, self.pieces = Remembered(CACHE), Remembered(CACHE)

    def ranks(self, left: np.ndarray, right: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
        """Leaf values of pairs starting at ``at``; ``NONE`` where no merge exists or ``right`` is -1."""
        pair = left << 32 | right
        i = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[i] == pair) & (right >= 0), self.pair_rank[i] * width + at, NONE)

    def merge_together(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids (32 bits each) of pieces of at most ``width`` bytes, a power of two."""
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        places = np.arange(width)
        inside = places < sizes[:, None]
        symbols = np.full((n, width + 1), -1, np.int64)
        symbols[:, :width][inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.tile(np.arange(1, width + 2), n)
        before = np.tile(np.arange(-1, width), n)
        tree = np.full((n, 2 * width), NONE)
        tree[:, width:][inside] = self.ranks(symbols[:, :width][inside], symbols[:, 1:][inside], width, np.broadcast_to(places, (n, width))[inside])
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        # From here on all rows of a matrix lie in one line; ``trees`` and ``lines`` are where each row begins.
        flat, tree = symbols.reshape(-1), tree.reshape(-1)
        trees, lines = np.arange(n) * (2 * width), np.arange(n) * (width + 1)
        while True:
            root = tree[trees + 1]
            going = root < NONE
            trees, lines, root = trees[going], lines[going], root[going]
            if not len(root):
                break
            at = root % width
            gone = after[lines + at]
            right = after[lines + gone]
            new = self.merged[root // width]
            flat[lines + at] = new
            flat[lines + gone] = -1
            after[lines + at] = right
            before[lines + right] = at
            left = before[lines + at]
            left = np.where(left < 0, at, left)
            pairs = self.ranks(np.concatenate([flat[lines + left], new]), np.concatenate([new, flat[lines + right]]), width, np.concatenate([left, at]))
            tree[trees + width + gone] = NONE
            tree[trees + width + left] = pairs[: len(at)]
            tree[trees + width + at] = pairs[len(at) :]
            node, trees3 = (width + np.concatenate([gone, left, at])) >> 1, np.tile(trees, 3)
            while node[0]:
                below = trees3 + 2 * node
                tree[trees3 + node] = np.minimum(tree[below], tree[below + 1])
                node >>= 1
        live = symbols[:, :width] >= 0
        ids = symbols[:, :width][live].astype("<u4").tobytes()
        ends = (live.sum(1).cumsum() * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge_alone(self, piece: bytes) -> bytes:
        """Ids of one piece of any length."""
        n, none, rank_of, merged = len(piece), int(NONE), self.rank_of, self.merged.tolist()
        width = 1 << (n - 1).bit_length() if n > 1 else 1
        symbols = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist() + [-1]
        after, before = list(range(1, n + 2)), list(range(-1, n))

        def leaf(i: int) -> int:
            j = after[i]
            rank = rank_of.get(symbols[i] << 32 | symbols[j]) if j < n else None
            return none if rank is None else rank * width + i

        tree = [none] * (2 * width)
        tree[width : width + n] = [leaf(i) for i in range(n)]
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            gone = after[at]
            symbols[at], symbols[gone] = merged[rank], -1
            after[at] = after[gone]
            if after[at] < n:
                before[after[at]] = at
            for i, value in ((gone, none), (at, leaf(at)), (before[at], leaf(before[at]) if before[at] >= 0 else none)):
                if i < 0:
                    continue
                node = width + i
                tree[node] = value
                while node > 1:
                    node >>= 1
                    low, high = tree[2 * node], tree[2 * node + 1]
                    tree[node] = low if low < high else high
        return np.array([s for s in symbols if s >= 0], "<u4").tobytes()

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        found: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            by_width.setdefault(max(2, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, members in by_width.items():
            own = [pieces[i] for i in members]
            ids = self.merge_together(own, width) if width <= WIDEST else map(self.merge_alone, own)
            for i, x in zip(members, ids, strict=True):
                found[i] = x
        return found

    def learn(self, chunks: set[str]) -> None:
        """Adds the ids of unseen chunks."""
        cut = {c: [c] if c.isascii() and (c.isalpha() or c[0] == " " and c[1:].isalpha()) else self.pattern.findall(c) for c in chunks}
        fresh = list(self.pieces.unknown(set(chain.from_iterable(cut.values()))))
        ids = self.pieces.now
        ids.update(zip(fresh, self.merge([p.encode() for p in fresh]), strict=True))
        for c, own in cut.items():
            self.known.now[c] = ids[own[0]] if len(own) == 1 else b"".join([ids[p] for p in own])
        self.known.now.update(self.special_ids)

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        cut = []
        for text in batch:
            parts = self.split_special.split(text) if self.special and any(s in text for s in self.special) else (text,)
            cut.append([c for part in parts for c in ([part] if part in self.special else CHUNK.findall(part))])
        found = [list(map(self.known.now.get, chunks)) for chunks in cut]
        gaps = [[i for i, ids in enumerate(own) if ids is None] if None in own else [] for own in found]
        self.learn(self.known.unknown({chunks[i] for chunks, own in zip(cut, gaps, strict=True) for i in own}).difference(self.special))
        for chunks, own, ids in zip(cut, gaps, found, strict=True):
            for i in own:
                ids[i] = self.known.now[chunks[i]]
        return [np.frombuffer(b"".join(ids), "<u4") for ids in found]

    def decode(self, ids: list[int]) -> str:
        """Text of token ids; bytes that are not UTF-8 become the replacement character."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")

    def decode_lists(self, lists: pa.Array) -> pa.Array:
        """The text of each list of ids, null as none: the bytes of all lists' tokens side by side, cut where a list ends."""
        tokens = self.token_column.take(lists.flatten())
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        places = np.frombuffer(tokens.buffers()[1], np.int64)[np.concatenate([[0], ends])]
        whole = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(places), tokens.buffers()[2] or pa.py_buffer(b"")])
        try:
            return whole.cast(pa.string())
        except pa.ArrowInvalid:  # some text is not UTF-8
            return pa.array([x.decode("utf-8", "replace") for x in whole.to_pylist()], pa.string())


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def gathered(batch: list[str]) -> Iterator[list[str]]:
    """The texts in groups of about ``GATHER`` characters."""
    group, size = [], 0
    for text in batch:
        group.append(text)
        size += len(text)
        if size >= GATHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: the token ids of each whole text."""

    def make():
        own = codec(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [x for group in gathered(texts(batch)) for x in own.encode(group)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate([*ids, np.array([], "<u4")]).astype(np.int32)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["doc_id", "ids"])

        return work

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_batches(rows, make, "doc_id bigint, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` of ``tokens(doc_id, ids)``; null ids count as none."""

    def make():
        own = codec(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), own.decode_lists(batch.column(1))], ["doc_id", "ids", "text"])

        return work

    return map_batches(tokens.select("doc_id", "ids"), make, "doc_id bigint, ids array<int>, text string")
