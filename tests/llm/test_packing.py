from __future__ import annotations

import random
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from monthloom.llm import packing
from pyspark.sql import functions as F
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@cache
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, packing.END]


def cost(places, penalty, bounds):
    fee = dict(zip(places.tolist(), penalty.tolist(), strict=True))
    total = 0
    for a, b in zip(bounds, bounds[1:]):  # noqa: B905
        size = b - a
        total += packing.SEQUENCE_COST + fee[b] + (0 if size & (size - 1) == 0 else packing.LENGTH - size)
    return total


@pytest.mark.parametrize("seed", range(5))
def test_windows_have_least_cost(seed, monkeypatch):
    monkeypatch.setattr(packing, "LENGTH", 32)
    draw = random.Random(seed)
    places = np.cumsum([0, *(draw.randint(1, 14) for _ in range(60))])
    penalty = np.array([draw.choice([0, 1, 24]) for _ in places])
    best = [0] + [10**9] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            size = int(places[j] - places[i])
            if size <= 32:
                pad = 0 if size & (size - 1) == 0 else 32 - size
                best[j] = min(best[j], best[i] + pad + int(penalty[j]) + packing.SEQUENCE_COST)
    bounds = packing.best_windows(places, penalty).tolist()
    assert bounds[0] == 0 and bounds[-1] == places[-1] and max(np.diff(bounds)) <= 32
    assert cost(places, penalty, bounds) == best[-1]


TEXTS = [None, "", "One. Two! Three?", "É́ǰ J̌ K İ Σς.. ,,. a_.b x.,y 1,2 3.4 it's <|endoftext|> <|STARTOFTEXT|>", "tab\tsep\x1c .　,", "word " * 9000, "x" * 3000, "Long sentence without stops " * 400]


def test_cut_words_changes_no_id():
    words = packing.Words(PATH)
    draw = random.Random(4)
    alphabet = ["a", "B", "É", "é", "J̌", ".", ",", "!", "_", "'s", " ", "\n", "1", "<|endoftext|>", " ", "..", "Σ", "İ"]
    texts = TEXTS[2:] + ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 30))) for _ in range(2000)]
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert ids.tolist() == ids_of(text), text


def test_words_in_lines_have_their_own_ids():
    words, letters = packing.Words(PATH), [chr(c) for c in range(0x500) if packing.SIMPLE.fullmatch(chr(c))]
    draw = random.Random(6)
    unseen = {"", "don't", "x<y", "</w>", "a</w>b", "1234", "a1_b%%%", "É", "straße", "ς", "i̇", "ﬁ", "日本", *letters}
    unseen |= {"".join(draw.choices(letters, k=draw.randint(1, 12))) for _ in range(5000)}
    unseen |= {"".join(draw.choice("thean'%.<ré1") for _ in range(draw.randint(1, 12))) for _ in range(2000)}
    words.learn(unseen)
    assert words.known.now.keys() == unseen
    for word, ids in words.known.now.items():
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer().encode(word, add_special_tokens=False).ids, word
    words.learn(set())
    words.learn({"it's"})
    words.learn({"", "plain"})
    assert np.frombuffer(words.known.now["plain"], "<u4").tolist() == ids_of("plain")[:-1]


def test_simple_words_share_calls():
    words, calls = packing.Words(PATH), []

    class Counted:
        def __init__(self, own):
            self.own = own

        def encode_batch_fast(self, batch, **options):
            calls.extend(batch)
            return self.own.encode_batch_fast(batch, **options)

    for name, own in list(vars(words).items()):
        if hasattr(own, "encode_batch_fast"):
            setattr(words, name, Counted(own))
    texts = [" ".join(f"word{chr(97 + i % 26)}{chr(97 + j % 26)}{'%' * (j % 3)}" for j in range(200)) for i in range(26)]
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert ids.tolist() == ids_of(text)
    assert len(calls) < 100  # of some two thousand words


@pytest.mark.parametrize("block", [packing.BLOCK, 6000])
def test_pieces_are_the_documents(docs, monkeypatch, block):
    draw = random.Random(9)
    rows = list(enumerate(TEXTS + [" ".join("lorem ipsum dolor. sit amet, consectetur".split() * draw.randint(1, 200)) for _ in range(60)]))
    rows += [rows[10], (None, "no id")]
    monkeypatch.setattr(packing, "BLOCK", block)
    out = packing.pack(docs(rows).repartition(2), PATH).withColumn("crc", F.crc32("ids")).collect()
    sequences, documents = {}, {}
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0 and zlib.crc32(r["ids"]) == r["crc"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        documents.setdefault(r["doc_id"], []).append((r["start"], ids, r["doc_tokens"]))
    padded = real = 0
    for pieces in sequences.values():
        size = 0
        for offset, length in sorted(pieces):
            assert offset == size
            size += length
        assert size <= packing.LENGTH
        real += size
        padded += 0 if size & (size - 1) == 0 else packing.LENGTH - size
    assert padded <= 0.02 * real
    for doc_id, text in rows:
        want, copies = ids_of(text), 2 if doc_id == 10 else 1
        pieces = sorted(documents[doc_id], key=lambda p: (p[0], len(p[1])))
        assert sum(len(ids) for _, ids, _ in pieces) == copies * len(want)
        for start, ids, total in pieces:
            assert ids == want[start : start + len(ids)] and total == len(want)


def test_empty_table(docs):
    assert packing.pack(docs([]), PATH).collect() == []
