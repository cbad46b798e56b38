from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from monthloom.llm import bpe
from monthloom.llm.queries import QUERIES
from tests.llm.conftest import SF
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH)


def same(codec, texts):
    for text, found, expected in zip(texts, codec.encode(texts), LIBRARY.encode_batch(texts, add_special_tokens=False), strict=True):
        assert found.tolist() == expected.ids, text
        assert codec.decode(found.tolist()) == text == LIBRARY.decode(expected.ids, skip_special_tokens=False)


def test_odd_texts(codec):
    same(codec, ["", " ", "  a", "a  ", "\n\n x", "it's I'LL", "a<|endoftext|> b<|endoftext|>", "<|endoftext|>", "\x1c \x85x\xa0 y　z", "é" * 300, "a" * 5000, "x1y22 333", "😀😀 ок"])


def test_random_texts(codec):
    draw = random.Random(1)
    alphabet = "ab'sdtre  \n\t\x1c\xa0éÉ1٣😀!?.́<|>"
    same(codec, ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 200))) for _ in range(500)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x24FF), max_size=80), max_size=5))
def test_round_trip(codec, texts):
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert codec.decode(ids.tolist()) == text


def test_both_trees_merge_alike(codec):
    draw = random.Random(2)
    pieces = [bytes(draw.choice(b"theandirs ") for _ in range(draw.randint(1, 60))) for _ in range(300)]
    assert codec.merge_together(pieces, 64) == [codec.merge_alone(p) for p in pieces]


def test_decode_of_broken_bytes(codec):
    ids = codec.encode(["é"])[0].tolist() + codec.encode(["日"])[0].tolist()[:1]
    assert codec.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)
    assert codec.decode([]) == ""


def test_lists_are_decoded_as_one_by_one(codec):
    texts = ["", "a b", "é 日本 😀", "a<|endoftext|>b", "x" * 300]
    lists = [None, *(ids.tolist() for ids in codec.encode(texts)), []]
    column = pa.array(lists, pa.list_(pa.int32()))
    assert codec.decode_lists(column).to_pylist() == ["", *texts, ""]
    assert codec.decode_lists(column.slice(2, 3)).to_pylist() == texts[1:4]
    assert codec.decode_lists(column.slice(0, 0)).to_pylist() == codec.decode_lists(column.slice(0, 1)).to_pylist()[1:] == []
    broken = [codec.encode(["日"])[0].tolist()[:1], codec.encode(["é b"])[0].tolist(), codec.encode(["ü"])[0].tolist()[:1]]
    assert codec.decode_lists(pa.array(broken, pa.list_(pa.int32()))).to_pylist() == [LIBRARY.decode(x, skip_special_tokens=False) for x in broken]


def test_decoding_makes_no_object_for_each_id(spark, codec, monkeypatch):
    """The operator's own work on a million ids takes less than the 8 MB of a list of them."""
    made = []
    monkeypatch.setattr(bpe, "map_batches", lambda df, make, schema: made.append(make()))
    bpe.decode(spark.createDataFrame([], "doc_id bigint, ids array<int>"), PATH)
    ids = np.tile(codec.encode(["the words of a text"])[0].astype(np.int32), 1 << 18)[: 1 << 20]
    column = pa.ListArray.from_arrays(pa.array(np.arange(0, len(ids) + 1, 1 << 12, dtype=np.int32)), pa.array(ids))
    batch = pa.RecordBatch.from_arrays([pa.array(range(256), pa.int64()), column], ["doc_id", "ids"])
    tracemalloc.start()
    decoded = made[0](batch)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert decoded.column(2).to_pylist() == [codec.decode(x) for x in column.to_pylist()]
    assert most < 1 << 20


def test_plain_chunks_are_one_piece(codec):
    same(codec, ["word", " word", "  word", " a'll", " Ab1", " ab,c", "\nab", " ", "  ", "' ab", " é", " aé", "don't re's", "\tab ab"])


def test_rows_of_every_width_merge_together(codec):
    draw = random.Random(3)
    for width in (2, 4, 8, 16, 32, 64):
        pieces = [bytes(draw.choice(b" thesaingroua\xc3\xa9") for _ in range(draw.randint(1, width))) for _ in range(200)]
        assert codec.merge_together(pieces, width) == [codec.merge_alone(p) for p in pieces]


def test_forgetting_changes_nothing(codec, monkeypatch):
    codec.known.most = 10
    same(codec, [f"word{i} other{i % 7} more" for i in range(200)])
    same(codec, [f"word{i} other{i % 7} more" for i in range(200)])


def test_query_and_odd_rows(spark, docs):
    out = {r["doc_id"]: r for r in QUERIES["op8_bpe"](spark, SF).collect()}
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = LIBRARY.encode(row["text"] or "", add_special_tokens=False).ids
        found = out[row["doc_id"]]
        assert found["n_tokens"] == len(ids)
        assert found["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()
    small = bpe.decode(bpe.encode(docs([(1, None), (2, "a b"), (2, "a b"), (None, "x")]), PATH), PATH).collect()
    assert sorted((r["text"] for r in small)) == ["", "a b", "a b", "x"]
    assert bpe.encode(docs([]), PATH).collect() == []
