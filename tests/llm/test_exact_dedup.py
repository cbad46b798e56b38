from __future__ import annotations

import random

from monthloom.llm import exact_dedup
from monthloom.llm.oracles import ORACLES
from pyspark.sql import functions as F
from tests.llm.conftest import plain

ODD = [(1, "Ab c"), (2, "aB C"), (3, "ab  c"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "x" * 100_000), (9, "X" * 100_000), (3, "ab  c"), (10, "Ab c"), (None, "only"), (None, "ab c")]


def run(docs, rows, **setting):
    out = exact_dedup.dedup(docs(rows), **setting)
    return plain(out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")))


def test_odd_rows_match_sql(docs, twin):
    assert run(docs, ODD) == twin(ORACLES["op2_exact_dedup"], ODD)


def test_small_buckets_and_colliding_keys(docs, twin):
    draw = random.Random(5)
    rows = [(i, draw.choice("aAbBcCdDeE") * draw.randint(0, 4)) for i in range(300)]
    expected = twin(ORACLES["op2_exact_dedup"], rows)
    assert run(docs, rows, capacity=2, prefix_bits=6) == expected
    assert run(docs, rows, capacity=2, prefix_bits=6, key_bits=2) == expected


def test_empty_table(docs):
    assert run(docs, []) == []
    assert exact_dedup.keep_one(docs([])).collect() == []


def test_keep_one_keeps_columns_and_one_row_of_each_text(docs):
    frame = docs(ODD)
    left = exact_dedup.keep_one(frame)
    assert left.columns == frame.columns
    found = sorted(((r["doc_id"], (r["text"] or "")[:5]) for r in left.collect()), key=repr)
    assert found == sorted([(10, "Ab c"), (3, "ab  c"), (5, ""), (6, "É"), (7, "é"), (9, "XXXXX"), (None, "only")], key=repr)


def test_keep_one_with_columns_named_like_helpers(spark):
    rows = [(1, "a", 5, "x", 1), (2, "A", 6, "y", 2), (2, "b", 7, "z", 3), (2, "b", 7, "z", 3)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, __id int, ____sha string, `_at` int")
    left = exact_dedup.keep_one(frame)
    assert left.columns == frame.columns
    assert sorted(map(tuple, left.collect())) == [(2, "A", 6, "y", 2), (2, "b", 7, "z", 3)]


def test_directory_doubles_only_where_needed():
    directory, depth = exact_dedup.grow_directory({0: 9, 1: 1, 6: 2, 7: 2}, 4, 3)
    assert depth == 3
    assert directory == [0, 1, 2, 2, 3, 3, 3, 3]
    assert exact_dedup.grow_directory({}, 4, 3) == ([0], 0)
