from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from monthloom.llm import lexical
from monthloom.llm.common import read
from monthloom.llm.oracles import ORACLES
from tests.llm.conftest import SF, plain

DOCS = "doc_id bigint, text string, score bigint, length int, item string"
ITEMS = "item_id bigint, text string, doc_id int, terms string, block int"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return [t.translate(LOWER) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, k=20):
    found = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = {}
    for item, text in items:
        asked[item] = min(asked.get(item, text or ""), text or "", key=str.encode)
    out = []
    for item, text in asked.items():
        scored = []
        for doc_id, c in found:
            m = 75 + 25 * c.total() * n // total
            own = [t for t in terms(text) if t in c]
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in own)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [{"doc_id": d, "item_id": item, "rank": r, "score": -s} for r, (s, _, d) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    own = spark.createDataFrame([(*r, 1, 2, "x") for r in docs], DOCS).repartition(6)
    return own, spark.createDataFrame([(*r, 1, "t", 9) for r in items], ITEMS)


def corpus(seed, docs=300, items=25):
    draw = random.Random(seed)
    words = ["the", "The", "été", "ÉTÉ", "日本", "x1", "42", "a_b", "z-z"] + [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(len(words))]
    pick = lambda most: " ".join(draw.choices(words, weights, k=draw.randrange(most)))
    rows = [(i, pick(40)) for i in range(docs)]
    phrase = pick(12)
    return rows + [(1000 + i, rows[3][1]) for i in range(40)], [(i, f"{phrase} {pick(15)}") for i in range(items)]


def run(spark, docs, items, **settings):
    return plain(lexical.search(*frames(spark, docs, items), **settings))


def test_equals_brute_force_and_sql(spark):
    docs, items = corpus(1)
    found = run(spark, docs, items)
    assert found == brute(docs, items)
    assert found == sorted(twin_of(docs, items), key=repr)


@pytest.mark.parametrize("settings", [{"block_items": 4}, {"block_terms": 10}, {"cells": 200}, {"k": 3}])
def test_blocks_and_batches_do_not_matter(spark, settings):
    docs, items = corpus(2, 60, 11)
    assert run(spark, docs, items, **settings) == brute(docs, items, settings.get("k", 20))


def expanded(graph, columns):
    """The leaves behind columns, each with how often it is added."""
    out = Counter()
    for c in columns:
        if c < len(graph.leaves):
            out[graph.leaves[c]] += 1
        else:
            out.update(expanded(graph, graph.nodes[c - len(graph.leaves)]))
    return out


def test_shared_sets_are_exact_and_save_work():
    draw = random.Random(5)
    base = [{t: 1 + t % 3 for t in draw.sample(range(40), 12)} for _ in range(4)]
    items = [{**draw.choice(base), **{t: 1 for t in draw.sample(range(40, 90), 5)}} for _ in range(60)]
    items += [{}, {1: 1}, {**base[0], **base[1]}]
    graph = lexical.shared_sets(items)
    for item, columns in zip(items, graph.items, strict=True):
        assert expanded(graph, columns) == Counter(item.items())
    assert graph.nodes
    for number, members in enumerate(graph.nodes):
        column = len(graph.leaves) + number
        assert all(m < column for m in members)  # children come first
        users = sum(column in own for own in [*graph.items, *graph.nodes])
        assert users >= 2
    before = sum(max(0, len(i) - 1) for i in items)
    after = sum(max(0, len(c) - 1) for c in [*graph.items, *graph.nodes])
    assert after < 0.6 * before


def test_results_come_through_the_nodes():
    """A node left empty changes what the items that use it get."""
    graph = lexical.shared_sets([{1: 1, 2: 1, 3: 2, 4: 1}, {1: 1, 2: 1, 3: 2, 5: 1}, {6: 1}])
    scores = np.arange(1, 22).reshape(7, 3)
    whole = lexical.accumulate(graph, scores)
    assert whole.tolist() == [[sum(scores[t][d] * r for t, r in item) for d in range(3)] for item in ([(1, 1), (2, 1), (3, 2), (4, 1)], [(1, 1), (2, 1), (3, 2), (5, 1)], [(6, 1)])]
    assert len(graph.nodes) == 1
    less = lexical.accumulate(lexical.Graph(graph.leaves, [[] for _ in graph.nodes], graph.items), scores)
    assert (less[:2] < whole[:2]).all() and (less[2] == whole[2]).all()


def test_given_items_share_sets(spark):
    items = read(spark, SF, "benchmark")
    block = lexical.item_blocks(items).toArrow()
    own = [{t["term"]: t["n"] for t in row} for row in block.column("terms").to_pylist()]
    graph = lexical.shared_sets(own)
    assert graph.nodes and sum(map(len, graph.items)) + sum(map(len, graph.nodes)) < sum(map(len, own))


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "... !"), (4, "one two"), (4, "one two"), (4, "one"), (None, "one two"), (5, "two one"), (6, "ONE"), (7, "ab" * 400_000 + " one")]
    docs += [(8, "x " * 600_000 + "two"), (-(2**63), "one two")]
    items = [(1, "one"), (1, "one"), (2, "two one two"), (2, "two ONE two three"), (3, None), (4, "?"), (None, "one"), (5, "absent")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, docs[:3], items) == []
    docs, items = [d for d in docs if d[0] not in (None, 4)], [i for i in items[3:] if i[0] is not None]
    want = brute(docs, items)
    assert want == sorted(twin_of(docs, items), key=repr)


def twin_of(docs, items):
    import duckdb

    db = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        db.execute(f"create table {name} ({key} bigint, text varchar)")
        db.executemany(f"insert into {name} values (?, ?)", rows)
    result = db.execute(ORACLES["op13_lexical"])
    names = [c[0] for c in result.description]
    return [dict(sorted(zip(names, r, strict=True))) for r in result.fetchall()]


def test_ties_and_copies(spark):
    docs = [(i, "same text here") for i in range(500, 0, -1)] + [(1000, "other")]
    assert [r["doc_id"] for r in sorted(run(spark, docs, [(1, "same")]), key=lambda r: r["rank"])] == list(range(1, 21))


def test_large_totals_stay_exact():
    length = np.array([10**9, 3, 0])
    assert lexical.length_norms(length, 3 * 10**10, 10**13).tolist() == [75 + 25 * n * 3 * 10**10 // 10**13 for n in (10**9, 3, 0)]
