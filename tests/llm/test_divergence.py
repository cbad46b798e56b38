from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from monthloom.llm import divergence
from monthloom.llm.oracles import ORACLES
from tests.llm.conftest import plain

SCHEMA = "doc_id bigint, text string, lang string, source string, n bigint, term string, rank int, value string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, 5, "x", 1, None) for i, r in enumerate(rows)], SCHEMA).repartition(5)


def brute(rows):
    """The contract on ``(text, lang, source)`` in plain Python."""
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        words = [w.translate(LOWER) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups.add((lang or "", source or ""))
        counts[lang or "", source or ""].update(words)
        held[lang or ""].update(set(words))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in held[lang].items() if n >= 3]
        own = sorted(s for g, s in groups if g == lang)

        def rates(n, kept=kept):
            total = sum(n[t] for t in kept) + len(kept)
            return {t: 1 + 1_000_000_000 * (n[t] + 1) // total for t in kept}

        p = {s: rates(counts[lang, s]) for s in own}
        q = rates(sum((counts[lang, s] for s in own), Counter()))
        price = lambda x, y: (x - y) * (x - y) // y
        for s in own:
            pairs = [(-sum(price(p[s][t], p[o][t]) for t in kept), o.encode()) for o in own if o != s]
            terms = [(-price(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:200])):
                out += [
                    {"item": i.decode(), "lang": lang, "part": part, "rank": r, "source": s, "value": -v} for r, (v, i) in enumerate(found, 1)
                ]
    return sorted(out, key=repr)


def corpus(n, seed=2, sources=7):
    draw = random.Random(seed)
    words = ["a", "The", "the", "été", "ÉTÉ", "日本", "z\x00y", "x1y", "q" * 40] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(len(words))]
    pick = lambda: " ".join(draw.choices(words, weights, k=draw.randrange(60)))
    return [(pick(), draw.choice(["en", "en", "de", None, ""]), draw.choice([None, "", *[f"s{min(k, draw.randrange(9))}" for k in range(sources)]])) for _ in range(n)]


def test_equals_brute_force_and_sql(spark, twin):
    rows = corpus(400)
    found = plain(divergence.audit(frame(spark, rows)))
    assert found == brute(rows)
    assert found == twin(ORACLES["op12_divergence"], [(i, *r) for i, r in enumerate(rows)], schema="doc_id bigint, text varchar, lang varchar, source varchar")


@pytest.mark.parametrize(("terms", "tile", "dense"), [(16, 64, 16), (1 << 14, 2, 3), (30, 3, 2), (1, 1, 1)])
def test_blocks_and_tiles_do_not_matter(spark, terms, tile, dense):
    rows = corpus(150, 5)
    counts = divergence.term_counts(frame(spark, rows))
    found = divergence.pair_values(counts, divergence.group_sizes(counts), terms, tile, dense)
    want = sorted((r["lang"], r["source"], r["item"], r["value"]) for r in brute(rows) if r["part"] == "pair")
    assert sorted((r["lang"], r["source"], r["other"], r["value"]) for r in found.collect()) == want


def test_product_of_indicators_is_the_joint_table():
    """Every joint table against counting, priced by levels."""
    draw = random.Random(1)
    import numpy as np

    levels = np.array([[draw.choice([0, 0, 1, 2, 30, 31, 500]) for _ in range(5)] for _ in range(90)])
    sizes = levels.sum(axis=0)
    sides = [divergence.Side(levels[:, :2], sizes[:2], 90, 4), divergence.Side(levels[:, 2:], sizes[2:], 90, 4)]
    there, back = divergence.joint_prices(*sides, 4)
    rate = lambda g, c: 1 + divergence.SCALE * (int(c) + 1) // (int(sizes[g]) + 90)
    for i in range(2):
        for j in range(3):
            table = Counter(zip(levels[:, i].tolist(), levels[:, 2 + j].tolist(), strict=True))
            p, q = ([rate(g, cell[k]) for cell in table] for k, g in enumerate((i, 2 + j)))
            assert there[i, j] == sum(n * ((x - y) ** 2 // y) for n, x, y in zip(table.values(), p, q, strict=True))
            assert back[i, j] == sum(n * ((x - y) ** 2 // x) for n, x, y in zip(table.values(), p, q, strict=True))


def test_groups_without_terms_and_odd_rows(spark):
    rows = [(None, None, None), ("", "en", "a"), ("one two", "en", "b"), ("12 3-4", "en", "c"), ("x", "fr", "a")]
    rows += [("one one", "en", "d"), ("One", "en", "d"), ("one", "en", "d")]
    assert plain(divergence.audit(frame(spark, rows))) == brute(rows)
    assert plain(divergence.audit(frame(spark, []))) == []


def test_long_texts_and_flushes(spark, monkeypatch):
    rows = [("ab cd " * 200_000 + "e" * 1_500_000, "en", "a"), ("cd " * 3, "en", "b"), ("cd ab", "en", "b"), ("ab", "en", "a"), ("ab", "en", "b")]
    assert plain(divergence.audit(frame(spark, rows))) == brute(rows)
    text = (b"word " * 7).translate(divergence.LETTERS)
    monkeypatch.setattr(divergence, "PIECE", 6)
    assert b"".join(divergence.pieces(text)) == text
    assert divergence.occurrences(b"Aa b\xc3\xa9 aA." + b"c" * 50, divergence.LETTERS) == {b"aa": 2, "bé".encode(): 1, b"c" * 50: 1}
    monkeypatch.setattr(divergence, "HELD", 2)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["e", "e", "f"]), pa.array(["s"] * 3), pa.array(["a b", "b c", "c"])], ["lang", "source", "text"])
    sums, marks = Counter(), set()
    for part in divergence.count_terms(iter([batch])):
        for r in part.to_pylist():
            marks.add((r["lang"], r["source"])) if r["term"] is None else sums.update({(r["lang"], r["term"]): r["n"]})
    assert sums == {("e", "a"): 1, ("e", "b"): 2, ("e", "c"): 1, ("f", "c"): 1} and marks == {("e", "s"), ("f", "s")}
