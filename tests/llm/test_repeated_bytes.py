from __future__ import annotations

import random

import pytest
from monthloom.llm import repeated_bytes
from tests.llm.conftest import plain

N = repeated_bytes.LENGTH


def brute(rows):
    """Marks every byte of every string that has started earlier."""
    datas = {i: (t or "").encode() for i, t in rows}
    seen, out = set(), {}
    for i in sorted(datas):
        data = datas[i]
        gone = bytearray(len(data))
        for s in range(len(data) - N + 1):
            string = data[s : s + N]
            if string in seen:
                gone[s : s + N] = b"\1" * N
            seen.add(string)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g))
    return out


def corpus(seed=2):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (10, 14, 16, 18, 25, 60, 200)]
    line = "x" * 60
    texts = [None, "", "short", "a" * 99, "a" * 100, "a" * 101, "a" * 500, "ab" * 300, line + prose(3), passages[5]]
    for _ in range(60):
        parts = [draw.choice([prose(draw.randint(1, 40)), draw.choice(passages), draw.choice(passages)[5:], line]) for _ in range(draw.randint(1, 6))]
        texts.append("\n".join(parts))
    texts += [draw.choice(texts[10:]) for _ in range(10)]
    texts += [t[: len(t) // 2] + "#" + t[len(t) // 2 :] for t in texts[12:20]]
    ids = list(range(len(texts)))
    draw.shuffle(ids)
    return list(zip(ids, texts, strict=True))


def run(docs, rows):
    out = repeated_bytes.remove(docs(rows).repartition(5))
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out.collect()}


@pytest.mark.parametrize(("segment", "group"), [(1 << 18, 4096), (1024, 3)])
def test_matches_marking_every_byte(docs, monkeypatch, segment, group):
    """Also with tiny segments and with nearly every anchor treated as a hot one."""
    monkeypatch.setattr(repeated_bytes, "SEGMENT", segment)
    monkeypatch.setattr(repeated_bytes, "GROUP", group)
    rows = corpus()
    assert run(docs, rows) == brute(rows)


def test_one_passage_over_many_partitions(spark, docs):
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        passage = "".join(random.Random(1).choices("abcdefgh ", k=160))
        rows = [(i, passage if i % 3 else f"{i} {passage[:130]} {i}") for i in range(120)]
        assert run(docs, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_table_null_and_repeated_ids(docs):
    assert run(docs, []) == {}
    long = "".join(random.Random(4).choices("abcdefgh", k=300))
    out = plain(repeated_bytes.remove(docs([(None, long), (3, long), (3, long), (3, None)])).select("doc_id", "n_bytes", "n_removed", "n_spans"))
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"], r["n_spans"]) for r in out) == [(-1, 300, 0, 0), (3, 0, 0, 0), (3, 300, 300, 1), (3, 300, 300, 1)]


def test_different_texts_under_one_id(docs, monkeypatch):
    """Rows of one id, of none and of the lowest number are cut by their own repeats only."""
    draw = random.Random(6)
    prose = lambda n: "".join(draw.choices("abcdefgh ", k=n))
    a, b, shared = prose(150), prose(400), prose(160)
    lowest = -(1 << 63)
    rows = [(None, a + a), (None, b[:300]), (lowest, b[100:]), (5, prose(180)), (5, shared + prose(90)), (6, shared), (6, prose(200))]
    rows += [(7, shared[:130] + str(k % 3)) for k in range(12)]
    for group in (4096, 3):
        monkeypatch.setattr(repeated_bytes, "GROUP", group)
        out = repeated_bytes.remove(docs(rows).repartition(5)).select("doc_id", "n_bytes", "n_removed", "n_spans").collect()
        assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"]) for r in out) == sorted(
            [(False, 0, 300, 150, 1), (False, 0, 300, 0, 0), (True, lowest, 300, 200, 1), (True, 5, 180, 0, 0), (True, 5, 250, 0, 0), (True, 6, 160, 160, 1)]
            + [(True, 6, 200, 0, 0)]
            + [(True, 7, 131, 130, 1)] * 12
        )


def edge(g, c, doc, is_open):
    return {"g": g, "c": c, "doc": doc, "row": 0, "a": 0, "shape": 0, "open": is_open}


def test_borders():
    duplicates, opened = repeated_bytes.across_borders(
        [[edge(1, 1, 1, False), edge(5, 1, 1, False)], [edge(5, 1, 2, False)], [edge(5, 1, 3, True), edge(7, 2, 1, False)], [edge(7, 3, 1, False)]]
    )
    assert [r[:3] for r in duplicates] == [(5, 1, 2), (5, 1, 3)]
    assert [r[:3] for r in opened] == [(5, 1, 1), (7, 2, 1), (7, 3, 1)]
