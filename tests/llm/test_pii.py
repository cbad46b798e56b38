from __future__ import annotations

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from monthloom.llm import pii
from tests.llm.conftest import plain


def luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        d = int(c)
        total += d if k % 2 == 0 else (2 * d if 2 * d < 10 else 2 * d - 9)
    return total % 10 == 0


def brute(text):
    """The patterns as the contract writes them."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((3, *m.span()))
    return sorted(found)


PIECES = ["a@b.co", "x.y%z@mail7.example.com", "@", "a@b", "@@", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4068516892505468", "4111 1111-1111 1111", "4111  1111",
          "+1 (136) 555-7479", "+", "+1", "+1 2", "é", " ", "-", ".", "(", ")", "0", "12", "999", "\n", "٣", "+49.30.1234567", "a", "b.c"]


@pytest.mark.parametrize("seed", range(8))
def test_base_spans_are_the_patterns(seed):
    draw = random.Random(seed)
    for _ in range(1500):
        text = "".join(draw.choice(PIECES) for _ in range(draw.randint(0, 12)))
        assert sorted(pii.base_spans(text)) == brute(text), text


def added(text):
    base = pii.base_spans(text)
    return [(pii.KINDS[k], text[a:b]) for k, a, b in sorted(pii.added_spans(text, base))]


def test_field_labels_what_repeats_a_base_span():
    assert added("call +1 (136) 555-7479 now ... again 136.555.7479 bye") == [("phone", "136.555.7479")]
    assert added("card 4111111111111111 then 12 4111111111111111 end") == [("card", "4111111111111111")]
    assert added("jo@mail.example.com or jo (at) mail (dot) example (dot) com") == [("email", "jo (at) mail (dot) example (dot) com")]
    far = "call +1 (136) 555-7479. " + "lorem ipsum " * 3000 + "1365557479"
    assert added(far) == [("phone", "1365557479")]
    many = "+1 (136) 555-7479 " + "x 1365557479 " * 40
    assert added(many) == [("phone", "1365557479")] * 40


def test_field_leaves_other_text_alone():
    assert added("order 9876543210 and order 9876543210 and 9876543210") == []
    assert added("call +1 (136) 555-7479, order 9876543210, order 9876543210") == []
    assert added("look at this. a@b.co is at home") == []


def test_query_rows(docs):
    rows = [(1, None), (2, ""), (3, "é a@b.co"), (3, "é a@b.co"), (None, "+49 30 1234567"), (4, "word " * 50_000 + "1.2.3.4")]
    out = {(r["doc_id"], r["spans"]): r for r in plain(pii.find(docs(rows)))}
    empty = hashlib.sha256(b"").hexdigest()
    assert out[1, ""]["base_sha256"] == out[2, ""]["base_sha256"] == empty
    assert out[3, "email:2:8"]["n_email"] == 1
    assert out[None, "phone:0:14"]["n_phone"] == 1
    assert out[4, "ip:250000:250007"]["base_sha256"] == hashlib.sha256(b"ip:250000:250007").hexdigest()
    assert plain(pii.find(docs([]))) == []


def test_redact_keeps_rows_and_columns(docs):
    frame = docs([(1, "mail a@b.co!"), (2, None), (3, "plain"), (4, "+1 (136) 555-7479 = 1365557479")])
    out = pii.redact(frame)
    assert out.columns == frame.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.collect() if r["text"]) == [(1, "mail <EMAIL>!"), (3, "plain"), (4, "<PHONE> = <PHONE>")]
    assert out.filter("doc_id = 2").first()["text"] is None


def test_time_is_linear_in_broken_and_unbroken_texts():
    texts = ["a@b.co " + "x" * 1_000_000, "a@b.co " + "x at " * 200_000, "a@b.co " + "dot at " * 150_000, "555-123-4567 " * 40_000 + "a@b.co", "+1 (136) 555-7479 " + "1365557479 " * 20_000]
    for text in texts:
        began = time.monotonic()
        pii.added_spans(text, pii.base_spans(text))
        assert time.monotonic() - began < 10
    assert pii.base_spans("0" * 9000 + "1.1.1.1") == [(1, 0, 9007)]


@pytest.mark.parametrize("seed", range(5))
def test_messages_against_enumeration(seed):
    """On a tree, message passing gives the marginals of all labellings."""
    rng = np.random.default_rng(seed)
    own, left, right, agree = rng.normal(size=(5, 3)), np.array([0, 0, 1, 1]), np.array([1, 2, 3, 4]), rng.uniform(0.3, 4.0, 4)
    weight = np.zeros((5, 3))
    for labels in itertools.product(range(3), repeat=5):
        score = sum(own[i, k] for i, k in enumerate(labels)) + sum(g for a, b, g in zip(left, right, agree, strict=True) if labels[a] == labels[b])
        for i, k in enumerate(labels):
            weight[i, k] += np.exp(score)
    belief = np.exp(pii.marginals(own, left, right, agree))
    assert np.allclose(belief / belief.sum(1, keepdims=True), weight / weight.sum(1, keepdims=True), atol=2e-3)
