"""Personal data in text: fixed patterns, and a skip-chain conditional random field around them.

``base_spans`` finds e-mail addresses, IP addresses, card and phone numbers by their patterns, in time
linear in the text. The field then labels what the patterns miss in the same document: its nodes are
the base spans and further candidates (numbers of at least ``MIN_DIGITS`` digits in any grouping,
addresses written with "at" or "dot"). A node's own potential comes from its form. Two kinds of edge
carry label consistency: neighbours in the text, and *skip* edges between distant tokens that repeat
or resemble each other (same letters and digits, same last ``MIN_DIGITS`` digits), each group as a
star around its first base span, so edges are linear in the nodes. Loopy sum-product message passing
with damping gives marginals; a candidate joins a kind when that beats "none". Where a document has
no base span every node prefers "none" and its neighbours agree, so such documents are left alone.

Cases: null and empty texts have no spans; positions count code points, end exclusive; repeated rows
get equal results; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import map_batches, texts

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")  # a match never starts inside a run of digits
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

MIN_DIGITS = 9
NUMBER = re.compile(r"[0-9](?:[\x20./()-]{0,2}[0-9]){8,}")
RUN = re.compile(r"[0-9]{9,}")
#: An address from its "at" on.
SPELT = re.compile(r"\x20?(?:[(\[]at[)\]]|@|\x20at\x20)\x20?[A-Z0-9-]+(?:\x20?(?:[(\[]dot[)\]]|\.|\x20dot\x20)\x20?[A-Z0-9-]+)+", re.I | re.A)
AT, DOT = re.compile(r"[(\[]at[)\]]|\x20at\x20|@", re.I), re.compile(r"[(\[]dot[)\]]|\x20dot\x20", re.I)

# Log potentials. "None" is label 0, kind k is label k + 1.
BASE, NONE, FITS, UNFIT = 1000.0, 1.5, 0.5, -6.0
AGREE_SKIP, AGREE_NEAR, NEAR_CHARS = 4.0, 0.25, 24
SWEEPS, DAMPING = 12, 0.3

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: each @ with what may stand before and after it."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        end = DOMAIN.match(text, at + 1)
        start = at
        while end and start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            found.append((start, last := end.end()))
        at = text.find("@", max(at + 1, last))
    return found


def spelt(text: str, begin: int, end: int) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, also written with "at" or "dot": each "at" with what may stand before and after it."""
    found, last, at = [], begin, begin
    while m := SPELT.search(text, at, end):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            found.append((start, m.end()))
            last = at = m.end()
        else:
            at = m.start() + 1
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind and start."""
    found = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(q := p.lstrip("0")) <= 3 and int(q or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(digits := digits_of(m[0])) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
        if "+" in text:
            found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


def key_of(text: str, kind: int | None = None) -> str:
    """What repeated or similar tokens have in common."""
    if kind == 0 or kind is None and AT.search(text):
        return "m" + re.sub(r"\s", "", DOT.sub(".", AT.sub("@", text))).lower()
    digits = digits_of(text)
    return "d" + (digits if kind == 1 or len(digits) < MIN_DIGITS else digits[-MIN_DIGITS:])


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Further tokens outside the base spans; of overlapping ones the smaller come last."""
    taken, mails = sorted((a, b) for _, a, b in base), any(k == 0 for k, _, _ in base)
    gaps = zip([0, *(b for _, b in taken)], [*(a for a, _ in taken), len(text)], strict=True)
    found, seen = [], set()
    for a, b in gaps:
        for span in (*(m.span() for p in (NUMBER, RUN) for m in p.finditer(text, a, max(a, b))), *(spelt(text, a, max(a, b)) if mails else ())):
            if span not in seen:
                seen.add(span)
                found.append(span)
    return found


def own_potential(token: str, kind: int | None) -> list[float]:
    if kind is not None:
        return [0.0, *(BASE if k == kind else UNFIT for k in range(len(KINDS)))]
    digits, parts = digits_of(token), re.split(r"[^0-9]+", token)
    mail = bool(AT.search(token))
    fits = (
        mail,
        not mail and len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts),
        not mail and 13 <= len(digits) <= 19 and luhn(digits),
        not mail and 9 <= len(digits) <= 15,
    )
    return [NONE, *(FITS if f else UNFIT for f in fits)]


def marginals(own: np.ndarray, left: np.ndarray, right: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Loopy sum-product over edges ``left[e] - right[e]``, whose ends gain ``agree[e]`` when equal. Log beliefs."""
    source, target = np.concatenate([left, right]), np.concatenate([right, left])
    bonus, edges = np.concatenate([agree, agree])[:, None], len(left)
    back = np.concatenate([np.arange(edges, 2 * edges), np.arange(edges)])
    message = np.zeros((2 * edges, own.shape[1]))
    for _ in range(SWEEPS):
        belief = own.copy()
        np.add.at(belief, target, message)
        inside = belief[source] - message[back]
        total = np.logaddexp.reduce(inside, axis=1, keepdims=True)
        # sum over the source's labels: every label once, the equal one with its bonus
        new = np.logaddexp(total, inside + np.log(np.expm1(bonus)))
        new -= new.max(axis=1, keepdims=True)
        message = DAMPING * message + (1 - DAMPING) * new
    belief = own.copy()
    np.add.at(belief, target, message)
    return belief


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """What the field labels beside the base spans."""
    more = candidates(text, base) if base else []
    if not more:
        return []
    nodes = [(a, b, k) for k, a, b in base] + [(a, b, None) for a, b in more]
    own = np.array([own_potential(text[a:b], k) for a, b, k in nodes])
    edges: dict[tuple[int, int], float] = {}
    hub: dict[str, int] = {}
    for i, (a, b, k) in enumerate(nodes):  # base spans come first, so a group's hub is one if it has one
        first = hub.setdefault(key_of(text[a:b], k), i)
        if first != i:
            edges[first, i] = AGREE_SKIP
    order = sorted(range(len(nodes)), key=lambda i: nodes[i][:2])
    for i, j in zip(order, order[1:], strict=False):
        if 0 <= nodes[j][0] - nodes[i][1] <= NEAR_CHARS:
            edges.setdefault((min(i, j), max(i, j)), AGREE_NEAR)
    if not edges:
        return []
    left, right = np.array(list(edges)).T
    label = marginals(own, left, right, np.array(list(edges.values()))).argmax(1)
    found: list[Span] = []  # by start
    for (a, b, k), best in zip(nodes, label.tolist(), strict=True):
        if k is None and best:
            at = bisect(found, a, key=lambda span: span[1])
            if (not at or found[at - 1][2] <= a) and (at == len(found) or b <= found[at][1]):
                found.insert(at, (best - 1, a, b))
    return found


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``; the counts are of base spans."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, digests, spans = [], [], []
            for text in texts(batch):
                base = base_spans(text)
                counts.append([sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))] if base else [0] * len(KINDS))
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(base + added_spans(text, base)))
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

        return work

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_batches(rows, make, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    base = base_spans(text)
    out, last = [], 0
    for k, a, b in sorted(base + added_spans(text, base), key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[last:a], f"<{KINDS[k].upper()}>"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns, personal data in ``text`` replaced and ``n_chars`` brought up to date."""
    at, names, schema = docs.columns.index("text"), docs.columns, docs.schema

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            new = [None if t is None else redacted(t) for t in batch.column(at).to_pylist()]
            columns = [pa.array(new, batch.column(at).type) if i == at else batch.column(i) for i in range(len(names))]
            return pa.RecordBatch.from_arrays(columns, names)

        return work

    out = map_batches(docs, make, schema)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast("bigint"))) if "n_chars" in names else out
