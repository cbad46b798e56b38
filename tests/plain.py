"""One-user-at-a-time model of the blocks in plain Python, to check the DataFrame plans against.

A user is a list of ``(dist, field, value)``. Every function returns ``{idx: value}`` with
zero-based ``idx``.
"""

from __future__ import annotations

import math
from itertools import accumulate

CATEGORY = {1, 2, 3, 4, 11, 12, 13, 18, 19, 57, 59}


def mean(values):
    return sum(values) / len(values)


def spread(values):
    return max(values) - min(values)


def merged(user, k, fields, agg):
    by_field = {}
    for dist, field, value in user:
        if dist <= 12 - k and field in fields:
            by_field.setdefault(field, []).append(value)
    return {f: agg(vs) for f, vs in by_field.items()}


def trim(x, bounds):
    lo, hi = bounds
    return lo if x < lo else hi if x > hi else x


def scale(x, bounds):
    lo, hi = bounds
    return x if lo == hi else min(1.0, max(0.0, (x - lo) / (hi - lo)))


def bin5(x):
    return next((i for i, cut in enumerate((0.2, 0.4, 0.6, 0.8)) if x < cut), 4)


def binned(tokens):
    return {5 * i + bin5(x): 1.0 for i, x in tokens.items()}


def values(user, fields, stats, k, agg):
    return {fields[f]: trim(x, stats[f]) for f, x in merged(user, k, fields, agg).items()}


def onehot_values(user, fields, stats, k, agg):
    trimmed = {f: trim(x, stats[f]) for f, x in merged(user, k, fields, agg).items()}
    return binned({fields[f]: scale(x, stats[f]) for f, x in trimmed.items()})


def shares(user, group, fields, stats, k, keep_nan=False):
    known = {f for f in group if f in stats}
    trimmed = {f: trim(x, stats[f]) for f, x in merged(user, k, known, mean).items()}
    total = sum(trimmed.values())
    if total == 0:
        return {fields[f]: math.nan for f in trimmed if f in fields} if keep_nan else {}
    return {fields[f]: x / total for f, x in trimmed.items() if f in fields}


def topn_shares(user, fields, stats, k, n):
    trimmed = {f: trim(x, stats[f]) for f, x in merged(user, k, fields, mean).items()}
    best = dict(sorted(trimmed.items(), key=lambda e: (-e[1], e[0]))[:n])
    total = sum(best.values())
    return binned({fields[f]: x / total for f, x in best.items()}) if total else {}


def log_product(a, b):
    p = a * b
    return 0.0 if p == 0 else math.nan if p < 0 else math.log(p)


def log_pairs(user, pairs, stats, k, scaled):
    members = {f for pair in pairs for f in pair}
    x = {f: trim(v, stats[f]) for f, v in merged(user, k, members, mean).items()}
    if scaled:
        x = {f: scale(v, stats[f]) for f, v in x.items()}
    tokens = {i: log_product(x[a], x[b]) for (a, b), i in pairs.items() if a < b and a in x and b in x}
    return binned(tokens) if scaled else tokens


def ratio_pairs(user, pairs, stats, k):
    members = {f for pair in pairs for f in pair}
    x = {f: scale(trim(v, stats[f]), stats[f]) for f, v in merged(user, k, members, mean).items()}
    ratios = {
        i: x[a] / x[b] if x[b] else 0.0 for (a, b), i in pairs.items() if a != b and a in x and b in x
    }
    return binned({i: r / (1 + abs(r)) for i, r in ratios.items()})


def changes(user, fields, k):
    return {fields[f]: x for f, x in merged(user, k, fields, spread).items()}


def onehot_changes(user, fields, stats, k):
    x = {f: v for f, v in merged(user, k, fields, spread).items() if f in stats}
    return binned({fields[f]: scale(trim(v, stats[f]), stats[f]) for f, v in x.items()})


def missing(user, k, total=5000):
    return total - len({f for dist, f, v in user if dist <= 12 - k and (f in CATEGORY or v > 0)})


def missing_bin(user, k):
    return {bin5(scale(missing(user, k), (10, 5000))): 1.0}


def band(age):
    return 1 + sum(age >= bound for bound in (18, 22, 25, 30, 40, 50))


def codes(user, *fields):
    """Codes newest month first, within a month by field id."""
    newest = sorted((dist, f, int(v)) for dist, f, v in user if f in fields)
    return [band(c) if f == 59 else c for _, f, c in newest]


WIDTHS = (3, 8, 6, 33, 2, 2, 2, 34, 342)


def profile(user):
    model = {2: 1, 11: 2, 12: 3, 16: 4, 17: 5}
    place = lambda c: 0 if c == 34 else c
    slots = [
        codes(user, 1, 57)[:1],
        codes(user, 2, 59)[:1],
        [model.get(c, 0) for c in codes(user, 3)],
        codes(user, 4),
        *[[max([0, *codes(user, f)])] for f in (11, 12, 13)],
        [place(c) for c in codes(user, 18)],
        [place(c) for c in codes(user, 19)],
    ]
    starts = [0, *accumulate(WIDTHS)]
    return {start + c: 1.0 for start, slot in zip(starts, slots, strict=False) for c in (slot or [0])}


def profile_numbers(user):
    numbers = []
    for fields in ((1, 57), (2, 59), (3,), (4,), (11,), (12,), (13,), (18,), (19,)):
        found = codes(user, *fields)
        numbers.append(float(found[0]) if found else 0.0)
        if fields in ((18,), (19,)):
            numbers.append(float(len(found)))
    return dict(enumerate(numbers))


def laid(parts):
    """``(tokens, width)`` blocks end to end from index 1."""
    row, at = {}, 1
    for tokens, width in parts:
        row.update({at + i: x for i, x in tokens.items()})
        at += width
    return row, at - 1
