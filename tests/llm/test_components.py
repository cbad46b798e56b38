from __future__ import annotations

import random

import pytest
from monthloom.llm.components import components


def brute(edges):
    """Smallest node reachable, of every node that is not that itself."""
    group = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    return {n: c for n, c in group.items() if n != c}


DRAW = random.Random(4)
GRAPHS = {
    "none": [],
    "loop": [(3, 3)],
    "path": [(i, i + 1) for i in range(40)],
    "hub": [(100, i) for i in range(60)] + [(100, 200)],
    "random": [(DRAW.randrange(150), DRAW.randrange(150)) for _ in range(110)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_smallest_reachable_node(spark, name):
    edges = GRAPHS[name]
    found = components(spark.createDataFrame(edges + edges[:3], "a bigint, b bigint")).collect()
    assert sorted((r["node"], r["component"]) for r in found) == sorted(brute(edges).items())
