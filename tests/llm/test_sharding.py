from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import pytest
from monthloom.llm import sharding
from monthloom.llm.queries import op11_sharding
from pyspark.sql import functions as F
from tests.llm.conftest import SF, plain

SLOTS, SHARDS = 64, 5


def totals_of(rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["virtual_slot"]] += r["n"] * r["size"]
    return sizes


def model(sizes, held, shards):
    """The next map by plain lists."""
    mean, load, moving, out = sum(sizes.values()) / shards, [0] * shards, [], dict(held)
    for shard in range(shards):
        upto = 0
        for slot in sorted((s for s in held if held[s] == shard), key=lambda s: (-sizes[s], s)):
            upto += sizes[slot]
            if upto <= mean:
                load[shard] += sizes[slot]
            else:
                moving.append(slot)
    for slot in sorted(moving, key=lambda s: (-sizes[s], s)):
        out[slot] = load.index(min(load))
        load[out[slot]] += sizes[slot]
    return out


def as_dict(slot_map):
    return {r["slot"]: r["shard"] for r in slot_map.collect()}


def texts(n, seed=1):
    draw = random.Random(seed)
    return [(i, "é" * int(draw.paretovariate(1.1))) for i in range(n)]


def check(found, rows, shards=SHARDS):
    """Every row once, with its own size and checksum, and no gap in any shard."""
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in found) == want
    places = defaultdict(list)
    for r in found:
        places[r["shard"]].append(r["slot"])
    assert set(places) <= set(range(shards))
    for own in places.values():
        assert sorted(own) == list(range(len(own)))


def test_maps_equal_a_plain_model(spark, docs):
    rows = texts(500)
    cells = sharding.records(docs(rows), SLOTS)
    totals = sharding.slot_totals(cells)
    sizes = totals_of(cells.collect())
    first = sharding.first_map(spark, SHARDS, SLOTS)
    second = sharding.rebalanced(first, totals, SHARDS)
    assert as_dict(second) == model(sizes, as_dict(first), SHARDS)
    found = plain(sharding.place(cells, second, totals))
    check(found, rows)
    assert all(as_dict(second)[r["virtual_slot"]] == r["shard"] for r in found)
    kept = sum(as_dict(first)[s] == as_dict(second)[s] for s in range(SLOTS))
    assert kept > SLOTS / 2  # an edit, not a new deal


def test_a_new_shard_only_takes(spark, docs):
    cells = sharding.records(docs(texts(2000, 4)), 512)
    totals = sharding.slot_totals(cells)
    old = sharding.rebalanced(sharding.first_map(spark, SHARDS, 512), totals, SHARDS)
    new = sharding.grown(old, totals, SHARDS)
    before, after, sizes = as_dict(old), as_dict(new), totals_of(cells.collect())
    assert all(after[s] in (before[s], SHARDS) for s in before) and SHARDS in after.values()
    loads = [sum(sizes[s] for s in after if after[s] == k) for k in range(SHARDS + 1)]
    assert max(loads) <= sum(loads) / (SHARDS + 1) + SHARDS * max(sizes.values())
    assert {r["version"] for r in new.collect()} == {2}


def test_stored_versions(spark, docs, tmp_path):
    path = str(tmp_path / "maps")
    totals = sharding.slot_totals(sharding.records(docs(texts(100)), SLOTS))
    first = sharding.first_map(spark, SHARDS, SLOTS)
    second = sharding.rebalanced(first, totals, SHARDS)
    sharding.write_map(first, path)
    sharding.write_map(second, path)
    assert as_dict(sharding.read_map(spark, path)) == as_dict(second)
    assert as_dict(sharding.read_map(spark, path, 0)) == as_dict(first)


@pytest.mark.parametrize("clash", [False, True])
def test_written_shards(spark, docs, tmp_path, clash):
    rows = texts(200)
    frame = docs(rows).withColumn("shard", F.lit("own")) if clash else docs(rows)
    slot_map = sharding.first_map(spark, SHARDS, SLOTS)
    name = sharding.write_shards(frame, slot_map, str(tmp_path / "out"), SLOTS)
    back = spark.read.parquet(str(tmp_path / "out"))
    want = {r["doc_id"]: r["shard"] for r in sharding.place(sharding.records(frame, SLOTS), slot_map, sharding.slot_totals(sharding.records(frame, SLOTS))).collect()}
    assert {r["doc_id"]: r[name] for r in back.collect()} == want
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == rows


def test_a_third_alike_and_odd_rows(docs):
    rows = [(7, "same")] * 200 + [(None, None)] * 100 + [(None, "x"), (8, None), (9, ""), (-(2**63), "y" * 300_000)] + texts(300)
    found = plain(sharding.shard_documents(docs(rows).repartition(5), SHARDS, SLOTS))
    check(found, rows)


def test_empty_table(docs):
    assert plain(sharding.shard_documents(docs([]), SHARDS, SLOTS)) == []


def test_sizes_are_near_equal(docs):
    rows = [(i, t[:200]) for i, t in texts(20_000, 9)]
    found = sharding.shard_documents(docs(rows)).groupBy("shard").agg(F.sum("size").alias("bytes")).collect()
    loads = [r["bytes"] for r in found]
    assert len(loads) == sharding.SHARDS and max(loads) < 1.001 * min(loads)


def test_query_uses_no_python_on_rows(spark):
    found = op11_sharding(spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)
    assert {r["law"] for r in found.collect()} == {"bytes"}
