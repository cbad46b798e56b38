from __future__ import annotations

import math
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from monthloom.operators import blocks, missing, profile, rows
from monthloom.plans.encode import encode_layout
from monthloom.plans.layouts import LAYOUTS, Catalogues, Changes, LogPairs, Missing, Profile, Shares, Values
from monthloom.schema import FIELD_GROUPS
from tests import plain

OBS = "user string, dist int, field_id int, value double"
USERS = "user string, label_month string, label int"
CATALOGUE = "field_id int, idx int"
RANGES = "field_id int, lo double, hi double"
PAIRS = "left_id int, right_id int, idx int"

GROUP_FIELDS = {
    "query_detail": (131, 132, 133, 140),
    "query_stat": (10131, 10140),
    "app_duration": (10234, 10235, 40180),
    "app_days": (40181, 68114),
    "app_times": (68115, 96048),
    "app_install": (96051, 96055),
    "app_open_time": (96052, 96056),
}
MEASURES = sorted(f for fields in GROUP_FIELDS.values() for f in fields)
LISTED = {f: i for i, f in enumerate(f for f in MEASURES if f != 140)}
FEW = {f: i for i, f in enumerate(list(LISTED)[::3])}
RATES = {g: {f: i for i, f in enumerate(fields[1:])} for g, fields in GROUP_FIELDS.items()}
LOG = {(131, 132): 0, (131, 10131): 1, (10131, 96051): 2, (96051, 131): 3, (40181, 96056): 4}
RATIO = {(131, 132): 0, (132, 131): 1, (96051, 131): 2, (10131, 10131): 3, (131, 40181): 4}


def random_users(seed=5, n=60):
    rng = random.Random(seed)
    users = {f"u{i}": [] for i in range(n)}
    for name, user in users.items():
        if name in ("u0", "u1"):
            continue
        for dist in rng.sample(range(-2, 13), rng.randint(1, 9)):
            for f in rng.sample(MEASURES, rng.randint(0, 9)):
                user.append((dist, f, float(rng.choice([0, 0, 1, 2, 3.5, 7, 40, rng.randint(0, 300)]))))
            for f, top in ((1, 2), (57, 2), (2, 7), (59, 70), (3, 20), (4, 32), (11, 1), (12, 1), (18, 33), (19, 341)):
                if rng.random() < 0.4:
                    user.append((dist, f, float(rng.randint(0, top))))
            if rng.random() < 0.2 and not any(e[:2] == (dist, 18) for e in user):
                user.append((dist, 18, 34.0))
    return users


USERS_BY_NAME = random_users()
STATS = {f: (float(i % 3), float(i % 3 + 5 * (i % 4))) for i, f in enumerate(MEASURES) if f != 140}
CHANGE_STATS = {f: (0.0, float(3 + i)) for i, f in enumerate(MEASURES) if i % 4}


@pytest.fixture(scope="module")
def data(frame):
    def flat(x):
        return x if isinstance(x, tuple) else (x,)

    def table(mapping, schema):
        return frame([(*flat(k), *flat(v)) for k, v in mapping.items()], schema)

    listed, few = table(LISTED, CATALOGUE), table(FEW, CATALOGUE)
    rates = {g: table(r, CATALOGUE) for g, r in RATES.items()}
    log_pairs = table(LOG, PAIRS)
    return SimpleNamespace(
        users=frame([(u, "2017-01", i % 2) for i, u in enumerate(USERS_BY_NAME)], USERS).cache(),
        obs=frame([(u, *e) for u, es in USERS_BY_NAME.items() for e in es], OBS).cache(),
        listed=listed,
        few=few,
        rates=rates,
        stats=table(STATS, RANGES),
        change_stats=table(CHANGE_STATS, RANGES),
        log_pairs=log_pairs,
        ratio_pairs=table(RATIO, PAIRS),
        catalogues=Catalogues(
            average={k: listed for k in (0, 3, 6, 9)},
            maximum={k: few for k in (0, 3, 6, 9)},
            rates=rates,
            linear=few,
            log_pairs=log_pairs,
            changes=listed,
        ),
    )


def check(df, expected):
    """Compares ``(user, idx, value)`` with a function of one user's records."""
    got = {}
    for r in df.collect():
        assert r["idx"] not in got.setdefault(r["user"], {}), "token repeats"
        got[r["user"]][r["idx"]] = r["value"]
    for name, user in USERS_BY_NAME.items():
        want = expected(user)
        assert sorted(got.get(name, {})) == sorted(want), name
        for i, x in want.items():
            assert got[name][i] == pytest.approx(x, abs=1e-9, nan_ok=True), (name, i)


@pytest.mark.parametrize("k", [0, 3, 6, 9])
def test_values(data, k):
    check(blocks.tree_block(data.obs, data.listed, data.stats, k), lambda u: plain.values(u, LISTED, STATS, k, plain.mean))
    check(blocks.tree_block(data.obs, data.few, data.stats, k, F.max), lambda u: plain.values(u, FEW, STATS, k, max))


def test_other_aggregates(data):
    check(blocks.tree_block(data.obs, data.few, data.stats, 0, F.min), lambda u: plain.values(u, FEW, STATS, 0, min))


def test_onehot_values(data):
    check(
        blocks.onehot_block(data.obs, data.listed, data.stats, 6),
        lambda u: plain.onehot_values(u, LISTED, STATS, 6, plain.mean),
    )


def test_fields_without_statistics(data, frame):
    odd = frame([(140, 0), (131, 1)], CATALOGUE)
    with pytest.raises(Exception, match="no statistics for field 140"):
        blocks.tree_block(data.obs, odd, data.stats).collect()
    with pytest.raises(Exception, match="no statistics for field 140"):
        blocks.tree_block(data.obs, odd, data.stats).agg(F.sum("value")).collect()
    check(
        blocks.tree_block(data.obs, odd, data.stats, on_missing_stats="drop"),
        lambda u: plain.values(u, {131: 1}, STATS, 0, plain.mean),
    )
    with pytest.raises(Exception, match="no statistics for field 140"):
        encode_layout(data.users, data.obs, data.stats, [Values(odd, 0)]).collect()


@pytest.mark.parametrize("policy", ["drop", "keep"])
def test_shares(data, frame, policy):
    group = frame([(f,) for f in GROUP_FIELDS["query_detail"]], "field_id int")
    keep = policy == "keep"
    check(
        blocks.tree_rate(data.obs, group, data.rates["query_detail"], data.stats, 3, nan_policy=policy),
        lambda u: plain.shares(u, GROUP_FIELDS["query_detail"], RATES["query_detail"], STATS, 3, keep),
    )
    check(
        blocks.onehot_rate(data.obs, data.few, data.stats, 0, nan_policy=policy),
        lambda u: plain.binned(plain.shares(u, FEW, FEW, STATS, 0, keep)),
    )


def test_shares_of_a_catalogue_sum_to_one(data):
    shares = blocks.tree_rate(data.obs, data.few.select("field_id"), data.few, data.stats)
    sums = shares.groupBy("user").agg(F.sum("value").alias("s")).collect()
    assert sums and all(r["s"] == pytest.approx(1.0) for r in sums)


@pytest.mark.parametrize("n", [1, 3])
def test_topn_shares(data, n):
    check(
        blocks.onehot_topn_rate(data.obs, data.listed, data.stats, 0, n),
        lambda u: plain.topn_shares(u, LISTED, STATS, 0, n),
    )


def test_pairs(data):
    check(blocks.tree_log_pair(data.obs, data.log_pairs, data.stats), lambda u: plain.log_pairs(u, LOG, STATS, 0, False))
    check(
        blocks.onehot_log_pair(data.obs, data.log_pairs, data.stats, 6),
        lambda u: plain.log_pairs(u, LOG, STATS, 6, True),
    )
    check(
        blocks.onehot_ratio_pair(data.obs, data.ratio_pairs, data.stats),
        lambda u: plain.ratio_pairs(u, RATIO, STATS, 0),
    )


def test_changes(data):
    check(blocks.tree_max_change(data.obs, data.listed, 3), lambda u: plain.changes(u, LISTED, 3))
    check(
        blocks.onehot_max_change(data.obs, data.listed, data.change_stats, 6),
        lambda u: plain.onehot_changes(u, LISTED, CHANGE_STATS, 6),
    )


@pytest.mark.parametrize("k", [0, 9])
def test_missing(data, k):
    check(missing.missing_count(data.users, data.obs, k), lambda u: {0: plain.missing(u, k)})
    check(missing.missing_onehot(data.users, data.obs, k), lambda u: plain.missing_bin(u, k))


def test_missing_one_month(data):
    got = {(r["user"], r["dist"]): r["value"] for r in missing.missing_one_month(data.obs).collect()}
    for name, user in USERS_BY_NAME.items():
        for dist in {d for d, _, _ in user}:
            held = sum(1 for d, f, _ in user if d == dist and f not in plain.CATEGORY)
            assert got[(name, dist)] == pytest.approx((5000 - held - 10) / 4990)


def test_profile(data):
    check(profile.profile_onehot(data.users, data.obs), plain.profile)
    check(profile.profile_numeric(data.users, data.obs), plain.profile_numbers)


def test_profile_cases(frame):
    users = frame([("a", "2017-01", 0)], USERS)

    def positions(*records):
        obs = frame([("a", *r) for r in records], OBS)
        return sorted(r["idx"] for r in profile.profile_onehot(users, obs).collect())

    starts = profile.STARTS
    assert positions((1, 18, 34.0), (2, 18, 3.0))[-3:-1] == [starts["province"], starts["province"] + 3]
    models = [p - starts["phone_model"] for p in positions((1, 3, 2.0), (2, 3, 99.0), (3, 3, 17.0))]
    assert [m for m in models if 0 <= m < 6] == [0, 1, 5]
    assert positions((1, 57, 2.0), (1, 1, 1.0), (2, 1, 0.0))[0] == 1
    assert positions((1, 59, 45.0), (1, 2, 3.0))[1] == starts["age"] + 3
    assert positions((1, 59, 45.9))[1] == starts["age"] + 6
    with pytest.raises(Exception, match="province code out of range: 35"):
        positions((1, 18, 35.0))
    with pytest.raises(Exception, match="sex code out of range: 3"):
        positions((1, 1, 3.0))


def expected_blocks(layout, user):
    mean, few, listed = plain.mean, len(FEW), len(LISTED)
    width = {g: len(r) for g, r in RATES.items()}
    inside = {
        g.name: {f for f in MEASURES if g.lo <= f <= g.hi} if g.step == 1 else RATES[g.name] for g in FIELD_GROUPS
    }
    windows = {"full_year": 0, "three_seasons": 3, "half_year": 6, "one_season": 9}
    if layout in windows:
        k = windows[layout]
        return [
            (plain.profile(user), 432),
            (plain.values(user, LISTED, STATS, k, mean), listed),
            (plain.values(user, FEW, STATS, k, max), few),
            *[(plain.shares(user, inside[g], RATES[g], STATS, k), width[g]) for g in RATES],
            ({0: plain.missing(user, k)}, 1),
        ]
    if layout == "year_and_half":
        return [
            *[(plain.shares(user, RATES[g], RATES[g], STATS, 0), width[g]) for g in RATES],
            (plain.values(user, LISTED, STATS, 0, mean), listed),
            (plain.values(user, FEW, STATS, 0, max), few),
            (plain.values(user, LISTED, STATS, 6, mean), listed),
            (plain.values(user, FEW, STATS, 6, max), few),
            (plain.profile(user), 432),
            ({0: plain.missing(user, 0)}, 1),
            ({0: plain.missing(user, 6)}, 1),
        ]
    return [
        (plain.profile(user), 432),
        (plain.onehot_values(user, FEW, STATS, 6, mean), 5 * few),
        *[(plain.binned(plain.shares(user, RATES[g], RATES[g], STATS, 6)), 5 * width[g]) for g in RATES],
        (plain.log_pairs(user, LOG, STATS, 6, True), 5 * len(LOG)),
        (plain.onehot_changes(user, LISTED, CHANGE_STATS, 6), 5 * listed),
        (plain.missing_bin(user, 6), 5),
    ]


@pytest.mark.parametrize("layout", list(LAYOUTS))
def test_layouts(data, layout):
    encoded = encode_layout(
        data.users, data.obs, data.stats, LAYOUTS[layout](data.catalogues), change_stats=data.change_stats, nan_policy="drop"
    )
    got = {r["user"]: r for r in encoded.collect()}
    assert set(got) == set(USERS_BY_NAME)
    for name, user in USERS_BY_NAME.items():
        want, size = plain.laid(expected_blocks(layout, user))
        row = got[name]
        indices = [t["idx"] for t in row["tokens"]]
        assert row["feature_size"] == size
        assert indices == sorted(want), name
        assert all(a < b for a, b in zip(indices, indices[1:], strict=False)) and indices[-1] <= size
        for t in row["tokens"]:
            assert t["value"] == pytest.approx(want[t["idx"]], abs=1e-9), (name, t)


def test_windows_nest(data):
    """A user has at least the value tokens of a shorter window in every longer one."""
    sizes = []
    for k in (0, 3, 6, 9):
        block = blocks.tree_block(data.obs, data.listed, data.stats, k).select("user", "idx")
        sizes.append({tuple(r) for r in block.collect()})
    assert all(shorter <= longer for longer, shorter in zip(sizes, sizes[1:], strict=False))


def test_kept_nan_shares_in_layouts(data):
    encoded = encode_layout(
        data.users,
        data.obs,
        data.stats,
        LAYOUTS["linear"](data.catalogues),
        change_stats=data.change_stats,
        nan_policy="keep",
    )
    dropped = encode_layout(
        data.users, data.obs, data.stats, LAYOUTS["linear"](data.catalogues), change_stats=data.change_stats, nan_policy="drop"
    )
    count = lambda df: df.select(F.sum(F.size("tokens"))).head()[0]
    assert count(encoded) > count(dropped)


def test_tree_variants_of_pairs_and_changes(data):
    parts = [LogPairs(data.log_pairs, 0, one_hot=False), Changes(data.listed, 3, one_hot=False)]
    encoded = encode_layout(data.users, data.obs, data.stats, parts)
    for r in encoded.collect():
        user = USERS_BY_NAME[r["user"]]
        want, _ = plain.laid(
            [(plain.log_pairs(user, LOG, STATS, 0, False), len(LOG)), (plain.changes(user, LISTED, 3), len(LISTED))]
        )
        assert {t["idx"]: t["value"] for t in r["tokens"]} == pytest.approx(want, abs=1e-9)


def test_layout_without_catalogues(data):
    encoded = encode_layout(data.users, data.obs, data.stats, [Profile(), Missing(0), Missing(6, one_hot=True)])
    row = next(r for r in encoded.collect() if r["user"] == "u0")
    assert row["feature_size"] == 438
    assert row["tokens"][-2:] == [(433, 5000.0), (438, 1.0)]


def test_excluded_users(data, frame):
    encoded = encode_layout(
        data.users,
        data.obs,
        data.stats,
        LAYOUTS["one_season"](data.catalogues),
        excluded=frame([("u0",), ("u7",), ("nobody",)], "user string"),
    )
    assert {r["user"] for r in encoded.select("user").collect()} == set(USERS_BY_NAME) - {"u0", "u7"}


def test_unlisted_users_get_no_row(data):
    some = data.users.filter("user in ('u0', 'u5')")
    encoded = encode_layout(some, data.obs, data.stats, LAYOUTS["one_season"](data.catalogues))
    assert {r["user"] for r in encoded.collect()} == {"u0", "u5"}


def test_rows_from_triples(data):
    triples = blocks.tree_block(data.obs, data.listed, data.stats).withColumn("idx", F.col("idx") + 1)
    gathered = {r["user"]: r for r in rows.rows_from_triples(triples, data.users, len(LISTED)).collect()}
    for name, user in USERS_BY_NAME.items():
        want = {i + 1: x for i, x in plain.values(user, LISTED, STATS, 0, plain.mean).items()}
        assert {t["idx"]: t["value"] for t in gathered[name]["tokens"]} == pytest.approx(want)


def test_text_and_vector_forms(frame):
    tokens = "array<struct<idx:int,value:double>>"
    data = frame(
        [
            ("a", 1, 6, [(1, 1.0), (3, 0.12345), (4, 0.00005), (6, 12345.0)]),
            ("b", 0, 6, []),
            ("c", 0, 6, [(6, math.nan)]),
        ],
        f"user string, label int, feature_size int, tokens {tokens}",
    )
    sparse = {r["user"]: r["features"] for r in rows.to_sparse_rows(data).collect()}
    assert sparse == {"a": "1 1:1.0 3:0.1235 6:12345.0000", "b": "0", "c": "0 6:NaN"}
    dense = {r["user"]: r["features"] for r in rows.to_csv_rows(data.filter("user <> 'c'")).collect()}
    assert dense == {"a": "1,0,0.1235,0,0,12345.0000", "b": "0,0,0,0,0,0"}
    vectors = {r["user"]: r["features"] for r in rows.to_vectors(data).collect()}
    assert vectors["a"].size == 6 and list(vectors["a"].indices) == [0, 2, 5]
    assert list(vectors["b"].indices) == []
    assert rows.to_triples(data).count() == 5


EDGE = (42.0, 47.0, 92.0, 18.0, 14.0, 12.0, 64.0, 25.0)  # the third and the seventh are sums of three months


def edge_users(frame):
    """Users with the same values under different fields, the first one's 42 of 210 under field 131."""
    rng, rows = random.Random(4), []
    for user in range(300):
        order = [0, *rng.sample(range(1, 8), 7)]
        for field, at in enumerate(order, 131):
            rows += [(str(user), m, field, EDGE[at] if m == 0 else 0.0) for m in range(3 if at in (2, 6) else 1)]
    stats = frame([(f, 0.0, 1000.0) for f in range(131, 139)], RANGES)
    return frame(rows, OBS), frame([(f, f - 131) for f in range(131, 139)], CATALOGUE), stats


def test_a_share_on_the_edge_of_a_bin_is_the_same_for_any_order_of_the_fields(frame):
    """42 of 210, which the same eight values sum to in one order and to 210.00000000000003 in another."""
    obs, fields, stats = edge_users(frame)
    hot = blocks.onehot_rate(obs, fields, stats).filter("idx < 5").groupBy("idx").count().collect()
    assert [(r["idx"], r["count"]) for r in hot] == [(1, 300)]


def test_a_share_in_a_row_is_the_same_for_any_order_of_the_fields(frame):
    obs, fields, stats = edge_users(frame)
    users = obs.select("user").distinct().select("user", F.lit(0).alias("label"))
    laid = encode_layout(users, obs, stats, [Shares(fields, 0)]).select(F.explode("tokens").alias("t"))
    assert [r["value"] for r in laid.filter("t.idx = 1").select("t.value").distinct().collect()] == [0.2]
