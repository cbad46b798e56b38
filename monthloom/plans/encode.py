"""All blocks of a layout in one pass over the observations.

The observations are reduced once to one row per (user, field) with an aggregate for every
window the layout asks for. Each of those rows meets the rulebook, a table that says what a field
contributes to which block. The contributions are brought together by user, turned into tokens and
gathered with the user's label and profile. The numbers are shuffled twice, the first time combined
on the map side, and not at all when users and observations are bucketed by user.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthloom.functions.scaling import (
    BINS,
    clamp,
    five_bin,
    log_product,
    min_max,
    required,
    share_of,
    steady_sum,
)
from monthloom.operators.blocks import pair_sides
from monthloom.operators.gather import for_listed, union_all
from monthloom.operators.merge import without_users
from monthloom.operators.missing import scaled_missing
from monthloom.operators.profile import (
    PROFILE_WIDTH,
    profile_aggregates,
    profile_codes,
    profile_positions,
)
from monthloom.operators.rows import TOKENS
from monthloom.plans.layouts import Block, Changes, LogPairs, Missing, Profile, Shares, Values
from monthloom.schema import MISSING_TOTAL, in_window, is_present
from monthloom.sources.scratch import materialise

LISTED = (Values, Changes, Shares, LogPairs)


def _numbers(blocks: list[Block], *kinds: type) -> list[int]:
    return [b for b, block in enumerate(blocks) if isinstance(block, kinds)]


def _one_hot(blocks: list[Block], *kinds: type) -> list[int]:
    return [b for b in _numbers(blocks, *kinds) if blocks[b].one_hot]


def _among(block: Column, numbers: Iterable[int]) -> Column:
    numbers = list(numbers)
    return block.isin(numbers) if numbers else F.lit(False)


def _unit(block: Block) -> int:
    return BINS if getattr(block, "one_hot", False) else 1


def _entries(blocks: list[Block]) -> DataFrame:
    """Catalogue entries of all blocks: ``(field_id, block, idx, side)``.

    Entries a block can never meet, such as pairs a log block does not look up, keep their ``idx``
    but lose their field, because they still take up room in the row.
    """
    field, parts = F.col("field_id"), []
    for b in _numbers(blocks, *LISTED):
        block = blocks[b]
        if isinstance(block, LogPairs):
            seats = pair_sides(block.pairs, F.col("left_id") < F.col("right_id"))
            parts.append(seats.withColumn("block", F.lit(b)))
            continue
        if isinstance(block, Shares) and block.group is not None:
            met = F.when(block.group.contains(), field)
        else:
            met = field
        parts.append(block.fields.select(met.alias("field_id"), F.lit(b).alias("block"), "idx"))
    entries = union_all(parts)
    return entries if "side" in entries.columns else entries.withColumn("side", F.lit(None).cast("int"))


def rulebook(blocks: list[Block], stats: DataFrame, change_stats: DataFrame | None = None) -> DataFrame:
    """``(field_id, block, idx, side, lo, hi, leads)``, written out as a table.

    Share blocks over a whole group also list the fields that only count towards the total; their
    ``idx`` is null. ``leads`` marks one rule per field, to count the field once.
    """
    entries = _entries(blocks)
    grouped = [b for b in _numbers(blocks, Shares) if blocks[b].group is not None]
    if grouped:
        towards = F.array_compact(
            F.array(*[F.when(blocks[b].group.contains(), F.lit(b)) for b in grouped])
        )
        members = stats.select("field_id", F.explode(towards).alias("block"))
        # A pair entry is told apart by its number, any other by its field and block.
        seat = F.when(F.col("side").isNotNull() | F.col("field_id").isNull(), F.col("idx"))
        entries = (
            union_all([entries, members])
            .groupBy("field_id", "block", "side", seat.alias("seat"))
            .agg(F.max("idx").alias("idx"))
        )
    changed = _one_hot(blocks, Changes)
    if changed and change_stats is None:
        raise ValueError("a one-hot change block needs change_stats")
    ranges = stats.select("field_id", F.lit(False).alias("of_change"), "lo", "hi")
    if changed:
        ranges = ranges.unionByName(change_stats.select("field_id", F.lit(True).alias("of_change"), "lo", "hi"))
    rules = entries.withColumn("of_change", _among(F.col("block"), changed)).join(
        ranges, ["field_id", "of_change"], "left"
    )
    # Entries without a field meet no row; they are spread, as there may be many.
    alone = F.when(F.col("field_id").isNull(), F.xxhash64("block", "idx", "side"))
    first = F.row_number().over(Window.partitionBy("field_id", alone).orderBy("block", "idx")) == 1
    return materialise(
        rules.select("field_id", "block", F.col("idx").cast("int").alias("idx"), "side", "lo", "hi", first.alias("leads"))
    )


def block_starts(blocks: list[Block], rules: DataFrame | None) -> tuple[list[int], int]:
    """First index of each block, counted from 1, and the size of the whole row.

    One number per block comes back to the driver.
    """
    sizes = {}
    if rules is not None:
        counted = rules.groupBy("block").agg(F.count_distinct("idx").alias("n"))
        sizes = {r["block"]: r["n"] for r in counted.collect()}
    starts, at = [], 1
    for b, block in enumerate(blocks):
        starts.append(at)
        if isinstance(block, Profile):
            at += PROFILE_WIDTH
        elif isinstance(block, Missing):
            at += _unit(block)
        else:
            at += _unit(block) * sizes.get(b, 0)
    return starts, at - 1


def _by_block(choices: dict[int, Column]) -> Column:
    """The column chosen by the number of the block at hand, or null."""
    block = F.col("block")
    return F.coalesce(*[F.when(block == b, choice) for b, choice in choices.items()])


def _contribution(blocks: list[Block], measures: dict) -> Column:
    """Value a field adds to the block of the rule at hand; null if it has none to add.

    A field without statistics fails value and pair blocks, and is left out of the others.
    """
    block, lo, hi = F.col("block"), F.col("lo"), F.col("hi")
    merged = _by_block({b: F.col(measures[(blocks[b].agg, blocks[b].k)]) for b in _numbers(blocks, *LISTED)})
    raw = set(_numbers(blocks, Changes)) - set(_one_hot(blocks, Changes))
    message = F.concat(F.lit("no statistics for field "), F.col("field_id").cast("string"))
    known = lo.isNotNull() | _among(block, _numbers(blocks, Shares, Changes))
    trimmed = required(clamp(merged, lo, hi), known, message)
    to_scale = _one_hot(blocks, Values, Changes, LogPairs)
    return F.when(merged.isNull() | _among(block, raw), merged).otherwise(
        F.when(_among(block, to_scale), min_max(trimmed, lo, hi)).otherwise(trimmed)
    )


def _finished_seats(blocks: list[Block]) -> Column:
    """Seats sorted by pair and side: a left seat followed by its right one makes a token."""
    binned = _one_hot(blocks, LogPairs)

    def token(seat, i):
        right = F.get("seats", i + 1)
        value = log_product(seat["x"], right["x"])
        whole = (seat["side"] == 0) & (right["block"] == seat["block"]) & (right["place"] == seat["place"])
        one_hot = _among(seat["block"], binned)
        made = F.struct(
            (seat["place"] + F.when(one_hot, five_bin(value)).otherwise(0)).alias("idx"),
            F.when(one_hot, 1.0).otherwise(value).alias("value"),
        )
        return F.when(whole, made)

    return F.array_compact(F.transform("seats", token))


def _finished_profile(start: int) -> Column:
    return F.transform("profile", lambda i: F.struct((i + start).alias("idx"), F.lit(1.0).alias("value")))


def _finished_missing(block: Missing, start: int, total: int) -> Column:
    left = F.lit(total) - F.coalesce(F.col(f"present{block.k}"), F.lit(0))
    place, value = F.lit(start), left.cast("double")
    if block.one_hot:
        place, value = place + five_bin(scaled_missing(left)), F.lit(1.0)
    return F.array(F.struct(place.alias("idx"), value.alias("value")))


def _fields(obs: DataFrame, blocks: list[Block], measures: dict, windows: list[int]) -> DataFrame:
    """One row per (user, field): every measure of the layout, and whether the field is present."""
    value = F.col("value")
    reach = min([k for _, k in measures] + windows)
    return (
        obs.filter(in_window(reach))
        .groupBy("user", "field_id")
        .agg(
            *[agg(F.when(in_window(k), value)).alias(name) for (agg, k), name in measures.items()],
            *[F.max(F.when(in_window(k) & is_present(), 1)).alias(f"present{k}") for k in windows],
        )
    )


def _contributions(
    obs: DataFrame,
    blocks: list[Block],
    rules: DataFrame,
    starts: list[int],
    measures: dict,
    windows: list[int],
    nan_policy: str,
) -> DataFrame:
    """One row per (user, field, rule) with its finished ``token``, or its ``seat`` in a pair."""
    rows = _fields(obs, blocks, measures, windows).join(rules, "field_id", "left")
    # The leading rule speaks for the field; a field without rules has a single row anyway.
    counted = [
        F.when(F.coalesce("leads", F.lit(True)), F.col(f"present{k}")).alias(f"present{k}") for k in windows
    ]
    place = _by_block(
        {b: F.lit(starts[b]) + F.col("idx") * _unit(blocks[b]) for b in _numbers(blocks, *LISTED)}
    )
    rows = rows.select(
        "user", "block", "side", place.alias("place"), _contribution(blocks, measures).alias("x"), *counted
    )
    x, shares = F.col("x"), _numbers(blocks, Shares)
    if shares:
        # The totals also bring a user's rows together, once, before anything is collected.
        user = Window.partitionBy("user")
        totals = {b: steady_sum(F.when(F.col("block") == b, F.col("x")), lambda c: F.sum(c).over(user)) for b in shares}
        rows = rows.withColumns({f"total{b}": total for b, total in totals.items()})
        total = _by_block({b: F.col(f"total{b}") for b in shares})
        x = F.when(_among(F.col("block"), shares), share_of(F.col("x"), total, nan_policy)).otherwise(F.col("x"))
        # A share of NaN only stands for an observed field.
        x = F.when(F.col("x").isNotNull(), x)
    rows = rows.withColumn("x", x).withColumn("here", F.col("x").isNotNull() & F.col("place").isNotNull())
    binned = _among(F.col("block"), _one_hot(blocks, Values, Changes, Shares))
    token = F.struct(
        (F.col("place") + F.when(binned, five_bin(F.col("x"))).otherwise(0)).alias("idx"),
        F.when(binned, 1.0).otherwise(F.col("x")).alias("value"),
    )
    columns = [F.when(F.col("here") & F.col("side").isNull(), token).alias("token")]
    if _numbers(blocks, LogPairs):
        seat = F.struct("block", "place", "side", "x")
        columns.append(F.when(F.col("here") & F.col("side").isNotNull(), seat).alias("seat"))
    return rows.select("user", *[f"present{k}" for k in windows], *columns)


def encode_layout(
    users: DataFrame,
    obs: DataFrame,
    stats: DataFrame,
    blocks: list[Block],
    change_stats: DataFrame | None = None,
    excluded: DataFrame | None = None,
    nan_policy: str = "drop",
    missing_total: int = MISSING_TOTAL,
    laid: tuple[DataFrame | None, list[int], int] | None = None,
) -> DataFrame:
    """Rows ``(user, label, feature_size, tokens)`` of a layout, one per user.

    ``laid`` has the rulebook, the blocks' first indices and the size, where these are known already.
    """
    if excluded is not None:
        users = without_users(users, excluded)  # observations of users who are not listed fall away in the gathering
    windows = sorted({blocks[b].k for b in _numbers(blocks, Missing)})
    wanted = dict.fromkeys((blocks[b].agg, blocks[b].k) for b in _numbers(blocks, *LISTED))
    measures = {m: f"m{n}" for n, m in enumerate(wanted)}
    if laid is None:
        rules = rulebook(blocks, stats, change_stats) if measures else None
        laid = (rules, *block_starts(blocks, rules))
    rules, starts, size = laid

    parts, gathered, finished = [], [F.max("label").alias("label")], []
    if measures:
        parts.append(_contributions(obs, blocks, rules, starts, measures, windows, nan_policy))
        gathered.append(F.collect_list("token").alias("gathered_tokens"))
        finished.append(F.col("gathered_tokens"))
    elif windows:
        parts.append(_fields(obs, blocks, measures, windows).drop("field_id"))
    gathered += [F.sum(f"present{k}").alias(f"present{k}") for k in windows]
    if _numbers(blocks, LogPairs):
        gathered.append(F.sort_array(F.collect_list("seat")).alias("seats"))
        finished.append(_finished_seats(blocks))
    base = users.select("user", "label")
    if _numbers(blocks, Profile):
        known = for_listed(base, [profile_codes(obs)], [F.max("label").alias("label"), *profile_aggregates()])
        base = known.select("user", "label", profile_positions().alias("profile"))
        gathered.append(F.first("profile", ignorenulls=True).alias("profile"))
        finished += [_finished_profile(starts[b]) for b in _numbers(blocks, Profile)]
    else:
        base = base.groupBy("user").agg(F.max("label").alias("label"))
    finished += [_finished_missing(blocks[b], starts[b], missing_total) for b in _numbers(blocks, Missing)]
    whole = for_listed(base, parts, gathered)
    tokens = F.sort_array(F.concat(*[f.cast(TOKENS) for f in finished]))
    return whole.select("user", "label", F.lit(size).alias("feature_size"), tokens.alias("tokens"))


def _moved(moves: list[tuple[int, int, int]]) -> Column:
    """The tokens of blocks ``(first, end, by)`` of a long row, in a layout's own numbering."""

    def by(idx: Column) -> Column:
        return F.coalesce(*[F.when((idx >= lo) & (idx < hi), F.lit(step)) for lo, hi, step in moves])

    kept = F.filter("tokens", lambda t: by(t["idx"]).isNotNull())
    return F.sort_array(F.transform(kept, lambda t: F.struct((t["idx"] + by(t["idx"])).alias("idx"), t["value"].alias("value")))).cast(TOKENS)


def encode_layouts(
    users: DataFrame,
    obs: DataFrame,
    stats: DataFrame,
    layouts: Mapping[str, list[Block]],
    change_stats: DataFrame | None = None,
    excluded: DataFrame | None = None,
    nan_policy: str = "drop",
    missing_total: int = MISSING_TOTAL,
) -> DataFrame:
    """Rows ``(layout, user, label, feature_size, tokens)`` of several layouts from one pass.

    Blocks that layouts share are laid out once. All different blocks form one long row, from a single
    aggregate per (user, field), one rulebook and one gathering; it is cut into the layouts' rows at
    the very end, so a sink that writes one folder per layout reads the observations once.
    """
    blocks = list(dict.fromkeys(block for own in layouts.values() for block in own))
    listed = _numbers(blocks, *LISTED)
    rules = rulebook(blocks, stats, change_stats) if listed else None
    starts, size = block_starts(blocks, rules)
    long = encode_layout(users, obs, stats, blocks, change_stats, excluded, nan_policy, missing_total, laid=(rules, starts, size))
    ends = [*starts[1:], size + 1]
    rows = []
    for name, own in layouts.items():
        at, moves = 1, []
        for b in map(blocks.index, own):
            moves.append((starts[b], ends[b], at - starts[b]))
            at += ends[b] - starts[b]

        rows.append(F.struct(F.lit(name).alias("layout"), F.lit(at - 1).alias("feature_size"), _moved(moves).alias("tokens")))
    cut = long.select("user", "label", F.inline(F.array(*rows)))
    return cut.select("layout", "user", "label", "feature_size", "tokens")
