"""Basic profile of a user from the category fields, over the whole history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.functions.codes import age_band, phone_model_code, place_code
from monthloom.functions.scaling import index_below
from monthloom.operators.gather import for_listed
from monthloom.schema import is_category


@dataclass(frozen=True)
class Slot:
    """A run of one-hot positions.

    ``pick`` says which codes count: the ``latest`` one, the ``largest`` one, or ``every`` one.
    """

    name: str
    fields: tuple[int, ...]
    width: int
    pick: str


# Source fields and widths, in layout order.
SLOTS = (
    Slot("sex", (1, 57), 3, "latest"),
    Slot("age", (2, 59), 8, "latest"),
    Slot("phone_model", (3,), 6, "every"),
    Slot("phone_family", (4,), 33, "every"),
    Slot("phone_bound", (11,), 2, "largest"),
    Slot("mail_bound", (12,), 2, "largest"),
    Slot("social_bound", (13,), 2, "largest"),
    Slot("province", (18,), 34, "every"),
    Slot("city", (19,), 342, "every"),
)
STARTS = {slot.name: sum(s.width for s in SLOTS[:i]) for i, slot in enumerate(SLOTS)}
PROFILE_WIDTH = sum(slot.width for slot in SLOTS)


def _of(slot: Slot) -> Column:
    return F.col("field_id").isin(*slot.fields)


def _band(code: Column) -> Column:
    """Field 59 holds an age, field 2 the band of one."""
    return F.when(F.col("field_id") == 59, age_band(code)).otherwise(code)


def _recency(slot: Slot) -> Column:
    """Orders a slot's codes newest first; within a month the smaller field id leads."""
    source = sum(((F.col("field_id") == f).cast("int") * i for i, f in enumerate(slot.fields)), F.lit(0))
    return F.when(_of(slot), F.col("dist") * len(slot.fields) + source)


def profile_codes(obs: DataFrame) -> DataFrame:
    """Recoded category observations, ready to be aggregated per user."""
    code = _band(F.col("value").cast("int"))
    code = F.when(F.col("field_id") == 3, phone_model_code(code)).otherwise(code)
    code = F.when(F.col("field_id").isin(18, 19), place_code(code)).otherwise(code)
    return obs.filter(is_category()).select("user", "field_id", code.alias("code"), "dist")


def profile_aggregates() -> list[Column]:
    """Aggregates over a user's :func:`profile_codes` that :func:`profile_positions` reads.

    All of them combine before the shuffle, and the set holds at most one entry per position.
    """
    every = [s for s in SLOTS if s.pick == "every"]
    position = F.coalesce(
        *[F.when(_of(s), STARTS[s.name] + index_below(F.col("code"), s.width, s.name)) for s in every]
    )
    picked = [
        F.min_by(F.when(_of(s), F.col("code")), _recency(s)).alias(s.name)
        if s.pick == "latest"
        else F.max(F.when(_of(s), F.greatest(F.col("code"), F.lit(0)))).alias(s.name)
        for s in SLOTS
        if s.pick != "every"
    ]
    seen = [F.max(_of(s)).alias(f"has_{s.name}") for s in every]
    return [F.collect_set(position).alias("profile"), *picked, *seen]


def profile_positions() -> Column:
    """Array of the user's zero-based positions; a slot without codes falls back to its first."""
    single = [
        STARTS[s.name] + index_below(F.coalesce(F.col(s.name), F.lit(0)), s.width, s.name)
        for s in SLOTS
        if s.pick != "every"
    ]
    empty = [
        F.when(~F.coalesce(F.col(f"has_{s.name}"), F.lit(False)), F.lit(STARTS[s.name]))
        for s in SLOTS
        if s.pick == "every"
    ]
    return F.concat(F.col("profile"), F.array_compact(F.array(*single, *empty)))


def profile_onehot(users: DataFrame, obs: DataFrame) -> DataFrame:
    """One-hot profile of 432 positions as ``(user, idx, value)``."""
    gathered = for_listed(users.select("user"), [profile_codes(obs)], profile_aggregates())
    positions = F.explode(profile_positions()).alias("idx")
    return gathered.select("user", positions, F.lit(1.0).alias("value"))


def profile_numeric(users: DataFrame, obs: DataFrame) -> DataFrame:
    """The latest code of each slot, and how often province and city were observed.

    Eleven values per user, in slot order with each count after its place.
    """
    code = _band(F.col("value").cast("int"))
    rows = obs.filter(is_category()).select("user", "field_id", code.alias("code"), "dist")
    counted = ("province", "city")
    latest = [F.min_by(F.when(_of(s), F.col("code")), _recency(s)).alias(s.name) for s in SLOTS]
    counts = [F.count(F.when(_of(s), 1)).alias(f"{s.name}_count") for s in SLOTS if s.name in counted]
    gathered = for_listed(users.select("user"), [rows], latest + counts)
    names = []
    for slot in SLOTS:
        names += [slot.name, f"{slot.name}_count"] if slot.name in counted else [slot.name]
    values = F.array(*[F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in names])
    return gathered.select("user", F.posexplode(values).alias("idx", "value"))
