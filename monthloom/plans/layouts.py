"""Row layouts: which blocks make up a row, in which order and over which window."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.operators.blocks import Aggregate
from monthloom.operators.statistics import max_change
from monthloom.schema import FIELD_GROUPS, FULL_YEAR, HALF_YEAR, ONE_SEASON, THREE_SEASONS, FieldGroup


@dataclass(frozen=True)
class Values:
    """Merged, trimmed values of a catalogue; one-hot blocks scale and bin them."""

    fields: DataFrame
    k: int
    agg: Aggregate = F.avg
    one_hot: bool = False


@dataclass(frozen=True)
class Changes:
    """Largest less smallest value; one-hot blocks trim, scale and bin it."""

    fields: DataFrame
    k: int
    one_hot: bool = True
    agg: Aggregate = max_change


@dataclass(frozen=True)
class Shares:
    """Shares of a catalogue in the user's total over ``group``, or over the catalogue itself."""

    fields: DataFrame
    k: int
    group: FieldGroup | None = None
    agg: Aggregate = F.avg
    one_hot: bool = False


@dataclass(frozen=True)
class LogPairs:
    """Log of the product of both members of a pair; one-hot blocks scale the members and bin."""

    pairs: DataFrame
    k: int
    agg: Aggregate = F.avg
    one_hot: bool = True


@dataclass(frozen=True)
class Profile:
    """One-hot basic profile."""


@dataclass(frozen=True)
class Missing:
    """Missing count, as it is or scaled and binned."""

    k: int
    one_hot: bool = False


Block = Values | Changes | Shares | LogPairs | Profile | Missing


@dataclass(frozen=True)
class Catalogues:
    """The field and pair lists the layouts draw on."""

    average: Mapping[int, DataFrame]
    maximum: Mapping[int, DataFrame]
    rates: Mapping[str, DataFrame]
    linear: DataFrame | None = None
    log_pairs: DataFrame | None = None
    changes: DataFrame | None = None
    groups: tuple[FieldGroup, ...] = field(default=FIELD_GROUPS)


def _window(lists: Catalogues, k: int) -> list[Block]:
    """Families of consecutive ids are shared out over the whole family, the two that take every
    fourth id over their own list."""
    shares = [
        Shares(lists.rates[g.name], k, group=g if g.step == 1 else None)
        for g in lists.groups
    ]
    return [
        Profile(),
        Values(lists.average[k], k),
        Values(lists.maximum[k], k, F.max),
        *shares,
        Missing(k),
    ]


def full_year(lists: Catalogues) -> list[Block]:
    return _window(lists, FULL_YEAR)


def three_seasons(lists: Catalogues) -> list[Block]:
    return _window(lists, THREE_SEASONS)


def half_year(lists: Catalogues) -> list[Block]:
    return _window(lists, HALF_YEAR)


def one_season(lists: Catalogues) -> list[Block]:
    return _window(lists, ONE_SEASON)


def year_and_half(lists: Catalogues) -> list[Block]:
    """Year and half-year values side by side; every share is over its own list."""
    return [
        *[Shares(lists.rates[g.name], FULL_YEAR) for g in lists.groups],
        *[
            Values(fields[k], k, agg)
            for k in (FULL_YEAR, HALF_YEAR)
            for fields, agg in ((lists.average, F.avg), (lists.maximum, F.max))
        ],
        Profile(),
        Missing(FULL_YEAR),
        Missing(HALF_YEAR),
    ]


def linear(lists: Catalogues) -> list[Block]:
    """One-hot half-year row for a linear model."""
    return [
        Profile(),
        Values(lists.linear, HALF_YEAR, one_hot=True),
        *[Shares(lists.rates[g.name], HALF_YEAR, one_hot=True) for g in lists.groups],
        LogPairs(lists.log_pairs, HALF_YEAR),
        Changes(lists.changes, HALF_YEAR),
        Missing(HALF_YEAR, one_hot=True),
    ]


LAYOUTS: dict[str, Callable[[Catalogues], list[Block]]] = {
    "full_year": full_year,
    "three_seasons": three_seasons,
    "half_year": half_year,
    "one_season": one_season,
    "year_and_half": year_and_half,
    "linear": linear,
}
