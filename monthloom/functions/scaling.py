"""Numeric transforms of a single value, as Column expressions.

Divisions are guarded, so they behave the same with and without ANSI mode. ``greatest`` and
``least`` skip nulls, so a missing value or bound is tested for before they are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")
BINS = 5
FINE = float(1 << 20)


def soft_sign(x: Column) -> Column:
    return x / (1 + F.abs(x))


def clamp(x: Column, lo: Column, hi: Column) -> Column:
    """``x`` trimmed to [lo, hi]; null where the value or a bound is null."""
    given = x.isNotNull() & lo.isNotNull() & hi.isNotNull()
    return F.when(given, F.greatest(lo, F.least(hi, x)))


def min_max(x: Column, lo: Column, hi: Column) -> Column:
    """``x`` scaled to [0, 1]; a constant range leaves ``x`` as it is.

    Null where the value or a bound is null.
    """
    share = F.try_divide(x - lo, hi - lo)
    return F.when(lo == hi, x).when(share.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def five_bin(x: Column) -> Column:
    """Bin 0-4 at .2, .4, .6 and .8; NaN sorts above every number and lands in bin 4."""
    return F.when(x < 0.2, 0).when(x < 0.4, 1).when(x < 0.6, 2).when(x < 0.8, 3).otherwise(4)


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def log_product(a: Column, b: Column) -> Column:
    """log(a * b), 0 for a zero product and NaN for a negative one."""
    product = a * b
    return F.when(product == 0, 0.0).when(product < 0, F.lit(NAN)).otherwise(F.log(product))


def share_of(x: Column, total: Column, nan_policy: str) -> Column:
    """``x / total``; a zero total gives null (``drop``) or NaN (``keep``)."""
    if nan_policy not in ("drop", "keep"):
        raise ValueError(f"nan_policy must be 'drop' or 'keep', not {nan_policy!r}")
    share = F.try_divide(x, total)
    return share if nan_policy == "drop" else F.coalesce(share, F.lit(NAN))


def steady_sum(x: Column, total: Callable[[Column], Column] = F.sum) -> Column:
    """Sum of doubles that does not depend on their order; ``total`` sums a column.

    A plain sum may differ in its last digit with the order of the rows, enough to put a share on the other side of a
    bin's edge. Here multiples of 1 / ``FINE`` and what is left of each value are summed apart, both without
    rounding for values of 1 and more, or 0, up to totals of 2 ** 33; beyond, it is as good as a plain sum.
    """
    coarse = F.rint(x * FINE) / FINE
    return total(coarse) + total(F.when(coarse == x, 0.0).otherwise(x - coarse))


def required(value: Column, known: Column, message: Column | str) -> Column:
    """``value`` where ``known`` holds; otherwise the query fails.

    The check sits inside the value, so column pruning cannot drop it.
    """
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(known, value).otherwise(F.raise_error(text).cast("double"))


def index_below(index: Column, width: int, what: str) -> Column:
    """``index`` if it lies in [0, width); otherwise the query fails."""
    message = F.concat(F.lit(f"{what} code out of range: "), index.cast("string"))
    return F.when(index.between(0, width - 1), index).otherwise(F.raise_error(message).cast("int"))
