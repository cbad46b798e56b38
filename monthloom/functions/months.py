"""Month arithmetic on ``yyyy-MM`` text, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_PATTERN = r"^[0-9]{4}-(0[1-9]|1[0-2])$"


def month_ordinal(month: Column) -> Column:
    """``12 * year + month``; anything but ``yyyy-MM`` fails the query."""
    ordinal = F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int")
    bad = F.raise_error(F.concat(F.lit("not a yyyy-MM month: "), month)).cast("int")
    return F.when(month.isNull(), F.lit(None).cast("int")).when(
        month.rlike(MONTH_PATTERN), ordinal
    ).otherwise(bad)


def month_text(ordinal: Column) -> Column:
    """Inverse of :func:`month_ordinal`."""
    month = F.pmod(ordinal - 1, F.lit(12)) + 1
    year = ((ordinal - month) / 12).cast("int")
    return F.format_string("%04d-%02d", year, month)


def month_distance(later: Column, earlier: Column) -> Column:
    return month_ordinal(later) - month_ordinal(earlier)


def month_before(month: Column, distance: Column | int) -> Column:
    """The month ``distance`` months before ``month``."""
    return month_text(month_ordinal(month) - distance)
