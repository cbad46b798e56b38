"""Text forms of encoded values, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from monthloom.schema import NEAR_ZERO


def value_text(value: Column) -> Column:
    """Short values as they print, values of seven or more characters to four decimals."""
    text = value.cast("string")
    return F.when(F.length(text) >= 7, F.format_string("%1.4f", value)).otherwise(text)


def dense_text(value: Column) -> Column:
    """Cell of a dense row: ``1``, four decimals, or ``0`` when absent."""
    printed = value_text(value).cast("double")
    return (
        F.when(value.isNull(), "0").when(printed == 1.0, "1").otherwise(F.format_string("%1.4f", printed))
    )


def token_text(idx: Column, value: Column) -> Column:
    return F.concat(idx.cast("string"), F.lit(":"), value_text(value))


def is_significant(value: Column) -> Column:
    """Values within 1e-4 of zero are not written."""
    return F.abs(value) > NEAR_ZERO
