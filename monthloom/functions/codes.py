"""Recoding of category values, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper age bounds (exclusive) of bands 1-6, older ages are band 7;
# phone models with a code of their own, all others are 0; the place code that means "unknown".
AGE_BOUNDS = (18, 22, 25, 30, 40, 50)
PHONE_MODELS = (2, 11, 12, 16, 17)
UNKNOWN_PLACE = 34


def age_band(age: Column) -> Column:
    """1 + the number of bounds the age has reached."""
    reached = [(age >= bound).cast("int") for bound in AGE_BOUNDS]
    return sum(reached, F.lit(1))


def phone_model_code(model: Column) -> Column:
    """Position of the model in the known list, counted from 1, or 0."""
    known = F.array(*[F.lit(m) for m in PHONE_MODELS])
    return F.array_position(known, model).cast("int")


def place_code(place: Column) -> Column:
    return F.when(place == UNKNOWN_PLACE, 0).otherwise(place)
