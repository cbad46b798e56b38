from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from monthloom.functions import codes, months, scaling, text


def lit(x):
    return F.lit(x)


@pytest.mark.parametrize(
    "month, distance, expected",
    [("2017-01", 12, "2016-01"), ("2017-01", 1, "2016-12"), ("2017-05", 4, "2017-01"), ("2017-12", 12, "2016-12")],
)
def test_month_before(value, month, distance, expected):
    assert value(months.month_before(lit(month), distance)) == expected


def test_month_distance(value):
    assert value(months.month_distance(lit("2017-05"), lit("2016-11"))) == 6
    assert value(months.month_distance(lit("2016-11"), lit("2017-05"))) == -6


@pytest.mark.parametrize("bad", ["2017-05-01", "2017-13", "2017-5", "201705"])
def test_other_month_forms_fail(value, bad):
    with pytest.raises(Exception, match="not a yyyy-MM month"):
        value(months.month_ordinal(lit(bad)))


def test_missing_month_stays_missing(value):
    assert value(months.month_ordinal(F.lit(None).cast("string"))) is None


def test_scaling(value):
    assert value(scaling.soft_sign(lit(-3.0))) == -0.75
    assert value(scaling.min_max(lit(7.0), lit(3.0), lit(3.0))) == 7.0
    assert value(scaling.min_max(lit(4.0), lit(2.0), lit(6.0))) == 0.5
    assert value(scaling.min_max(lit(9.0), lit(2.0), lit(6.0))) == 1.0
    assert value(scaling.min_max(lit(1.0), lit(2.0), lit(6.0))) == 0.0
    assert value(scaling.clamp(lit(9.0), lit(2.0), lit(6.0))) == 6.0
    none = F.lit(None).cast("double")
    for args in ((none, lit(2.0), lit(6.0)), (lit(9.0), none, none), (lit(9.0), lit(2.0), none)):
        assert value(scaling.clamp(*args)) is None
        assert value(scaling.min_max(*args)) is None


@pytest.mark.parametrize(
    "x, expected", [(-1.0, 0), (0.2, 1), (0.4, 2), (0.6, 3), (0.8, 4), (1.5, 4), (math.nan, 4)]
)
def test_five_bin(value, x, expected):
    assert value(scaling.five_bin(lit(x))) == expected


def test_guarded_arithmetic(value):
    assert value(scaling.ratio_or_zero(lit(1.0), lit(0.0))) == 0.0
    assert value(scaling.log_product(lit(2.0), lit(0.0))) == 0.0
    assert math.isnan(value(scaling.log_product(lit(2.0), lit(-1.0))))
    assert value(scaling.log_product(lit(math.e), lit(1.0))) == pytest.approx(1.0)
    assert value(scaling.share_of(lit(0.0), lit(0.0), "drop")) is None
    assert math.isnan(value(scaling.share_of(lit(0.0), lit(0.0), "keep")))
    with pytest.raises(ValueError):
        scaling.share_of(lit(0.0), lit(0.0), "other")


def test_index_below(value):
    assert value(scaling.index_below(lit(2), 3, "sex")) == 2
    for bad in (3, -1):
        with pytest.raises(Exception, match="sex code out of range"):
            value(scaling.index_below(lit(bad), 3, "sex"))


@pytest.mark.parametrize(
    "age, band", [(17, 1), (18, 2), (22, 3), (25, 4), (30, 5), (40, 6), (50, 7), (80, 7)]
)
def test_age_band(value, age, band):
    assert value(codes.age_band(lit(age))) == band


def test_recoding(value):
    assert [value(codes.phone_model_code(lit(m))) for m in (2, 11, 12, 16, 17, 99)] == [1, 2, 3, 4, 5, 0]
    assert [value(codes.place_code(lit(p))) for p in (34, 3)] == [0, 3]


@pytest.mark.parametrize(
    "x, expected", [(1.0, "1.0"), (12345.0, "12345.0000"), (0.12345, "0.1235"), (1e7, "1.0E7"), (0.5, "0.5")]
)
def test_value_text(value, x, expected):
    assert value(text.value_text(lit(x))) == expected


def test_dense_text(value):
    assert value(text.dense_text(lit(1.0))) == "1"
    assert value(text.dense_text(lit(0.5))) == "0.5000"
    assert value(text.dense_text(lit(0.99996))) == "1"
    assert value(text.dense_text(F.lit(None).cast("double"))) == "0"
    assert value(text.is_significant(lit(0.00005))) is False
    assert value(text.is_significant(lit(-0.001))) is True


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(1900, 2100), st.integers(1, 12), st.integers(0, 12)), min_size=1, max_size=20))
def test_month_before_inverts_distance(spark, cases):
    rows = [(f"{y:04d}-{m:02d}", d) for y, m, d in cases]
    df = spark.createDataFrame(rows, "month string, d int")
    back = df.select("d", months.month_distance(F.col("month"), months.month_before(F.col("month"), F.col("d"))).alias("r"))
    assert all(r["d"] == r["r"] for r in back.collect())
