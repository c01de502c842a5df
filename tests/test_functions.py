from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farelake.functions import (
    half_up_ratio,
    normalize_decimal_text,
    parse_int,
    parse_locale_decimal,
)


def apply(spark, cells, function):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    return [row.x for row in df.select("i", function("c").alias("x")).orderBy("i").collect()]


def test_parse_int(spark):
    cells = ["12", " 7 ", "-3", "5.7", "x", "", None, "3000000000", "1,2"]
    assert apply(spark, cells, parse_int) == [12, 7, -3, None, None, None, None, None, None]


def test_parse_int_lenient(spark):
    cells = ["12", "5.7", "-5.7", "x", None, "3000000000", "2147483647"]
    expected = [12, 5, -5, None, None, None, 2147483647]
    assert apply(spark, cells, lambda c: parse_int(c, lenient=True)) == expected


def test_parse_locale_decimal(spark):
    cells = ["312,90", "7", "0,5", "1.234,56", "1,2,3", "abc", "", None, "-1,5"]
    expected = [312.9, 7.0, 0.5, None, None, None, None, None, -1.5]
    assert apply(spark, cells, parse_locale_decimal) == expected


def test_parse_locale_decimal_grouping(spark):
    cells = ["1.234,56", "1.234.567,8", "312,90", None]
    parsed = apply(spark, cells, lambda c: parse_locale_decimal(c, grouping="."))
    assert parsed == [1234.56, 1234567.8, 312.9, None]


def test_parse_locale_decimal_other_mark(spark):
    parsed = apply(spark, ["1'234|5"], lambda c: parse_locale_decimal(c, "|", grouping="'"))
    assert parsed == [1234.5]


def test_normalize_decimal_text_keeps_text(spark):
    assert apply(spark, ["1,50", "2", None, "a,b"], normalize_decimal_text) == [
        "1.50",
        "2",
        None,
        "a.b",
    ]


def half_up(ratio: Fraction, digits: int) -> float:
    scaled = abs(ratio) * 10**digits
    whole = int(scaled + Fraction(1, 2))
    return float(Fraction(whole if ratio >= 0 else -whole, 10**digits))


@pytest.mark.parametrize(
    ("numerator", "denominator", "expected"),
    [
        ("0.125", 1, 0.13),
        ("-0.125", 1, -0.13),
        ("0.125", -1, -0.13),
        ("2.675", 1, 2.68),
        ("1", 3, 0.33),
        ("5", 0, None),
        (None, 4, None),
        ("5", None, None),
        # The quotient is 1.00499999999995: rounding it to six places first would give 1.01.
        ("100499999999.995", 100000000000, 1.0),
        ("10050000000000000000.000000", 10000000000000000000 // 10, 10.05),
    ],
)
def test_half_up_ratio(spark, numerator, denominator, expected):
    # Both sides in millionths, which are integers.
    n = None if numerator is None else Decimal(numerator).scaleb(6)
    d = None if denominator is None else Decimal(denominator).scaleb(6)
    df = spark.createDataFrame([(n, d)], "n decimal(38,0), d decimal(26,0)")
    assert df.select(half_up_ratio(F.col("n"), F.col("d"), 2)).first()[0] == expected


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.integers(-(10**12), 10**12), st.integers(-(10**6), 10**6).filter(lambda d: d != 0)
        ),
        min_size=1,
        max_size=60,
    )
)
def test_half_up_ratio_is_exact(session, pairs):
    data = [(i, Decimal(n), Decimal(1000 * d)) for i, (n, d) in enumerate(pairs)]
    df = session.createDataFrame(data, "i int, n decimal(38,0), d decimal(20,0)")
    got = df.select("i", half_up_ratio(F.col("n"), F.col("d"), 2).alias("x")).orderBy("i")
    expected = [half_up(Fraction(n, 1000 * d), 2) for n, d in pairs]
    assert [row.x for row in got.collect()] == expected
