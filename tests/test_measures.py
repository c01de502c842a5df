import math
from decimal import Decimal
from fractions import Fraction

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame

from farelake.operators import (
    duplicate_keys,
    match_coverage,
    route_frequency,
    row_counts,
    sort_by,
    top_routes,
    weighted_mean,
)

SCHEMA = "k string, price double, seats int"


def means(spark, data, **options):
    df = spark.createDataFrame(data, SCHEMA)
    return {row.k: (row.priceAVG, row.seats) for row in weighted_mean(df, ["k"], **options).collect()}


def test_mean_of_one_group(spark):
    assert means(spark, [("a", 100.0, 1), ("a", 200.0, 3)]) == {"a": (175.0, 4)}


def test_types(spark):
    df = weighted_mean(spark.createDataFrame([("a", 1.0, 1)], SCHEMA), ["k"])
    assert df.schema.simpleString() == "struct<k:string,priceAVG:double,seats:bigint>"


def test_weight_of_a_missing_price(spark):
    data = [("a", None, 5), ("a", 100.0, 5)]
    assert means(spark, data) == {"a": (50.0, 10)}
    assert means(spark, data, null_weight="exclude") == {"a": (100.0, 5)}


def test_zero_and_missing_weights_give_null(spark):
    data = [("zero", 3.0, 0), ("none", 3.0, None), ("unpriced", None, 2), (None, 4.0, 1)]
    assert means(spark, data) == {
        "zero": (None, 0),
        "none": (None, None),
        "unpriced": (None, 2),
        None: (4.0, 1),
    }


def test_half_cents_round_up_whatever_the_order(spark):
    # 0.1 + 0.2 style sums in doubles fall on either side of the tie.
    data = [("a", 0.1, 1), ("a", 0.2, 1), ("a", 0.3, 1), ("a", 0.02, 1)]
    assert means(spark, data) == means(spark, data[::-1]) == {"a": (0.16, 4)}
    assert means(spark, [("a", 1.01, 1), ("a", 1.0, 1)]) == {"a": (1.01, 2)}
    assert means(spark, [("a", -1.01, 1), ("a", -1.0, 1)]) == {"a": (-1.01, 2)}


def test_rounds_only_once(spark):
    # 100499.9999999 / 100000 = 1.004999999999 must not become 1.005 on the way.
    data = [("a", 1.004999, 1_000_000), ("a", 1.005, 1_999_999_999), ("a", 1.005, 2_000_000_000)]
    exact = Fraction(1_004_999 * 10**6 + 1_005_000 * 3_999_999_999, 10**6 * 4_000_999_999)
    assert Fraction("1.0049995") < exact < Fraction("1.005")
    assert means(spark, data)["a"][0] == 1.0


def test_prices_with_more_places_than_the_result(spark):
    data = [("a", 1.004, 1), ("a", 1.008, 1)]
    assert means(spark, data) == {"a": (1.01, 2)}
    assert means(spark, data, digits=3) == {"a": (1.006, 2)}


def test_values_beyond_the_bounds_have_no_mean(spark):
    data = [("nan", float("nan"), 1), ("nan", 5.0, 1), ("inf", math.inf, 2), ("inf", 1.0, 2)]
    data += [("big", 1e14, 1), ("big", 3.0, 1), ("ok", 2.0, 1), ("weightless", 1e30, None)]
    data += [("within", 99_999_999_999_999.0, 1), ("product", 9e13, 2_000_000_000)]
    got = means(spark, data)
    assert got["nan"] == (None, 2) and got["inf"] == (None, 4) and got["big"] == (None, 2)
    assert got["ok"] == (2.0, 1)
    assert got["weightless"] == (None, None)
    assert got["within"] == (99_999_999_999_999.0, 1)
    assert got["product"] == (9e13, 2_000_000_000)


def test_a_sum_beyond_the_bounds_has_no_mean(spark):
    df = spark.createDataFrame([("a", 4e13, 2 * 10**12)] * 2, "k string, price double, seats bigint")
    assert rows(weighted_mean(df, ["k"]).select("priceAVG")) == [(None,)]


def test_no_cent_is_lost_beyond_a_billion(spark):
    data = [("a", 1000000000.47, 3), ("a", 1000000000.93, 1)]
    assert means(spark, data) == means(spark, data[::-1]) == {"a": (1000000000.59, 4)}


def test_values_are_not_rounded_before_they_are_summed(spark):
    assert means(spark, [("a", 0.0049999996, 1)]) == {"a": (0.0, 1)}
    assert means(spark, [("a", 0.0000004, 1)], digits=7) == {"a": (4e-07, 1)}


def test_decimals_are_taken_as_they_are(spark):
    df = spark.createDataFrame(
        [("a", Decimal("10000000000000.01"), 1), ("a", Decimal("0.02"), 1)],
        "k string, price decimal(20,2), seats int",
    )
    assert rows(weighted_mean(df, ["k"])) == [("a", 5000000000000.02, 2)]


def test_hundredths_are_exact_up_to_a_billion(spark):
    data = [(str(c), c / 100, 1) for c in (99_999_999_999, 99_999_999_998, 12_345_678_901, 1, 29)]
    assert means(spark, data) == {k: (int(k) / 100, 1) for k, _, _ in data}


def test_sums_beyond_64_bits(spark):
    data = [("a", 4_000.01, 2_000_000_000), ("a", 4_000.02, 2_000_000_000)] * 2
    assert means(spark, data) == {"a": (4000.02, 8_000_000_000)}


def test_rejects_bad_options(spark):
    df = spark.createDataFrame([("a", 1.0, 1)], SCHEMA)
    with pytest.raises(ValueError):
        weighted_mean(df, ["k"], null_weight="maybe")
    with pytest.raises(TypeError):
        weighted_mean(df, ["k"], value="seats", weight="price")


cents = st.one_of(st.none(), st.integers(0, 10_000_000))
seats = st.one_of(st.none(), st.integers(0, 400))


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(st.sampled_from("ab"), cents, seats), max_size=40))
@pytest.mark.parametrize("null_weight", ["include", "exclude"])
def test_equals_a_plain_fold(session, null_weight, data):
    expected = {}
    for key in {k for k, _, _ in data}:
        mine = [(c, s) for k, c, s in data if k == key]
        weights = [
            s for c, s in mine if s is not None and (c is not None or null_weight == "include")
        ]
        products = [c * s for c, s in mine if c is not None and s is not None]
        mean = None
        if products and sum(weights):
            mean = int(Fraction(sum(products), sum(weights)) + Fraction(1, 2)) / 100
        expected[key] = (mean, sum(weights) if weights else None)
    prices = [(k, None if c is None else c / 100, s) for k, c, s in data]
    assert means(session, prices, null_weight=null_weight) == expected


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.integers(0, 300),
            st.decimals(0, 10**13, places=2) | st.decimals(0, 1000, places=7),
            st.integers(1, 500),
        ),
        min_size=1,
        max_size=400,
    )
)
def test_no_group_is_off_on_either_side_of_a_billion(session, data):
    data = [(str(k), float(v), w) for k, v, w in data]
    expected = {}
    for key in {k for k, _, _ in data}:
        mine = [(Fraction(repr(v)), w) for k, v, w in data if k == key]
        total = sum(w for _, w in mine)
        cents = int(sum(v * w for v, w in mine) / total * 100 + Fraction(1, 2))
        expected[key] = (cents / 100, total)
    assert means(session, data) == expected


def test_route_frequency_counts_known_origins(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("b", "x"), ("b", "y"), ("c", None), ("d", "x")],
        "destination string, origin string",
    )
    assert [tuple(r) for r in route_frequency(df).collect()] == [
        ("b", 2),
        ("a", 1),
        ("d", 1),
        ("c", 0),
    ]
    assert [tuple(r) for r in top_routes(df, 2).collect()] == [("b", 2), ("a", 1)]


def test_sort_by_month_is_total(spark):
    df = spark.createDataFrame(
        [(m, k) for k in "cab" for m in (12, 2, 7)], "month int, company string"
    )
    got = [tuple(r) for r in sort_by(df, "month", ["company", "month"]).collect()]
    assert got == sorted(got) and len(got) == 9


def test_counts(spark):
    df = spark.createDataFrame([(1, "t"), (1, None), (2, "u")], "k int, time string")
    assert rows(row_counts({"all": df, "none": df.where("false")})) == [("all", 3), ("none", 0)]
    assert rows(match_coverage(df)) == [(3, 2)]
    assert rows(duplicate_keys(df, ["k"])) == [(1, 2)]
    assert isinstance(row_counts({"one": df}), DataFrame)
