import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farelake.operators import lookup_place, match, match_operations

KEYS = ["k", "j"]


@pytest.fixture
def sides(spark):
    """Aggregated rows, and a right side with a third of its rows under one key."""
    left = spark.range(40).select(
        F.when(F.col("id") < 38, F.col("id")).alias("k"),
        F.lit("x").alias("j"),
        (F.col("id") * 10).alias("v"),
    )
    spread = spark.range(0, 600, 1, 7).select(
        (F.col("id") % 50 + 5).alias("k"),
        F.when(F.col("id") % 11 != 0, "x").alias("j"),
        F.col("id").alias("w"),
    )
    copies = spark.range(0, 300, 1, 7).select(
        F.lit(3).cast("bigint").alias("k"), F.lit("x").alias("j"), F.lit(-1).cast("bigint").alias("w")
    )
    return left, spread.unionAll(copies)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_shuffled_join_gives_what_a_broadcast_does(sides, how, conf):
    left, right = sides
    broadcast = rows(match(left, right, KEYS, how))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    assert rows(match(left, right, KEYS, how)) == broadcast


key = st.one_of(st.none(), st.integers(0, 4))


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(key, max_size=8),
    st.lists(key, max_size=30),
    st.sampled_from(["left", "inner"]),
)
def test_match_equals_nested_loops(session, left_keys, right_keys, how):
    left = [(k, i) for i, k in enumerate(left_keys)]
    right = [(k, i) for i, k in enumerate(right_keys)]
    expected = []
    for k, v in left:
        found = [(k, v, w) for j, w in right if k is not None and j == k]
        expected += found or ([(k, v, None)] if how == "left" else [])
    got = match(
        session.createDataFrame(left, "k int, v int"),
        session.createDataFrame(right, "k int, w int").repartition(3),
        ["k"],
        how,
    )
    assert rows(got) == sorted(expected, key=repr)


def test_rejects_other_joins(sides):
    with pytest.raises(ValueError):
        match(*sides, KEYS, how="full")


OPS = "month int, company string, destination string, companyName string, takeOffs int, distance int, seats int, time string"


def test_match_operations_keeps_fan_out_and_unmatched(spark):
    fares = spark.createDataFrame(
        [(1, "AZU", "SBRF", 10.0, 5), (2, "AZU", "SBRF", 20.0, 6), (None, "AZU", "SBRF", 1.0, 1)],
        "month int, company string, destination string, priceAVG double, seats bigint",
    )
    ops = spark.createDataFrame(
        [
            (1, "AZU", "SBRF", "Azul", 3, 100, 50, "1.5"),
            (1, "AZU", "SBRF", "Azul", 4, 200, 60, None),
            (None, "AZU", "SBRF", "Azul", 5, 300, 70, "2"),
        ],
        OPS,
    )
    joined = match_operations(fares, ops, ["month", "company", "destination"])
    assert joined.columns[3:] == [
        "priceAVG",
        "seatsAVG",
        "companyName",
        "takeOffs",
        "distance",
        "seatsAll",
        "time",
    ]
    assert rows(joined) == [
        (1, "AZU", "SBRF", 10.0, 5, "Azul", 3, 100, 50, "1.5"),
        (1, "AZU", "SBRF", 10.0, 5, "Azul", 4, 200, 60, None),
        (2, "AZU", "SBRF", 20.0, 6, None, None, None, None, None),
        (None, "AZU", "SBRF", 1.0, 1, None, None, None, None, None),
    ]


def test_lookup_place_keeps_unmatched_and_doubles_on_duplicates(spark):
    df = spark.createDataFrame([("SBXX", 1), ("SBRF", 2), ("XXXX", 3)], "destination string, v int")
    airports = spark.createDataFrame(
        [("SBXX", "a", "Norte", "MS"), ("SBXX", "b", "Sul", "MT"), ("SBRF", "c", "Recife", "PE")],
        "icao string, airport string, city string, state string",
    )
    assert rows(lookup_place(df, airports)) == [
        ("SBRF", 2, "Recife", "PE"),
        ("SBXX", 1, "Norte", "MS"),
        ("SBXX", 1, "Sul", "MT"),
        ("XXXX", 3, None, None),
    ]
