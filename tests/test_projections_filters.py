import pytest
from helpers import rows
from pyspark.sql import functions as F

from farelake.functions import parse_locale_decimal
from farelake.operators import (
    blank_values,
    cast_columns,
    drop_sentinel,
    promote_names,
    require_non_null,
    select_as,
    slice_period,
    unmatched,
)


def test_promote_names(spark):
    df = spark.createDataFrame([("2019", "1")], "_c0 string, _c1 string")
    assert promote_names(df, ["year", "month"]).columns == ["year", "month"]


def test_promote_names_counts_columns(spark):
    df = spark.createDataFrame([("2019", "1")], "_c0 string, _c1 string")
    with pytest.raises(ValueError):
        promote_names(df, ["year"])


def test_select_as_renames_and_drops(spark):
    df = spark.createDataFrame([("a", "b", "c")], "X string, Y string, Z string")
    selected = select_as(df, {"Y": "y", "X": "x"})
    assert selected.columns == ["y", "x"]
    assert rows(selected) == [("b", "a")]


def test_cast_columns_in_one_projection(spark):
    df = spark.createDataFrame([("5", "1,5", "k"), ("5.7", "x", "l")], "a string, b string, c string")
    cast = cast_columns(df, {"a": "int", "b": parse_locale_decimal})
    assert [f.dataType.simpleString() for f in cast.schema] == ["int", "double", "string"]
    assert rows(cast) == [(5, 1.5, "k"), (None, None, "l")]
    assert rows(cast_columns(df, {"a": "int"}, lenient=True).select("a")) == [(5,), (5,)]
    assert rows(cast_columns(df, {"a": "double"}).select("a")) == [(5.0,), (5.7,)]


def test_drop_sentinel_drops_null_as_well(spark):
    df = spark.createDataFrame([("Tarifa-N",), ("1,0",), (None,), ("",)], "price string")
    assert rows(drop_sentinel(df, "price", "Tarifa-N")) == [("",), ("1,0",)]


def test_sentinel_and_origin_commute(spark):
    df = spark.createDataFrame(
        [("Tarifa-N", "ORIGEM"), ("TARIFA", "ORIGEM"), ("1,0", "SBMO"), ("2,0", "SBRF")],
        "price string, origin string",
    )
    of_origin = F.col("origin") == "SBMO"
    first = drop_sentinel(df, "price", "Tarifa-N").where(of_origin)
    last = drop_sentinel(df.where(of_origin), "price", "Tarifa-N")
    assert rows(first) == rows(last) == [("1,0", "SBMO")]


def test_slice_period_includes_both_ends(spark):
    df = spark.createDataFrame(
        [(y, o) for y in (2018, 2019, 2021, 2022, 2023, None) for o in ("SBMO", "SBRF", None)],
        "year int, origin string",
    )
    assert rows(slice_period(df, 2019, 2022, "SBMO")) == [
        (2019, "SBMO"),
        (2021, "SBMO"),
        (2022, "SBMO"),
    ]
    assert slice_period(df, 2019, 2022).count() == 9


def test_require_non_null_keeps_nan(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, y string"
    )
    assert [row.y for row in require_non_null(df, ["x", "y"]).orderBy("y").collect()] == ["a", "b"]


def test_unmatched_and_blank(spark):
    df = spark.createDataFrame([("a", "x"), ("", None), ("  ", "y"), (None, "z")], "k string, v string")
    assert rows(unmatched(df, "v")) == [("", None)]
    assert rows(blank_values(df, "k").select("v")) == [("y",), ("z",), (None,)]
