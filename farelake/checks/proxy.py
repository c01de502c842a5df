"""The domain relations, projected from the check tables.

Every odd case is planted: line 7 carries the header cell, line 6 no price,
line 5 a price with grouped thousands, a quantity of one gives zero seats,
operations of line 1 have no hours, and destinations 25 to 29 are no nation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.config import FARE_KEYS, PRICE_SENTINEL
from farelake.functions import normalize_decimal_text, parse_locale_decimal
from farelake.operators import cast_columns, drop_sentinel, slice_period, weighted_mean

ORIGIN = "N"
YEARS = tuple(range(1995, 2002))
OPERATION_YEARS = (1995, 1996, 1997, 1998)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comma_text(c: Column, precision: int) -> Column:
    return F.replace(c.cast(f"decimal({precision},2)").cast("string"), F.lit("."), F.lit(","))


def fare_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").cast("string").alias("year_t"),
        F.month("l_shipdate").cast("string").alias("month_t"),
        F.col("l_suppkey").alias("company"),
        F.col("l_returnflag").alias("origin"),
        (F.col("l_partkey") % 30).cast("int").alias("destination"),
        F.when(line == 7, PRICE_SENTINEL)
        .when(line == 5, "1.234,56")
        .when(line != 6, comma_text(F.col("l_extendedprice"), 18))
        .alias("price_t"),
        (F.col("l_quantity").cast("int") - 1).cast("string").alias("seats_t"),
    )


def fare(spark: SparkSession, sf_dir: str, origin: str | None = ORIGIN) -> DataFrame:
    raw = fare_raw(spark, sf_dir)
    if origin is not None:
        raw = raw.where(F.col("origin") == origin)
    named = drop_sentinel(raw, "price_t", PRICE_SENTINEL).withColumnsRenamed(
        {"year_t": "year", "month_t": "month", "price_t": "price", "seats_t": "seats"}
    )
    return cast_columns(
        named, {"year": "int", "month": "int", "price": parse_locale_decimal, "seats": "int"}
    )


def priced(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Fares with prices as doubles of ten digits before the point, or of seven places after it."""
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    price = {
        "large": (cents * 100_000 + F.col("l_linenumber") * 37).cast("double") / 100,
        "places": (cents * 7 + F.col("l_linenumber")).cast("double") / 10_000_000,
    }[kind]
    return table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.col("l_suppkey").alias("company"),
        F.col("l_returnflag").alias("origin"),
        (F.col("l_partkey") % 30).cast("int").alias("destination"),
        price.alias("price"),
        F.col("l_quantity").cast("int").alias("seats"),
    )


def operation_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations of all years and origins, hours still with a decimal comma."""
    line = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("company"),
        F.concat(F.lit("carrier-"), F.col("l_suppkey").cast("string")).alias("companyName"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.col("l_returnflag").alias("origin"),
        (F.col("l_partkey") % 30).cast("int").alias("destination"),
        line.alias("takeOffs"),
        (F.col("l_quantity") * 10).cast("int").alias("distance"),
        F.col("l_quantity").cast("int").alias("seats"),
        F.when(line != 1, comma_text(F.col("l_tax"), 10)).alias("time"),
    )


def ops(spark: SparkSession, sf_dir: str, origin: str | None = ORIGIN) -> DataFrame:
    source = operation_source(spark, sf_dir)
    sliced = slice_period(source, min(OPERATION_YEARS), max(OPERATION_YEARS), origin)
    return sliced.withColumn("time", normalize_decimal_text("time"))


def airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("icao"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
    )


def avg_fare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_mean(fare(spark, sf_dir), FARE_KEYS)


def repeated_airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list with every third code once more, under another city."""
    places = airport(spark, sf_dir)
    again = places.where(F.col("icao") % 3 == 0)
    return places.unionAll(again.withColumn("city", F.concat(F.lit("OLD "), "city")))
