"""Matching fares with operations, and the place lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.config import FARE_KEYS


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Left or inner equi-join that keeps the right side's fan-out.

    It is left to Spark: a side under its threshold is broadcast, and adaptive
    execution splits a crowded key where both sides are plain shuffles. It
    never splits the right side of a left join, nor a join above an aggregate,
    so aggregate the left side into a written table first, as the jobs do.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    return left.join(right, list(keys), how)


def match_operations(
    fares: DataFrame,
    ops: DataFrame,
    keys: Sequence[str] = FARE_KEYS,
    how: str = "left",
) -> DataFrame:
    """Mean fares beside the operations with the same keys.

    Operations are not aggregated: a fare is repeated for each matching row.
    Both sides count seats, hence ``seatsAVG`` and ``seatsAll``.
    """
    flown = ops.select(
        *keys, "companyName", "takeOffs", "distance", F.col("seats").alias("seatsAll"), "time"
    )
    paid = fares.withColumnRenamed("seats", "seatsAVG")
    return match(paid, flown, keys, how).select(
        *paid.columns, "companyName", "takeOffs", "distance", "seatsAll", "time"
    )


def lookup_place(df: DataFrame, airports: DataFrame, key: str = "destination") -> DataFrame:
    """Add city and state of the airport ``key`` names, NULL if it is not listed.

    A code listed twice repeats the row. There is no broadcast hint: Spark
    broadcasts the airports if their measured size is under its threshold, and
    beyond that joins by shuffle, where adaptive execution can split a crowded
    destination because it is on the left.
    """
    places = airports.select(F.col("icao").alias(key), "city", "state")
    return df.join(places, key, "left")
