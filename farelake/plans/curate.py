"""The curated relation: mean fares, the flights behind them, and the place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.config import CURATED_COLUMNS, FARE_KEYS, MEAN_SCHEMA, YEARLY_KEYS
from farelake.operators import (
    lookup_place,
    match_operations,
    reduce_to_keys,
    require_non_null,
    weighted_mean,
)
from farelake.sinks import write_processing
from farelake.sources import read_zone


def curate(
    fares: DataFrame,
    ops: DataFrame,
    airports: DataFrame,
    keys: Sequence[str] = FARE_KEYS,
    guard: bool = True,
) -> DataFrame:
    """Mean fares with their operations and place, for all years in one lazy plan."""
    return curate_means(weighted_mean(fares, FARE_KEYS), ops, airports, keys, guard)


def curate_means(
    means: DataFrame,
    ops: DataFrame,
    airports: DataFrame,
    keys: Sequence[str] = FARE_KEYS,
    guard: bool = True,
    reduce: bool = False,
) -> DataFrame:
    """Mean fares that are at hand already, with their operations and place.

    With the guard only fares that match an operation with known hours are
    kept. A left join followed by that test is an inner join with operations
    whose hours are known; said so here, the test reaches the scan of the
    operations. Without it every fare stays, matched or not. ``reduce`` keeps
    operations that no fare matches from being shuffled; it pays where there are
    many of them, and the means are too large to be broadcast.
    """
    if not guard:
        return lookup_place(match_operations(means, ops, keys), airports).select(*CURATED_COLUMNS)
    flown = require_non_null(ops, ["time"])
    if reduce:
        flown = reduce_to_keys(flown, means, keys)
    matched = match_operations(means, flown, keys, "inner")
    return lookup_place(matched, airports).select(*CURATED_COLUMNS)


def written_means(fares: DataFrame, path: str) -> DataFrame:
    """The mean fares, written by year and read back.

    Their size is then known: below Spark's threshold they are broadcast and
    operations are not shuffled; above it both sides of a join are plain
    shuffles, which adaptive execution can split.
    """
    write_processing(weighted_mean(fares, FARE_KEYS), path, ["year"], compact=True)
    # Key types are the input's own; the writer leaves no trace of a schema without rows.
    types = {f.name: f.dataType.simpleString() for f in fares.schema if f.name in FARE_KEYS}
    fields = [f.split() for f in MEAN_SCHEMA.split(", ")]
    schema = ", ".join(f"{name} {types.get(name, kind)}" for name, kind in fields)
    return read_zone(fares.sparkSession, path, schema=schema)


def curate_yearly(
    fares: DataFrame, ops: DataFrame, airports: DataFrame, year: int, origin: str
) -> DataFrame:
    """The curated relation of one year and origin, matched on what is left of the keys."""
    chosen = (F.col("year") == year) & (F.col("origin") == origin)
    return curate(fares.where(chosen), ops.where(chosen), airports, YEARLY_KEYS)
