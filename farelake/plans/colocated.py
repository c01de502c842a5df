"""Mean fares and operations kept side by side, and matched without moving either.

Both lie in buckets by the fare keys. A bucket is read by one task, so no key
may fill it: keys with a large share of all operations are kept apart, where
files are split like any others, and meet their few mean fares in a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.config import FARE_KEYS
from farelake.operators import match_operations
from farelake.sinks import replace_years
from farelake.sinks.buckets import BucketedTable
from farelake.sources import read_zone

#: A key is crowded that has more than this part of a year's operations, and this many of them.
#: So a year has at most that number of crowded keys, and the broadcast is bounded.
PART, LEAST = 1000, 10_000


@dataclass(frozen=True)
class Colocated:
    """Where the two relations are: catalogue tables below ``path``, in ``buckets`` buckets each."""

    database: str
    path: str
    buckets: int = 200
    part: int = PART
    least: int = LEAST

    def _table(self, name: str) -> BucketedTable:
        return BucketedTable(f"{self.database}.{name}", f"{self.path}/{name}", FARE_KEYS, self.buckets)

    @property
    def operations(self) -> BucketedTable:
        return self._table("operations")

    @property
    def means(self) -> BucketedTable:
        return self._table("means")

    @property
    def crowded(self) -> str:
        return f"{self.path}/crowded"

    def _crowded_keys(self, ops: DataFrame) -> DataFrame:
        """Keys with a large share of their year: at most ``part`` of each year."""
        sizes = ops.groupBy(*FARE_KEYS).agg(F.count("*").alias("n"))
        years = ops.groupBy("year").agg(F.count("*").alias("all"))
        large = (F.col("n") >= self.least) & (F.col("n") * self.part > F.col("all"))
        known = F.col(FARE_KEYS[0]).isNotNull()
        for key in FARE_KEYS[1:]:
            known &= F.col(key).isNotNull()
        return sizes.where(known & (F.col("n") >= self.least)).join(years, "year").where(large).select(*FARE_KEYS)

    def keep_operations(self, ops: DataFrame, years: Iterable[int]) -> None:
        """Deal the operations of some years to buckets, and those of crowded keys to plain files."""
        years = list(years)
        owned = ops.where(F.col("year").isin(*years))
        replace_years(self._crowded_keys(owned), f"{self.crowded}_keys", years)
        keys = self._kept_keys(ops.sparkSession, ops, years)
        self.operations.write_years(owned.join(keys, list(FARE_KEYS), "left_anti"), years)
        replace_years(owned.join(keys, list(FARE_KEYS), "left_semi"), self.crowded, years)

    def _kept_keys(self, spark: SparkSession, like: DataFrame, years: list[int]) -> DataFrame:
        """The crowded keys of some years, at most ``part`` of each, to be broadcast."""
        schema = like.select(*FARE_KEYS).schema
        keys = read_zone(spark, f"{self.crowded}_keys", schema=schema)
        return F.broadcast(keys.where(F.col("year").isin(*years)))

    def keep_means(self, means: DataFrame, years: Iterable[int]) -> None:
        self.means.write_years(means, years)

    def match(self, spark: SparkSession, years: Iterable[int]) -> DataFrame:
        """Mean fares beside the operations with the same keys, all of them, as ``match_operations`` gives them.

        Buckets are joined where they lie: neither relation is shuffled. Years
        are joined apart, so a task sorts a bucket of one year and not of all.
        """
        years = list(years)
        keys = [key if key != "year" else "ofYear" for key in FARE_KEYS]
        means, ops = self.means.read(spark, years), self.operations.read(spark, years)
        schema = ops.drop("ofYear").schema
        crowded = read_zone(spark, self.crowded, schema=schema).where(F.col("year").isin(*years))
        there = self._kept_keys(spark, crowded, years)
        few = means.drop("ofYear").join(there, list(FARE_KEYS), "left_semi")
        joined = [
            match_operations(
                self.means.read(spark, part).drop("year"),
                self.operations.read(spark, part).drop("year"),
                keys,
            ).withColumnRenamed("ofYear", "year")
            for part in [[year] for year in dict.fromkeys(years)] or [[]]
        ]
        flown = match_operations(F.broadcast(few), crowded, FARE_KEYS, "inner")
        # Means of crowded keys have met nothing in the buckets. They are marked and
        # dropped here, once: an anti join would be pushed into each of the years.
        marked = there.withColumn("isCrowded", F.lit(True))
        plain = reduce(DataFrame.unionAll, joined).join(marked, list(FARE_KEYS), "left")
        rest = plain.where(F.col("isCrowded").isNull())
        return rest.select(*flown.columns).unionAll(flown)
