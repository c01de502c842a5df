"""Tables kept in buckets by their join keys, so that joins of two of them exchange nothing."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class BucketedTable:
    """A catalogue table by ``year``, whose files are in ``n`` buckets by ``keys``.

    A column that a table is partitioned by cannot be one of its bucket keys,
    so the year stands in the files too, as ``ofYear``: joins use that one, and
    filters on ``year`` skip folders. Two tables with the same keys, key types and
    number of buckets are joined bucket by bucket.
    """

    name: str
    path: str
    keys: tuple[str, ...]
    n: int

    @property
    def by(self) -> tuple[str, ...]:
        return tuple("ofYear" if key == "year" else key for key in self.keys)

    def _create(self, spark: SparkSession, schema: StructType) -> None:
        """Make the table, or open what an earlier session has left at its path."""
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != "year"]
        columns = ", ".join([*fields, "`ofYear` int", "`year` int"])
        by = ", ".join(f"`{key}`" for key in self.by)
        spark.sql(
            f"CREATE TABLE {self.name} ({columns}) USING parquet PARTITIONED BY (`year`) "
            f"CLUSTERED BY ({by}) INTO {self.n} BUCKETS LOCATION '{self.path}'"
        )
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
        spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def write_years(self, df: DataFrame, years: Iterable[int]) -> None:
        """Make the years hold exactly the rows of ``df``; other years are not touched.

        Rows are dealt to buckets by one shuffle, after which a bucket of a year is one file.
        """
        spark, years = df.sparkSession, sorted(set(years))
        if not spark.catalog.tableExists(self.name):
            self._create(spark, df.schema)
        columns = [c for c in spark.table(self.name).columns if c not in ("year", "ofYear")]
        owned = df.where(F.col("year").isin(years)).withColumn("ofYear", F.col("year"))
        # The table has the types; files by other ones would fall into other buckets.
        types = {f.name: f.dataType for f in spark.table(self.name).schema}
        owned = owned.select(
            *[F.col(c).cast(types[c]).alias(c) for c in [*columns, "ofYear"]], F.col("year")
        )
        for year in years:
            rows = owned.where(F.col("year") == year).drop("year")
            spark.sql(
                f"INSERT OVERWRITE TABLE {self.name} PARTITION (year = {int(year)}) SELECT * FROM {{rows}}",
                rows=rows.repartition(self.n, *self.by),
            )

    def read(self, spark: SparkSession, years: Sequence[int] | None = None) -> DataFrame:
        table = spark.table(self.name)
        return table if years is None else table.where(F.col("year").isin(*years))
