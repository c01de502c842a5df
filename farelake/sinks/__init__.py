"""Writers for the processing and curated zones and for the warehouse."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_processing(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    replace: str = "all",
    compact: bool = False,
) -> None:
    """Write Parquet, replacing what is at ``path``.

    ``replace="partitions"`` replaces only the partitions ``df`` has rows for;
    see ``replace_years`` for one that has become empty. ``compact`` shuffles
    once before the write so that a selective filter over many input splits does
    not leave one tiny file per split. The shuffle is a rebalance: adaptive
    execution joins small partitions and splits one that is too large, such as
    a year holding most rows.
    """
    if replace not in ("all", "partitions"):
        raise ValueError(f"replace must be 'all' or 'partitions', not {replace!r}")
    if replace == "partitions" and not partition_by:
        raise ValueError("replace='partitions' needs partition columns")
    if compact:
        df = df.hint("rebalance", *partition_by)
    mode = "dynamic" if replace == "partitions" else "static"
    (
        df.write.mode("overwrite")
        .partitionBy(*partition_by)
        .option("partitionOverwriteMode", mode)
        .parquet(path)
    )


def write_sorted(
    df: DataFrame, path: str, order: Sequence[str], partition_by: Sequence[str] = (), group_mb: int = 16
) -> None:
    """Write Parquet in the order of some columns, so that a read by the first of them skips row groups.

    Rows are dealt to files by ranges and sorted inside them. The ranges are cut
    by all of ``order``, so a first column of few values, such as the month,
    does not mean few or uneven files; end it with columns that tell rows apart.
    A row group's statistics then span few values, and a smaller ``group_mb``
    makes reads more choosy.
    """
    by = [c for c in partition_by if c not in order]
    (
        df.repartitionByRange(*by, *order)
        .sortWithinPartitions(*by, *order)
        .write.mode("overwrite")
        .option("parquet.block.size", group_mb << 20)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_years(df: DataFrame, path: str, years: Iterable[int], compact: bool = True) -> None:
    """Make the partitions of ``years`` hold exactly the rows of ``df``.

    Other years stay as they are, so a row of another year is an error: it
    would replace all that year has. A year without rows is emptied; which ones
    have rows is noted while they are written, not by another pass.
    """
    years = sorted(set(years))
    found = F.coalesce(F.col("year").cast("string"), F.lit("none"))
    stray = F.concat(F.lit(f"not one of the years {years}: "), found)
    owned = F.when(F.col("year").isin(years), F.col("year")).otherwise(F.raise_error(stray))
    checked = df.withColumn("year", owned)
    if compact:
        checked = checked.hint("rebalance", "year")
    # Noted after the shuffle: with no rows at all, what precedes it is cut off the plan.
    seen = Observation()
    noted = checked.observe(seen, F.collect_set("year").alias("years"))
    write_processing(noted, path, ["year"], replace="partitions")
    for year in set(years) - set(seen.get["years"]):
        write_processing(df.where(F.lit(False)).drop("year"), f"{path}/year={year}")


def write_curated_csv(df: DataFrame, path: str) -> None:
    """Write comma-separated files with a header; ``path`` becomes a directory.

    NULL is written as an empty cell, and types are not kept.
    """
    df.write.mode("overwrite").csv(path, sep=",", header=True)


def publish_table(
    df: DataFrame,
    table: str,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Replace a warehouse table with ``df``.

    With a connector format the table name goes to it as ``dbtable`` beside the
    options; without one the table is kept by the session catalogue, in the
    given partitions.
    """
    writer = df.write.mode("overwrite").options(**(options or {}))
    if fmt is None:
        writer.format("parquet").partitionBy(*partition_by).saveAsTable(table)
    else:
        writer.format(fmt).option("dbtable", table).save()


def publish_years(df: DataFrame, table: str, years: Iterable[int]) -> None:
    """Make the partitions of ``years`` in a catalogue table hold exactly the rows of ``df``.

    Files of other years are not touched. The table is made if it is not there;
    one that is must be partitioned by year.
    """
    spark = df.sparkSession
    owned = df.where(F.col("year").isin(*years))
    if not spark.catalog.tableExists(table):
        publish_table(owned, table, partition_by=["year"])
        return
    columns = [name for name in spark.table(table).columns if name != "year"]
    for year in sorted(set(years)):
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (year = {int(year)}) SELECT * FROM {{rows}}",
            rows=owned.where(F.col("year") == year).select(*columns),
        )
