"""Landing files laid out as the jobs expect them, written from the check tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.checks import proxy
from farelake.config import FARE_COLUMNS, OPERATION_COLUMNS, PRICE_SENTINEL

# Spark writes directories, so a month's "file" is one; its name carries the
# partition column the writer needs.
MONTH_FILE = "period={year}{month:02d}.CSV"

# What the first line of a fare file says.
FARE_HEADER = ("ANO", "MES", "EMPRESA", "ORIGEM", "DESTINO", PRICE_SENTINEL, "ASSENTOS")

# Files a task writes at once; one that has rows of more months sorts the rest.
MONTHS_OPEN = 2 * 12 * len(proxy.YEARS)

# Few, so that small tables give several documents too.
JSON_ROWS_PER_FILE = 400


def fare_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fare rows as text, with the month they belong to."""
    raw = proxy.fare_raw(spark, sf_dir).withColumnsRenamed(
        {"year_t": "year", "month_t": "month", "price_t": "price", "seats_t": "seats"}
    )
    return raw.select(
        *[F.col(name).cast("string").alias(name) for name in FARE_COLUMNS],
        F.concat("year", F.lpad("month", 2, "0"), F.lit(".CSV")).alias("period"),
    )


def stray_year(period: Column) -> Column:
    """A year cell that is empty for companies 0, 7, 14..., and the year before for 1, 8, 15...."""
    kind = F.col("company").cast("int") % 7
    before = (F.substring(period, 1, 4).cast("int") - 1).cast("string")
    return F.when(kind == 0, F.lit(None)).when(kind == 1, before).otherwise(F.col("year"))


def fare_lines(rows: DataFrame) -> DataFrame:
    """Each row as the ``line`` that Spark's CSV writer would make of it, and its ``period``.

    A line costs less to shuffle and to write than its cells. Only the origin is
    text of the tables, so only it may need quotes.
    """
    quoted = F.to_csv(F.struct(F.lit("0").alias("first"), "origin"), {"sep": ";"})
    plain = F.col("origin").isNull() | F.col("origin").rlike("^[0-9A-Za-z]+$")
    origin = F.when(plain, F.col("origin")).otherwise(F.substring(quoted, 3, 1 << 30))
    cells = [origin if name == "origin" else F.col(name) for name in FARE_COLUMNS]
    line = F.concat_ws(";", *[F.coalesce(c, F.lit("")) for c in cells])
    return rows.select(line.alias("line"), "period")


@contextmanager
def _months_open(spark: SparkSession) -> Iterator[None]:
    """Let a task keep the files of all months open, so that it need not sort its rows by month first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(MONTHS_OPEN))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_month_files(
    spark: SparkSession, sf_dir: str, path: str, stray: bool = False, seats: Column | None = None
) -> str:
    """One file per month of each year, a header line in every one.

    ``stray`` gives some rows another year cell than their file's. Other
    ``seats`` may be given, and rows for which these are NULL are left out.
    """
    months = spark.range(12 * len(proxy.YEARS))
    year = (F.lit(proxy.YEARS[0]) + F.floor(F.col("id") / 12)).cast("string")
    month = F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")
    headers = months.select(
        *[F.lit(title).alias(name) for name, title in zip(FARE_COLUMNS, FARE_HEADER)],
        F.concat(year, month, F.lit(".CSV")).alias("period"),
    )
    fares = fare_rows(spark, sf_dir)
    if seats is not None:
        fares = fares.withColumn("seats", seats).where(F.col("seats").isNotNull())
    if stray:
        fares = fares.withColumn("year", stray_year(F.col("period")))
    rows = fare_lines(fares.unionAll(headers)).hint("rebalance", "period")
    with _months_open(spark):
        rows.write.partitionBy("period").text(path)
    return path


def odd_line(cells: list[Column]) -> Column:
    """A fare line that lacks its last cell for companies 0, 5, 10..., and has text for seats for 1, 6, 11...."""
    kind = F.coalesce(F.col("company").try_cast("int") % 5, F.lit(2))
    whole = [F.coalesce(c, F.lit("")) for c in cells]
    return (
        F.when(kind == 0, F.concat_ws(";", *whole[:-1]))
        .when(kind == 1, F.concat_ws(";", *whole[:-1], F.concat(whole[-1], F.lit("x"))))
        .otherwise(F.concat_ws(";", *whole))
    )


def write_odd_month_files(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Month files with broken lines."""
    rows = fare_rows(spark, sf_dir)
    lines = rows.select(odd_line([F.col(c) for c in FARE_COLUMNS]).alias("line"), "period")
    header = F.lit(";".join(FARE_HEADER)).alias("line")
    lines = lines.unionAll(rows.select("period").distinct().select(header, "period"))
    lines.hint("rebalance", "period").write.partitionBy("period").text(path)
    return path


def write_odd_operations(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Statistics whose year is text for every fifth company, and empty for the next one."""
    rows = operation_rows(spark, sf_dir)
    kind = F.substring_index("EMPRESA_NOME", "-", -1).cast("int") % 5
    year = F.when(kind == 0, F.concat("ANO", F.lit("?"))).when(kind == 1, "").otherwise(F.col("ANO"))
    rows.withColumn("ANO", year).write.csv(path, sep=";", header=True)
    return path


def rewrite_month(spark: SparkSession, sf_dir: str, path: str, year: int, month: int, seats: Column) -> None:
    """Put another file in the place of one month's, with other seats; all tasks look for its rows."""
    period = f"{year}{month:02d}.CSV"
    rows = fare_rows(spark, sf_dir).where(F.col("period") == period).withColumn("seats", seats)
    rows.drop("period").hint("rebalance").write.mode("overwrite").csv(f"{path}/period={period}", sep=";")


def operation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations under the titles of the statistics file, and one column more."""
    source = proxy.operation_source(spark, sf_dir).withColumns(
        {
            "nationality": F.when(F.col("company") % 2 == 0, "BRASILEIRA").otherwise("ESTRANGEIRA"),
            "paidPassengers": F.col("seats") - 1,
            "noPaidPassengers": F.col("takeOffs") % 3,
        }
    )
    return source.select(
        *[F.col(name).cast("string").alias(title) for title, name in OPERATION_COLUMNS.items()],
        F.lit("REGULAR").alias("GRUPO_DE_VOO"),
    )


def write_operations(spark: SparkSession, sf_dir: str, path: str) -> str:
    operation_rows(spark, sf_dir).write.csv(path, sep=";", header=True)
    return path


def airport_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxy.airport(spark, sf_dir).select(
        F.col("icao").cast("string").alias("icao"),
        F.concat(F.lit("airport-"), F.col("icao").cast("string")).alias("airport"),
        "city",
        "state",
    )


def write_airports(spark: SparkSession, sf_dir: str, path: str) -> str:
    airport_rows(spark, sf_dir).write.csv(path, sep=",", header=True, quoteAll=True)
    return path


def write_customer_places(spark: SparkSession, sf_dir: str, path: str) -> str:
    """A list laid out as the airports are, with an entry per customer."""
    nations = proxy.airport(spark, sf_dir)
    customers = proxy.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("code"), "c_name", "c_nationkey"
    )
    customers.join(nations, customers.c_nationkey == nations.icao).select(
        F.col("code").alias("icao"), F.col("c_name").alias("airport"), "city", "state"
    ).write.csv(path, sep=",", header=True, quoteAll=True)
    return path


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxy.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").cast("decimal(18,2)")
    )


def write_customers(spark: SparkSession, sf_dir: str, path: str) -> str:
    customer_rows(spark, sf_dir).write.csv(path, sep=",", header=True)
    return path


def write_json_documents(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Customers as JSON arrays over many lines, one array per file.

    Keys are unique, so a run of them bounds the size of an array.
    """
    customer = proxy.table(spark, sf_dir, "customer")
    number = F.floor(F.col("c_custkey") / JSON_ROWS_PER_FILE)
    row = F.struct("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    documents = customer.groupBy(number.alias("number")).agg(
        F.to_json(F.collect_list(row), {"pretty": "true"}).alias("value")
    )
    documents.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


def write_json_array(spark: SparkSession, sf_dir: str, path: str) -> str:
    """All orders as one array in one file, with texts that hold quotes, brackets and escapes.

    One file has one writer. It takes four columns and streams: a line of the
    file, and what the task holds, is a batch of elements.
    """
    priority = F.col("o_orderpriority")
    row = F.struct(
        "o_orderkey",
        F.concat(F.lit('{"'), priority, F.lit('\\"}, [{')).alias("note"),
        F.array(priority, F.lit("}")).alias("marks"),
        F.struct("o_custkey", F.struct(F.col("o_totalprice").alias("price")).alias("total")).alias("of"),
    )
    elements = proxy.table(spark, sf_dir, "orders").select(F.to_json(row).alias("value"))

    def array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            if batch.num_rows:
                yield lines(before + ",".join(batch.column(0).to_pylist()))
                before = ","
        yield lines("]" if before == "," else "[]")

    def lines(text: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([text])], ["value"])

    elements.coalesce(1).mapInArrow(array, "value string").write.text(path)
    return path
