"""Jobs that carry the files of the landing zone through to the warehouse."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.config import (
    CURATED_SCHEMA,
    FARE_COLUMNS,
    FARE_KEYS,
    FARE_SCHEMA,
    MEAN_SCHEMA,
    OPERATION_COLUMNS,
    OPERATION_INTEGERS,
    OPERATION_SCHEMA,
    LakeConfig,
)
from farelake.functions import normalize_decimal_text, parse_locale_decimal
from farelake.operators import (
    cast_columns,
    drop_sentinel,
    select_as,
    slice_period,
    weighted_mean,
)
from farelake.plans.curate import curate_means
from farelake.sinks import (
    publish_table,
    publish_years,
    replace_years,
    write_curated_csv,
    write_processing,
)
from farelake.sources import (
    file_part,
    month_paths,
    read_headered,
    read_headerless,
    read_json_arrays,
    read_json_documents,
    read_zone,
)

FARES = "fares"
OPERATIONS = "statistics"
AIRPORTS = "icao"
DISTANCES = "dist"
MEANS = "means"
CURATED = "data"

#: Years that are published at the same time.
PUBLISHERS = 4


def _unread(cells: dict[str, tuple[Column, Column]]) -> Column:
    """The names of the cells that hold text and gave no number."""
    named = [
        F.when((F.trim(text) != "") & number.isNull(), name) for name, (text, number) in cells.items()
    ]
    return F.nullif(F.concat_ws(",", *named), F.lit("")).alias("unread")


def clean_fares(raw: DataFrame, cfg: LakeConfig, year: int | Column) -> DataFrame:
    """Raw fare rows, of the origin, without header lines, typed; ``year`` is that of a row's file.

    A fare belongs to the year its file is of. What its own cell says is kept
    beside it, and a cell that cannot be read is named, so both can be counted
    (``odd_cells``) and neither loses a row.
    """
    if cfg.origin is not None:
        raw = raw.where(F.col("origin") == cfg.origin)
    fares = drop_sentinel(raw, "price", cfg.price_sentinel)
    price = partial(parse_locale_decimal, grouping=cfg.price_grouping)
    types = {"year": "int", "month": "int", "price": price, "seats": "int"}
    typed = cast_columns(
        fares.withColumns({f"_{name}": F.col(name) for name in types}),
        types,
        lenient=cfg.lenient_ints,
    )
    cells = {name: (F.col(f"_{name}"), F.col(name)) for name in types}
    return typed.select(
        (year if isinstance(year, Column) else F.lit(year)).alias("year"),
        *[name for name in FARE_COLUMNS if name != "year"],
        F.col("year").alias("yearCell"),
        _unread(cells),
        *[name for name in raw.columns if name == "period"],
    )


def read_fares(
    spark: SparkSession, cfg: LakeConfig, paths: list[str], period: bool = False
) -> DataFrame:
    """The fares of month files, in one scan; the year is the one in the path of a row's file.

    With ``period`` there is a column more, year * 100 + month of the file.
    """
    raw = read_headerless(spark, paths, FARE_COLUMNS, sep=";", **cfg.text_options)
    year = file_part(cfg.month_file, "year")
    of_file = {"fileYear": year}
    if period:
        of_file["period"] = year * 100 + file_part(cfg.month_file, "month")
    return clean_fares(raw.withColumns(of_file), cfg, F.col("fileYear"))


def clean_operations(raw: DataFrame, cfg: LakeConfig) -> DataFrame:
    """Raw statistics under short names, typed, of the years and the origin."""
    texts = select_as(raw, OPERATION_COLUMNS)
    types = {name: "int" for name in OPERATION_INTEGERS} | {"time": normalize_decimal_text}
    ops = cast_columns(
        texts.withColumns({f"_{name}": F.col(name) for name in OPERATION_INTEGERS}),
        types,
        lenient=cfg.lenient_ints,
    )
    cells = {name: (F.col(f"_{name}"), F.col(name)) for name in OPERATION_INTEGERS}
    ops = ops.select(*OPERATION_COLUMNS.values(), _unread(cells))
    ops = slice_period(ops, min(cfg.years), max(cfg.years), cfg.origin)
    return ops.where(F.col("year").isin(*cfg.years))


def odd_cells(fares: DataFrame, ops: DataFrame) -> DataFrame:
    """Rows per relation and year, those with a cell not read, and fares whose year cell differs."""
    strange = ~F.col("yearCell").eqNullSafe(F.col("year"))
    counted = [F.count("*").alias("rows"), F.count("unread").alias("unread")]
    of_fares = fares.groupBy("year").agg(*counted, F.count_if(strange).alias("otherYear"))
    of_ops = ops.groupBy("year").agg(*counted, F.lit(None).cast("bigint").alias("otherYear"))
    return of_fares.select(F.lit(FARES).alias("relation"), "*").unionAll(
        of_ops.select(F.lit(OPERATIONS).alias("relation"), "*")
    )


def _write_years(df: DataFrame, path: str, cfg: LakeConfig, compact: bool = True) -> None:
    if cfg.replace == "years":
        replace_years(df, path, cfg.years, compact)
    else:
        write_processing(df, path, ["year"], compact=compact)


def process_fares(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """The month files of the run's years, cleaned and kept by the year of the file."""
    paths = month_paths(cfg.landing, cfg.years, cfg.months, cfg.month_file)
    target = cfg.processing_path(FARES)
    # Files are worth a shuffle only where few rows are left of each split.
    fares = read_fares(spark, cfg, paths)
    _write_years(fares, target, cfg, compact=cfg.origin is not None)
    return read_zone(spark, target, schema=FARE_SCHEMA)


def clear_fares(spark: SparkSession, cfg: LakeConfig) -> None:
    """Leave no fares of any year."""
    none = spark.createDataFrame([], FARE_SCHEMA)
    write_processing(none, cfg.processing_path(FARES), ["year"])


def process_operations(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """The flight statistics of the run's years and origin, kept by year."""
    source = cfg.landing_path(cfg.operations_dir)
    raw = read_headered(spark, source, sep=";", **cfg.text_options)
    target = cfg.processing_path(OPERATIONS)
    _write_years(clean_operations(raw, cfg), target, cfg, compact=cfg.origin is not None)
    return read_zone(spark, target, schema=OPERATION_SCHEMA)


def process_airports(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """The airport list as it is, all text."""
    source = cfg.landing_path(cfg.airports_dir)
    target = cfg.processing_path(AIRPORTS)
    write_processing(read_headered(spark, source, sep=",", **cfg.text_options), target)
    return read_zone(spark, target)


def process_distances(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """The distance documents, under the schema found in them if none is given; no part of ``run``."""
    target = cfg.processing_path(DISTANCES)
    source = cfg.landing_path(cfg.distances_path)
    read = read_json_arrays if cfg.split_documents else read_json_documents
    write_processing(read(spark, source, schema=cfg.distances_schema), target)
    return read_zone(spark, target, schema=cfg.distances_schema)


def curate_and_publish(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Compute the curated relation once, then write files and tables from it.

    The mean fares are written first. Read back, their size is known: if it is
    under Spark's threshold they are broadcast and the operations are not
    shuffled at all, and otherwise both sides of the join are plain shuffles,
    which adaptive execution can split where one key holds most operations.

    The curated rows are kept as Parquet too, so that neither the curated files
    nor the tables run the joins again. A lost executor costs a part of a scan.
    Years are written side by side, as many as the driver has threads for.
    """
    fares = read_zone(spark, cfg.processing_path(FARES), schema=FARE_SCHEMA)
    ops = read_zone(spark, cfg.processing_path(OPERATIONS), schema=OPERATION_SCHEMA)
    airports = read_zone(spark, cfg.processing_path(AIRPORTS))
    in_run = F.col("year").isin(*cfg.years)

    means = cfg.processing_path(MEANS)
    _write_years(weighted_mean(fares.where(in_run), FARE_KEYS), means, cfg)
    computed = curate_means(
        read_zone(spark, means, schema=MEAN_SCHEMA).where(in_run), ops.where(in_run), airports
    )
    target = cfg.processing_path(CURATED)
    _write_years(computed, target, cfg)
    curated = read_zone(spark, target, schema=CURATED_SCHEMA)

    def publish(year: int) -> None:
        rows = curated.where(F.col("year") == year)
        write_curated_csv(rows, cfg.curated_path(f"{year}.csv"))
        if "{year}" in cfg.table:
            table = cfg.table.format(year=year)
            publish_table(rows, table, cfg.warehouse_format, cfg.warehouse_options)

    with ThreadPoolExecutor(PUBLISHERS) as threads:
        list(threads.map(publish, cfg.years))
    if "{year}" not in cfg.table:
        if cfg.replace == "years":
            publish_years(curated, cfg.table, cfg.years)
        else:
            publish_table(
                curated, cfg.table, cfg.warehouse_format, cfg.warehouse_options, ["year"]
            )
    return curated


def run(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Fares, airports and statistics first, then the curated relation."""
    process_fares(spark, cfg)
    process_airports(spark, cfg)
    process_operations(spark, cfg)
    return curate_and_publish(spark, cfg)
