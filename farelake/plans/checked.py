"""Cleaning that accounts for every line it has read.

A line ends up in its relation, among the rejects, or in a count of those that
are not asked for: header lines, other origins, other years. The counts are
taken while the relation is written, by no job of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farelake.config import (
    FARE_COLUMNS,
    FARE_SCHEMA,
    OPERATION_COLUMNS,
    OPERATION_INTEGERS,
    OPERATION_SCHEMA,
    LakeConfig,
)
from farelake.functions import parse_int, parse_locale_decimal
from farelake.operators import row_counts
from farelake.plans import jobs
from farelake.sinks import write_processing
from farelake.sources import file_part, month_paths, read_headered, read_headerless, read_zone

REJECTS, COUNTS = "rejects", "counts"

#: ``kept``: the row is in its relation all the same, with NULL for the cells named.
REJECT_SCHEMA = (
    "relation string, file string, block bigint, line string, reasons string, kept boolean"
)
COUNT_SCHEMA = "relation string, rowsIn bigint, rowsOut bigint, rejected bigint, filtered bigint"

_BROKEN = "_corrupt_record"
_PLACE = ("_file", "_block")


def _with_place(raw: DataFrame) -> DataFrame:
    return raw.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def _fare_lines(spark: SparkSession, cfg: LakeConfig) -> tuple[DataFrame, Column, Column]:
    """Lines of the month files, which of them cannot be placed, and which are asked for."""
    paths = month_paths(cfg.landing, cfg.years, cfg.months, cfg.month_file)
    raw = read_headerless(
        spark, paths, [*FARE_COLUMNS, _BROKEN], sep=";",
        **{**cfg.text_options, "columnNameOfCorruptRecord": _BROKEN},
    )
    raw = _with_place(raw.withColumn("fileYear", file_part(cfg.month_file, "year")))
    asked = F.col("price") != cfg.price_sentinel
    if cfg.origin is not None:
        asked &= F.col("origin") == cfg.origin
    return raw, F.col(_BROKEN).isNotNull(), F.coalesce(asked, F.lit(False))


def _operation_lines(spark: SparkSession, cfg: LakeConfig) -> tuple[DataFrame, Column, Column]:
    """Lines of the statistics, which of them cannot be placed, and which are asked for.

    A line whose year cannot be read belongs to no year.
    """
    source = cfg.landing_path(cfg.operations_dir)
    titles = read_headered(spark, source, sep=";", **cfg.text_options).columns
    schema = ", ".join(f"`{t}` string" for t in [*titles, _BROKEN])
    options = {**cfg.text_options, "columnNameOfCorruptRecord": _BROKEN}
    raw = _with_place(read_headered(spark, source, sep=";", schema=schema, **options))
    named = {short: F.col(f"`{title}`") for title, short in OPERATION_COLUMNS.items()}
    year = parse_int(named["year"], lenient=cfg.lenient_ints)
    no_year = (F.trim(F.coalesce(named["year"], F.lit(""))) == "") | year.isNull()
    asked = year.isin(*cfg.years)
    if cfg.origin is not None:
        asked &= named["origin"] == cfg.origin
    return raw, F.col(_BROKEN).isNotNull() | no_year, F.coalesce(asked, F.lit(False))


def _write(
    lines: DataFrame, lost: Column, asked: Column, clean, relation: str, cfg: LakeConfig
) -> tuple[str, int, int, int, int]:
    """Write a relation from its lines; how many there were, and what became of them."""
    seen = Observation()
    noted = lines.observe(
        seen,
        F.count("*").alias("all"),
        F.count_if(lost).alias("lost"),
        F.count_if(~lost & asked).alias("kept"),
    )
    target = cfg.processing_path(relation)
    write_processing(clean(noted.where(~lost & asked)), target, ["year"], compact=cfg.origin is not None)
    n = seen.get
    return relation, n["all"], n["kept"], n["lost"], n["all"] - n["lost"] - n["kept"]


def _rejects(
    lines: DataFrame, lost: Column, asked: Column, unread: dict[str, Column], cells: list[str], relation: str
) -> DataFrame:
    """Lines that are in no relation, and those that are with cells that could not be read.

    ``unread`` has a condition for each reason. Lines are filtered by the
    conditions; the reasons are put into words, once, for those that are left.
    """
    text = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in cells]), {"sep": ";"})
    unread = {"cells": F.col(_BROKEN).isNotNull(), **unread}
    reasons = F.concat_ws(",", *[F.when(is_so, name) for name, is_so in unread.items()])
    return (
        lines.where(lost | asked)
        .where(reduce(Column.__or__, unread.values()))
        .select(
            F.lit(relation).alias("relation"),
            F.col("_file").alias("file"),
            F.col("_block").alias("block"),
            F.coalesce(_BROKEN, text).alias("line"),
            reasons.alias("reasons"),
            (~lost).alias("kept"),
        )
    )


def _unread(cells: dict[str, tuple[Column, Column]]) -> dict[str, Column]:
    """Per cell whether it holds text that gave no number; not NULL."""
    return {
        name: number.isNull() & (F.trim(F.coalesce(text, F.lit(""))) != "")
        for name, (text, number) in cells.items()
    }


def process(spark: SparkSession, cfg: LakeConfig) -> tuple[DataFrame, DataFrame]:
    """Write fares, operations and what was rejected of them; the counts and the rejects.

    For each relation, lines read = rows written + lines rejected + lines not
    asked for. Rejected are lines with too many or too few cells, and operations
    whose year is no number. Lines with another unreadable cell stay in their
    relation, with NULL there, and are listed among the rejects as kept. The list
    takes another pass over the files, and has a line's file, the start of its
    block, and its text.
    """
    fares, lost_fares, asked_fares = _fare_lines(spark, cfg)
    ops, lost_ops, asked_ops = _operation_lines(spark, cfg)
    counts = [
        _write(
            fares, lost_fares, asked_fares,
            lambda df: jobs.clean_fares(df.drop(_BROKEN, *_PLACE), cfg, F.col("fileYear")),
            jobs.FARES, cfg,
        ),
        _write(
            ops, lost_ops, asked_ops,
            lambda df: jobs.clean_operations(df.drop(_BROKEN, *_PLACE), cfg),
            jobs.OPERATIONS, cfg,
        ),
    ]
    fare_cells = {
        "year": (F.col("year"), parse_int("year", cfg.lenient_ints)),
        "month": (F.col("month"), parse_int("month", cfg.lenient_ints)),
        "price": (F.col("price"), parse_locale_decimal("price", grouping=cfg.price_grouping)),
        "seats": (F.col("seats"), parse_int("seats", cfg.lenient_ints)),
    }
    titles = {short: title for title, short in OPERATION_COLUMNS.items()}
    op_cells = {
        name: (F.col(f"`{titles[name]}`"), parse_int(F.col(f"`{titles[name]}`"), cfg.lenient_ints))
        for name in OPERATION_INTEGERS
    }
    op_unread = _unread(op_cells)
    # An empty year is a reason too.
    op_unread["year"] = op_cells["year"][1].isNull()
    raw_titles = [c for c in ops.columns if c not in (_BROKEN, *_PLACE)]
    rejects = _rejects(
        fares, lost_fares, asked_fares, _unread(fare_cells), list(FARE_COLUMNS), jobs.FARES
    ).unionAll(
        _rejects(ops, lost_ops, asked_ops, op_unread, raw_titles, jobs.OPERATIONS)
    )
    write_processing(rejects, cfg.processing_path(REJECTS), ["relation"], compact=True)
    counted = spark.createDataFrame(counts, COUNT_SCHEMA)
    write_processing(counted.coalesce(1), cfg.processing_path(COUNTS))
    return (
        read_zone(spark, cfg.processing_path(COUNTS), schema=COUNT_SCHEMA),
        read_zone(spark, cfg.processing_path(REJECTS), schema=REJECT_SCHEMA),
    )


def zone_counts(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Rows per relation of the processing zone, from the files' footers: no column is read."""
    schemas = {jobs.FARES: FARE_SCHEMA, jobs.OPERATIONS: OPERATION_SCHEMA, REJECTS: REJECT_SCHEMA}
    return row_counts(
        {name: read_zone(spark, cfg.processing_path(name), schema=s) for name, s in schemas.items()}
    )
