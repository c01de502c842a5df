"""Readers for the landing, processing and curated zones."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from string import Formatter
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from farelake.config import MONTH_FILE
from farelake.sources.documents import json_elements, read_json_arrays

__all__ = [
    "file_part",
    "json_elements",
    "month_paths",
    "read_headered",
    "read_headerless",
    "read_json_arrays",
    "read_json_documents",
    "read_zone",
    "register",
]


def month_paths(
    base: str,
    years: Iterable[int],
    months: Iterable[int] = range(1, 13),
    pattern: str = MONTH_FILE,
) -> list[str]:
    """One path per month of each year; reading fails if any of them is missing."""
    months = list(months)
    return [
        f"{base.rstrip('/')}/{pattern.format(year=year, month=month)}"
        for year in years
        for month in months
    ]


def file_part(pattern: str, name: str) -> Column:
    """The number that stands for ``{name}`` of a pattern in the path of a row's file.

    A "file" may be a directory, whose part files then count as it. The column
    holds for rows that come straight from a reader of files.
    """
    regex, found = "(?:^|/)", False
    for literal, part, *_ in Formatter().parse(pattern):
        regex += "".join(f"(?:{re.escape(c)}|{quote(c)})" for c in literal)  # paths may be encoded
        if part is not None:
            digits = r"\d{2}" if part == "month" else r"\d+"
            regex += f"({digits})" if part == name and not found else digits
            found |= part == name
    if not found:
        raise ValueError(f"{pattern!r} has no {name}")
    path = F.col("_metadata.file_path")
    return F.regexp_extract(path, f"{regex}(?:/[^/]*)?$", 1).try_cast("int")


def read_headerless(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    sep: str = ";",
    **options: str,
) -> DataFrame:
    """Delimited files read by position, every column as text.

    A header line inside a file comes through as a row; see ``drop_sentinel``.
    The given schema saves the pass over the files that inference would make.
    """
    schema = StructType([StructField(name, StringType()) for name in columns])
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).options(**options).csv(paths, sep=sep)


def read_headered(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Delimited files with a header line each; all text unless a schema is given."""
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    path = path if isinstance(path, str) else list(path)
    return reader.csv(path, sep=sep, header=True)


def read_json_documents(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """JSON files that each hold one document spread over many lines.

    One task reads a file. ``read_json_arrays`` reads large arrays by many. A
    schema saves the inference pass.
    """
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_zone(
    spark: SparkSession,
    path: str,
    base_path: str | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Parquet by directory or by glob.

    A glob below partition directories needs ``base_path``, the root of the
    relation, to keep the partition columns. With a schema the columns come in
    its order, and a relation that has no rows, hence no files, reads as empty.
    """
    reader = spark.read
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    if schema is None:
        return reader.parquet(path)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return reader.schema(schema).parquet(path).select(*schema.fieldNames())


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` a session view for SQL text; returns ``df``."""
    df.createOrReplaceTempView(name)
    return df
