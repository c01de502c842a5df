"""Row filters and the two filters that list suspicious rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_sentinel(df: DataFrame, column: str, sentinel: str) -> DataFrame:
    """Drop rows whose cell is the sentinel, or NULL.

    Header lines that were read as rows carry the column's title in the cell.
    """
    return df.where(F.col(column) != sentinel)


def slice_period(
    df: DataFrame, first_year: int, last_year: int, origin: str | None = None
) -> DataFrame:
    """Rows of the years from first to last, both included, and of one origin."""
    df = df.where(F.col("year").between(first_year, last_year))
    return df if origin is None else df.where(F.col("origin") == origin)


def require_non_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL (NaN is a value, and stays)."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def unmatched(df: DataFrame, looked_up: str) -> DataFrame:
    """Rows for which a left lookup found nothing."""
    return df.where(F.col(looked_up).isNull())


def blank_values(df: DataFrame, column: str) -> DataFrame:
    """Rows whose cell is NULL, empty or only spaces."""
    return df.where(F.col(column).isNull() | (F.trim(F.col(column)) == ""))
