"""Renaming and typing of raw columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.functions import parse_int


def promote_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Name the columns of a headerless frame by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def select_as(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped source columns under their new names and drop the rest."""
    return df.select(*[F.col(source).alias(name) for source, name in mapping.items()])


def cast_columns(
    df: DataFrame,
    types: Mapping[str, str | Callable[[Column], Column]],
    lenient: bool = False,
) -> DataFrame:
    """Retype columns in place, all in one projection.

    A type is a Spark type name, or a function of the column such as
    ``parse_locale_decimal``. Cells that do not fit become NULL.
    """

    def retyped(name: str, kind: str | Callable[[Column], Column]) -> Column:
        if callable(kind):
            return kind(F.col(name))
        if kind == "int":
            return parse_int(F.col(name), lenient=lenient)
        return F.col(name).try_cast(kind)

    return df.withColumns({name: retyped(name, kind) for name, kind in types.items()})
