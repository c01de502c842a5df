"""Column functions for text that holds numbers.

All of them give NULL for text that cannot be read, whether or not ANSI mode
is on, and stay inside generated code (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int(c: ColumnOrName, lenient: bool = False) -> Column:
    """Text to 32-bit int. ``lenient`` also takes ``5.7``, cut to 5."""
    c = _col(c)
    return c.try_cast("double").try_cast("int") if lenient else c.try_cast("int")


def normalize_decimal_text(
    c: ColumnOrName, decimal: str = ",", grouping: str | None = None
) -> Column:
    """Put a point for every decimal mark, keeping the value as text."""
    c = _col(c)
    if grouping:
        c = F.replace(c, F.lit(grouping), F.lit(""))
    return F.replace(c, F.lit(decimal), F.lit("."))


def parse_locale_decimal(
    c: ColumnOrName, decimal: str = ",", grouping: str | None = None, kind: str = "double"
) -> Column:
    """Text such as ``312,90`` to a number of type ``kind``, double unless said otherwise.

    ``1.234,56`` has two points after the repair and so gives NULL, unless
    ``grouping='.'`` says that points only group digits. ``kind="decimal(26,12)"``
    keeps the digits as they are written, with no double in between.
    """
    return normalize_decimal_text(c, decimal, grouping).try_cast(kind)


def whole_units(c: ColumnOrName, places: int) -> Column:
    """A number as an integer count of units of ``places`` decimal places.

    A double stands for the shortest decimal that names it, rounded half-up
    where it has more places. NULL for what is no such number: NaN, an infinity
    or a value of 10^14 and beyond.
    """
    exact = _col(c).try_cast(f"decimal(26,{places})")
    return (exact * F.lit(10**places).cast("decimal(13,0)")).cast("decimal(26,0)")


def half_up_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``numerator / denominator`` rounded half-up to ``digits`` as double.

    Both sides must be exact integers, as decimals without places. The whole
    part and the remainder are divided apart, so nothing is rounded but the
    last digit, once, and no product outgrows 38 digits while the denominator
    has 34 less ``digits``. A zero denominator gives NULL.
    """
    unit = 10**digits
    size = F.abs(F.nullif(denominator, F.lit(0))).cast("decimal(34,0)")
    over = F.abs(numerator)
    whole = F.call_function("div", over, size).cast("decimal(38,0)")
    rest = F.try_mod(over, size) * F.lit(2 * unit) + size
    part = F.call_function("div", rest, size * F.lit(2)).cast("decimal(20,0)")
    rounded = whole * F.lit(unit) + part
    sign = F.when((numerator < 0) != (denominator < 0), F.lit(-1)).otherwise(F.lit(1))
    return (rounded * sign).cast("double") / F.lit(float(unit))
