"""Grouped measures, counts and orderings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType

from farelake.functions import half_up_ratio, whole_units


#: Decimal places that a value is taken to before it is summed.
PLACES = 12


def weighted_mean(
    df: DataFrame,
    keys: Sequence[str],
    value: str = "price",
    weight: str = "seats",
    digits: int = 2,
    null_weight: str = "include",
    mean_name: str | None = None,
) -> DataFrame:
    """Mean of ``value`` weighted by ``weight`` per key, and the weight's sum.

    The weight of a row without a value still counts in the denominator unless
    ``null_weight='exclude'``. No weight at all, or a sum of zero, gives NULL.

    There is one result for all groups: values are whole units of twelve
    decimal places, their products with the weight are integers, which add up
    exactly in any order, and the mean is rounded half-up once. Products with
    values of up to four places and fifteen digits are added up in 64-bit parts,
    all others as decimals. A group has no mean, but NULL, if one of its values
    is NaN, infinite or 10^14 or more, or if its sum of products outgrows 10^26.
    """
    if null_weight not in ("include", "exclude"):
        raise ValueError(f"null_weight must be 'include' or 'exclude', not {null_weight!r}")
    if not isinstance(df.schema[weight].dataType, IntegralType):
        raise TypeError(f"an exact mean needs an integer weight, and {weight} is none")
    mean_name = mean_name or f"{value}AVG"
    w = F.col(weight)
    counted = w if null_weight == "include" else F.when(F.col(value).isNotNull(), w)
    parts = _with_limbs(df, keys, value, weight)
    product = F.try_multiply(whole_units(value, PLACES), w.cast("decimal(20,0)"))
    parts = parts.withColumn("_other", F.when(F.col("_short").isNull(), product))
    other = F.col("_other")
    lost = F.col(value).isNotNull() & w.isNotNull() & F.col("_short").isNull() & other.isNull()
    total = F.try_add(F.coalesce("_others", F.lit(0).cast("decimal(38,0)")), _from_limbs())
    mean = half_up_ratio(
        total.cast("decimal(38,0)"), F.col(weight).cast("decimal(20,0)") * F.lit(10**PLACES), digits
    )
    return (
        parts.groupBy(*keys)
        .agg(
            *[F.sum(limb).alias(f"_sum{i}") for i, limb in enumerate(_limbs())],
            F.try_sum(other).alias("_others"),
            F.count_if(lost).alias("_lost"),
            F.count(other).alias("_n"),
            F.sum(counted).alias(weight),
        )
        .select(
            *keys,
            F.when(_is_small(weight, digits), _small_mean(weight, digits))
            .when(_summed(), mean)
            .alias(mean_name),
            weight,
        )
    )


#: Most values are short decimals: numbers of this many places and fifteen digits.
SHORT = 4
#: What a limb holds. Products and sums of limbs stay below 64 bits for 9 * 10^9 rows of a group.
LIMB = 10**9


def _with_limbs(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """The columns of a mean, and its products with a short decimal as integers in parts.

    ``_short`` is the value in units of ``SHORT`` places, if it is the double
    nearest to such a number and the weight has 32 bits. Fifteen digits name a
    double without doubt, so this is the shortest decimal that names it. Other
    rows have NULL there.
    """
    v, w = F.col(value), F.col(weight)
    columns = list(dict.fromkeys([*keys, value, weight]))
    if not isinstance(df.schema[value].dataType, DoubleType):
        none = F.lit(None).cast("bigint")
        return df.select(*columns, *[none.alias(n) for n in ("_short", "_low", "_high")])
    near = F.when(F.abs(v) < 1e11, F.rint(v * float(10**SHORT)).cast("bigint"))
    exact = F.col("_near").cast("double") / float(10**SHORT) == v
    narrow = F.coalesce(w, F.lit(0)).between(-(2**31), 2**31 - 1)
    short = F.col("_short")
    return (
        df.select(*columns, near.alias("_near"))
        .select(*columns, F.when(exact & narrow, F.col("_near")).alias("_short"))
        .select(*columns, "_short", (short % LIMB * w).cast("bigint").alias("_low"))
        .select(*columns, "_short", "_low", (_cut(short) * w + _cut(F.col("_low"))).alias("_high"))
    )


def _cut(c: Column) -> Column:
    return F.call_function("div", c, F.lit(LIMB))


def _limbs() -> list[Column]:
    low, high = F.col("_low"), F.col("_high")
    return [low % LIMB, high % LIMB, _cut(high)]


def _from_limbs() -> Column:
    """The sum of a group's short products in whole units of ``PLACES`` places; NULL if it outgrows them."""
    total = F.lit(0).cast("decimal(38,0)")
    for i in range(3):
        unit = F.lit(Decimal(LIMB**i * 10 ** (PLACES - SHORT))).cast("decimal(27,0)")
        part = F.coalesce(F.col(f"_sum{i}"), F.lit(0)).cast("decimal(20,0)")
        total = F.try_add(total, F.try_multiply(part, unit).cast("decimal(38,0)")).cast("decimal(38,0)")
    return total


def _is_small(weight: str, digits: int) -> Column:
    """Whether a group's sums have no part that outgrows 64-bit arithmetic; not NULL."""
    small = (F.abs("_sum0") < 4 * 10**18) & (F.abs("_sum1") < 4 * 10**9) & (F.col("_sum2") == 0)
    whole = F.col("_others").isNull() & (F.col("_n") == 0) & (F.col("_lost") == 0)
    return F.coalesce(small & whole & (F.abs(weight) < 10**13), F.lit(False)) & F.lit(digits <= SHORT)


def _small_mean(weight: str, digits: int) -> Column:
    """The mean of a group with small sums, half-up, in 64-bit integers."""
    total = F.col("_sum0") + F.col("_sum1") * LIMB
    unit = F.nullif(F.abs(weight) * 10 ** max(0, SHORT - digits), F.lit(0).cast("bigint"))
    over = F.abs(total)
    rounded = F.call_function("div", over, unit) + F.when(over % unit * 2 >= unit, 1).otherwise(0)
    sign = F.when((total < 0) != (F.col(weight) < 0), -1).otherwise(1)
    return (rounded * sign).cast("double") / float(10**digits)


def _summed() -> Column:
    """Whether a group has products, and all of them could be added up."""
    some = F.col("_sum0").isNotNull() | F.col("_others").isNotNull()
    return some & (F.col("_lost") == 0) & ((F.col("_n") == 0) | F.col("_others").isNotNull())


def route_frequency(
    df: DataFrame, by: str = "destination", counted: str = "origin", name: str = "n"
) -> DataFrame:
    """Rows per route with a known origin, most frequent first, ties by name."""
    return df.groupBy(by).agg(F.count(counted).alias(name)).orderBy(F.desc(name), by)


def top_routes(
    df: DataFrame, n: int = 10, by: str = "destination", counted: str = "origin"
) -> DataFrame:
    """The ``n`` most frequent routes."""
    return route_frequency(df, by, counted).limit(n)


def sort_by(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Sort by one column and then by the remaining keys.

    The keys make the order total. They also let the range partitioning cut
    through a single value of ``column``: twelve months alone would give
    twelve tasks.
    """
    return df.orderBy(column, *[key for key in keys if key != column])


def row_counts(relations: Mapping[str, DataFrame]) -> DataFrame:
    """One row per relation: its name and its number of rows."""
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("relation"), "n")
        for name, df in relations.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def match_coverage(df: DataFrame, column: str = "time") -> DataFrame:
    """How many rows there are, and how many of them found a match."""
    return df.agg(F.count("*").alias("rows"), F.count(column).alias("matched"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of their rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
