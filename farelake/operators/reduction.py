"""Keeping away from a shuffle the rows that a join would drop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits that a filter has at most: 4 MB, however many keys there are.
WORDS = 1 << 18


def reduce_to_keys(df: DataFrame, keyed: DataFrame, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """The rows of ``df`` whose keys may be among those of ``keyed``; none that are is lost.

    A semi-join reduction for an inner join on the keys. The keys of ``keyed``
    set bits in a table of at most ``words`` rows, which is what is broadcast,
    whatever its size. Each row looks its bit up in generated code, before any
    shuffle. With many more keys than bits all rows pass. Rows with a NULL key,
    which match nothing, may stay or go.
    """
    types = {f.name: f.dataType for f in df.schema}
    # Hashes depend on the type: both sides take that of ``df``.
    own = F.xxhash64(*[F.col(k) for k in keys])
    theirs = F.xxhash64(*[F.col(k).cast(types[k]) for k in keys])

    def word(h):
        return F.pmod(h, F.lit(words))

    def bit(h):
        return F.shiftrightunsigned(h, 58).cast("int")

    one = F.lit(1).cast("bigint")
    mask = F.call_function("shiftleft", one, bit(theirs))
    bits = keyed.select(word(theirs).alias("_word"), mask.alias("_mask"))
    bits = bits.groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    looked = df.join(F.broadcast(bits), word(own) == bits["_word"])
    return looked.where(F.getbit("_bits", bit(own)) == 1).select(*[df[c] for c in df.columns])
