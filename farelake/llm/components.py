"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.scratch import removed, written


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame, label: str = "links", most_rounds: int = 100) -> DataFrame:
    """``id`` and ``component`` (its smallest id) of every id in the links ``a``, ``b``.

    Large-star and small-star rounds (Kiveris et al., 2014) pull each id's
    neighbours towards the smallest one until nothing moves, in a number of
    rounds that grows with the logarithm of the longest path. Each round is
    written. No id's neighbours are ever gathered: a round is an aggregate of
    minima and a join with it, whose crowded keys can be split. Links of an id
    with itself, and those with a null, say nothing and are left out.
    """
    # Every link points from the larger id ``a`` to the smaller id ``b``.
    links = written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        label,
    )
    state = _state(links)
    for _ in range(most_rounds):
        if not state[0]:
            break
        # Large star: an id's larger neighbours move to the smallest of all its neighbours or itself.
        nearest = links.groupBy("a").agg(F.min("b").alias("least"))
        moved = (
            links.select(F.col("b").alias("id"), F.col("a").alias("larger"))
            .join(nearest.withColumnRenamed("a", "id"), "id", "left")
            .select(F.col("larger").alias("a"), F.coalesce("least", "id").alias("b"))
            .distinct()
        )
        moved = written(moved, label)
        removed(links)
        # Small star: an id and its smaller neighbours move to the smallest of these.
        nearest = moved.groupBy("a").agg(F.min("b").alias("least"))
        pulled = moved.join(nearest, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        links = written(
            nearest.select("a", F.col("least").alias("b"))
            .unionByName(pulled)
            .where("a <> b")
            .distinct(),
            label,
        )
        removed(moved)
        before, state = state, _state(links)
        if state == before:
            break
    else:
        raise RuntimeError(f"links still moved after {most_rounds} rounds")
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
