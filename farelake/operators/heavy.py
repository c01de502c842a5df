"""The most frequent keys, without a shuffle of all keys."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.operators.measures import route_frequency

# Tasks take these functions along, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keys that a task keeps count of.
CAPACITY = 1 << 14


def _merged(table: pa.Table, capacity: int) -> tuple[pa.Table, int]:
    """Counts added up by key; beyond ``capacity`` keys all are lowered until few enough are left, and by how much."""
    table = table.group_by("key", use_threads=False).aggregate([("n", "sum")]).rename_columns(["key", "n"])
    if table.num_rows <= capacity:
        return table, 0
    n = table["n"].to_numpy()
    lowered = int(np.partition(n, -capacity - 1)[-capacity - 1])
    kept = table.filter(pa.array(n > lowered))
    return kept.set_column(1, "n", pc.subtract(kept["n"], lowered)), lowered


def _sketched(df: DataFrame, by: str, counted: str, capacity: int) -> DataFrame:
    """Per task: keys with counts that are too low by ``missed`` at most; keys left out have ``missed`` at most."""
    kind = df.schema[by].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, missed = None, 0
        for batch in batches:
            keys = batch.column("key")
            own = pa.table({"key": keys, "n": pa.array(np.ones(len(keys), np.int64))})
            held = pa.concat_tables([held, own]) if held is not None else own
            held, lowered = _merged(held, capacity)
            missed += lowered
        if held is not None:
            flat = held.combine_chunks()
            errors = pa.array(np.full(flat.num_rows, missed, np.int64))
            for part in flat.append_column("missed", errors).to_batches():
                yield part
            if not flat.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, flat.schema.field("key").type), pa.array([0]), pa.array([missed])],
                    ["key", "n", "missed"],
                )

    rows = df.where(F.col(counted).isNotNull()).select(F.col(by).alias("key"))
    sketch = rows.mapInArrow(run, f"key {kind}, n bigint, missed bigint")
    return sketch.withColumn("part", F.spark_partition_id())


def top_keys(
    df: DataFrame,
    n: int = 10,
    by: str = "destination",
    counted: str = "origin",
    name: str = "n",
    capacity: int = CAPACITY,
) -> DataFrame:
    """The ``n`` most frequent values of ``by`` among rows with a known ``counted``; ties by value.

    The same as ``top_routes``, for keys of many values. A first pass keeps up to
    ``capacity`` counts in each task, which are too low by a known number at
    most; only these are shuffled. A value whose count could reach the n-th
    largest is then counted exactly, in a second pass. If so little of the rows
    lies with frequent values that one which no task has kept could reach it
    too, all values are counted in the usual way. Values without a known
    ``counted`` come last, with zero, and so only there.
    """
    spark = df.sparkSession
    sketch = _sketched(df, by, counted, capacity).persist()
    try:
        missed = sketch.groupBy("part").agg(F.max("missed").alias("m")).agg(F.sum("m")).first()[0] or 0
        lowest = sketch.where("n > 0").groupBy("key").agg(F.sum("n").alias("n"))
        best = [r.n for r in lowest.orderBy(F.desc("n")).limit(n).collect()]
        if len(best) < n or best[-1] <= missed:
            return route_frequency(df, by, counted, name).limit(n)
        reach = lowest.where(F.col("n") + missed >= best[-1]).select("key").limit(capacity + 1).collect()
    finally:
        sketch.unpersist()
    if len(reach) > capacity:
        return route_frequency(df, by, counted, name).limit(n)
    kind = df.schema[by].dataType.simpleString()
    chosen = spark.createDataFrame([(r.key,) for r in reach], f"key {kind}")
    own = df.join(F.broadcast(chosen), df[by].eqNullSafe(chosen["key"]), "left_semi")
    return route_frequency(own, by, counted, name).limit(n)
