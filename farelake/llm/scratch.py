"""Tables that are written between the steps of an operator."""

from __future__ import annotations

import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which all executors share.

    Where that is unset, as in tests, a folder of this machine serves, which
    only a local master can use.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = f"file://{_local_folder()}"
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet and read again.

    Cuts the lineage: a lost executor costs a part of a scan, and what is
    derived from it twice is computed once.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def removed(*tables: DataFrame) -> None:
    """Remove tables that ``written`` has written, once all that was made of them is written too.

    Nothing may read them after that, not even to make up for an executor that
    is lost: what was made of them is in tables of its own.
    """
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
