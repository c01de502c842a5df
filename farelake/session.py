"""Session helpers shared by checks, tests and the bench."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session on this machine, for tests and the bench."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.sql.session.timeZone": "UTC",
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName("farelake")
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Where checks and benches keep the files they make, a folder that all executors share.
SCRATCH = "spark.farelake.scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder that ``spark.farelake.scratch`` names.

    Everything made on the way lies below it, so whoever has set it can remove it.
    """
    base = spark.conf.get(SCRATCH, None)
    if not base:
        raise RuntimeError(f"set {SCRATCH} to a folder all executors share")
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"
