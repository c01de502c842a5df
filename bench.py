"""Time the headline queries and print one JSON line.

Each figure is the median of RUNS full executions after a warm-up, with the
rows sent to Spark's ``noop`` sink. The ``src_`` query includes writing the
files it reads; the jobs start from landing files that are there already and
include all they write.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable
from dataclasses import replace

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import LakeConfig
from farelake.checks import landing, proxy
from farelake.checks.queries import DATABASES, QUERIES, drop_databases
from farelake.config import FARE_KEYS
from farelake.operators import match_operations, weighted_mean
from farelake.plans import jobs
from farelake.plans.colocated import Colocated
from farelake.plans.curate import curate, curate_yearly, written_means
from farelake.session import SCRATCH, local_session, scratch_path
from farelake.sinks import write_processing
from farelake.sources import read_zone

HEADLINE = (
    "curate_all_years",
    "curate_yearly",
    "agg_weighted_mean",
    "agg_route_frequency",
    "topk_routes",
    "sort_by_month",
    "join_left_multi_key",
    "join_left_lookup",
    "filter_period_origin",
    "proj_cast_columns",
    "src_month_files",
    "zone_partition_overwrite",
    "sink_curated_csv_roundtrip",
)
RUNS = 3


def execute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action: Callable[[], None], runs: int = RUNS) -> float:
    """Median of the runs after one to warm up."""
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def relations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return proxy.fare(spark, sf_dir), proxy.ops(spark, sf_dir), proxy.airport(spark, sf_dir)


def landing_files(spark: SparkSession, sf_dir: str) -> LakeConfig:
    """Landing files of the check tables, and the lake they belong to."""
    root = scratch_path(spark, "landing")
    cfg = LakeConfig(
        landing=root,
        processing="",
        curated="",
        years=proxy.OPERATION_YEARS,
        origin=proxy.ORIGIN,
        month_file=f"price/{landing.MONTH_FILE}",
    )
    landing.write_month_files(spark, sf_dir, cfg.landing_path("price"))
    landing.write_operations(spark, sf_dir, cfg.landing_path(cfg.operations_dir))
    landing.write_airports(spark, sf_dir, cfg.landing_path(cfg.airports_dir))
    return cfg


def new_lake(spark: SparkSession, cfg: LakeConfig) -> LakeConfig:
    """The same landing files with zones and tables of their own."""
    root = scratch_path(spark, "lake")
    database = f"{DATABASES}_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/warehouse'")
    return replace(
        cfg,
        processing=f"{root}/processing",
        curated=f"{root}/curated",
        table=database + ".data{year}",
    )


def one_plan_per_year(spark: SparkSession, sf_dir: str) -> None:
    """A plan per year, run anew for each sink, and twice more for a look at the first."""
    for i, year in enumerate(proxy.OPERATION_YEARS):
        for _ in range(4 if i == 0 else 2):
            execute(curate_yearly(*relations(spark, sf_dir), year, proxy.ORIGIN))


def one_plan_for_all_years(spark: SparkSession, sf_dir: str) -> None:
    """All years at once into Parquet, from which each sink takes its year."""
    path = scratch_path(spark, "bench")
    write_processing(curate(*relations(spark, sf_dir)), path, ["year"], compact=True)
    for year in proxy.OPERATION_YEARS:
        for _ in range(2):
            execute(read_zone(spark, path).where(f"year = {year}"))


def crowded(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Fares and operations in many row groups, a third of each under one company and route.

    The check tables hold their rows in one row group, which one task reads, and spread them evenly.
    """
    root = scratch_path(spark, "crowded")
    copies = spark.range(8).select(F.col("id").alias("copy"))
    hot = F.xxhash64("copy", "company", "destination", "seats") % 3 == 0
    for name, relation in (
        ("fares", proxy.fare(spark, sf_dir, None)),
        ("ops", proxy.ops(spark, sf_dir, None)),
    ):
        rows = relation.crossJoin(F.broadcast(copies))
        placed = rows.withColumns(
            {
                "company": F.when(hot, F.lit(1)).otherwise(F.col("company") * 8 + F.col("copy")),
                "destination": F.when(hot, F.lit(1)).otherwise(F.col("destination")),
                "month": F.when(hot, F.lit(1)).otherwise(F.col("month")),
            }
        )
        placed.drop("copy").repartition(64).write.parquet(f"{root}/{name}")
    return f"{root}/fares", f"{root}/ops"


def crowded_mean(spark: SparkSession, paths: tuple[str, str]) -> None:
    execute(weighted_mean(spark.read.parquet(paths[0]), FARE_KEYS))


def crowded_match(spark: SparkSession, paths: tuple[str, str]) -> None:
    means = written_means(spark.read.parquet(paths[0]), scratch_path(spark, "means"))
    execute(match_operations(means, spark.read.parquet(paths[1]), FARE_KEYS, "inner"))


def in_buckets(spark: SparkSession, paths: tuple[str, str]) -> Colocated:
    """The same rows kept by the fare keys, those of the crowded key apart."""
    root = scratch_path(spark, "buckets")
    database = f"{DATABASES}_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/warehouse'")
    kept = Colocated(database, f"{root}/kept", buckets=8)
    means = written_means(spark.read.parquet(paths[0]), scratch_path(spark, "means"))
    kept.keep_means(means, proxy.YEARS)
    kept.keep_operations(spark.read.parquet(paths[1]), proxy.YEARS)
    return kept


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        bench(local_session(cores, **{SCRATCH: scratch}), sf_dir, cores)


def bench(spark: SparkSession, sf_dir: str, cores: int) -> None:
    queries = {
        name: seconds(lambda query=QUERIES[name]: execute(query(spark, sf_dir)))
        for name in HEADLINE
    }
    cfg = landing_files(spark, sf_dir)
    queries["job_process_fares"] = seconds(lambda: jobs.process_fares(spark, new_lake(spark, cfg)))
    queries["job_run"] = seconds(lambda: jobs.run(spark, new_lake(spark, cfg)))
    paths = crowded(spark, sf_dir)
    queries["crowded_mean"] = seconds(lambda: crowded_mean(spark, paths))
    queries["crowded_match"] = seconds(lambda: crowded_match(spark, paths))
    kept = in_buckets(spark, paths)
    queries["crowded_match_buckets"] = seconds(lambda: execute(kept.match(spark, proxy.YEARS)))
    comparison = {
        shape.__name__: seconds(lambda shape=shape: shape(spark, sf_dir), runs=1)
        for shape in (one_plan_per_year, one_plan_for_all_years)
    }
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "comparison": comparison,
                "cores": cores,
                "driver_memory": spark.conf.get("spark.driver.memory"),
                "spark": pyspark.__version__,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                "warm_up_runs": 1,
                "runs": RUNS,
            }
        )
    )
    drop_databases(spark)
    spark.stop()


if __name__ == "__main__":
    main()
