"""The plans that matter for data too large for one machine."""

import re

import pytest
from helpers import SF_DIR
from pyspark.sql import functions as F

from farelake.checks import proxy
from farelake.config import CURATED_SCHEMA, FARE_KEYS, FARE_SCHEMA, OPERATION_SCHEMA, LakeConfig
from farelake.operators import (
    lookup_place,
    match_operations,
    route_frequency,
    top_routes,
    weighted_mean,
)
from farelake.plans import jobs
from farelake.plans.curate import curate, curate_means
from farelake.sinks import write_processing
from farelake.sources import read_headered, read_headerless, read_zone


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def detailed(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def zones(spark, tmp_path):
    def empty_zone(name, schema):
        path = str(tmp_path / name)
        df = spark.createDataFrame([], schema)
        write_processing(df, path)
        return read_zone(spark, path)

    fares = empty_zone("fares", FARE_SCHEMA)
    ops = empty_zone("ops", OPERATION_SCHEMA)
    airports = empty_zone("icao", "icao string, airport string, city string, state string")
    return fares, ops, airports


def test_the_measure_combines_before_its_only_shuffle(zones):
    plan = physical(weighted_mean(zones[0], FARE_KEYS))
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan


def test_curate_joins_inner_and_never_sorts_below_the_join(zones):
    plan = optimized(curate(*zones))
    assert re.search(r"Join Inner", plan)
    assert "Sort [" not in plan and "GlobalLimit" not in plan


def test_curate_reads_only_what_it_needs(zones):
    plan = detailed(curate(*zones))
    schemas = [set(re.findall(r"[<,](\w+):", s)) for s in re.findall(r"ReadSchema: (\S+)", plan)]
    assert set(FARE_KEYS) | {"price", "seats"} in schemas
    assert set(FARE_KEYS) | {"companyName", "takeOffs", "distance", "seats", "time"} in schemas
    assert {"icao", "city", "state"} in schemas
    assert len(schemas) == 3  # each relation is read once
    assert [f for f in re.findall(r"PushedFilters: (.*)", plan) if "IsNotNull(time)" in f]


def test_a_year_reaches_both_sides_of_the_curated_relation(zones):
    filters = re.findall(r"PushedFilters: (.*)", detailed(curate(*zones).where("year = 2019")))
    assert len([f for f in filters if "EqualTo(year,2019)" in f]) == 2


def test_year_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "zone")
    fares = spark.range(10).select(
        (F.col("id") % 4 + 2019).cast("int").alias("year"), F.lit("a").alias("company")
    )
    write_processing(fares, path, ["year"])
    plan = detailed(read_zone(spark, path).where("year = 2019"))
    assert re.search(r"PartitionFilters: .*year#\d+ = 2019", plan)


def test_year_is_pushed_to_files_without_partitions(zones):
    plan = detailed(zones[0].where("year = 2019"))
    assert "EqualTo(year,2019)" in plan


def test_origin_reaches_the_text_reader(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1;2\n")
    cfg = LakeConfig("l", "p", "c")
    raw = read_headerless(spark, str(tmp_path), FARE_SCHEMA.replace(",", "").split()[::2])
    assert "EqualTo(origin,SBMO)" in detailed(jobs.clean_fares(raw, cfg, 2019))
    titles = ";".join(jobs.OPERATION_COLUMNS)
    (tmp_path / "b").mkdir()
    (tmp_path / "b/b.csv").write_text(f"{titles};EXTRA\n")
    plan = detailed(jobs.clean_operations(read_headered(spark, f"{tmp_path}/b", sep=";"), cfg))
    assert "EqualTo(AEROPORTO_DE_ORIGEM_SIGLA,SBMO)" in plan
    assert "EXTRA" not in re.search(r"ReadSchema: (\S+)", plan).group(1)


def test_cleaning_never_shuffles(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1;2\n")
    raw = read_headerless(spark, str(tmp_path), jobs.FARE_COLUMNS)
    assert "Exchange" not in physical(jobs.clean_fares(raw, LakeConfig("l", "p", "c"), 2019))


def test_small_airports_are_broadcast_and_large_ones_are_not(zones, conf):
    fares, _, airports = zones
    assert "BroadcastHashJoin" in physical(lookup_place(fares, airports))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "SortMergeJoin" in physical(lookup_place(fares, airports))


def test_a_crowded_destination_is_split(spark, conf):
    """The lookup's left side may be split, beyond the broadcast threshold too."""
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }.items():
        conf(name, value)
    fares = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "HOT")
        .otherwise((F.col("id") % 500).cast("string"))
        .alias("destination"),
        F.uuid().alias("x"),
    )
    airports = spark.range(500).select(
        F.col("id").cast("string").alias("icao"),
        F.lit("c").alias("city"),
        F.lit("s").alias("state"),
    )
    placed = lookup_place(fares, airports)
    counted = placed.groupBy().agg(F.count("*"), F.count("city"))
    assert tuple(counted.first()) == (60_000, 40_000)
    counted.collect()
    assert "skew=true" in physical(counted).split("Initial Plan")[0]


def test_written_means_are_broadcast_or_joined_with_skew_split(spark, zones, tmp_path, conf):
    """What curating from written means relies on, though the hot key's rows lie side by side."""
    path = str(tmp_path / "means")
    keys = [F.lit(2019).alias("year"), F.lit(1).alias("month"), F.lit("A").alias("company")]
    place = F.when(F.col("id") % 3 == 0, "HOT").otherwise((F.col("id") % 500).cast("string"))
    route = [F.lit("O").alias("origin"), place.alias("destination")]
    fares = spark.range(1500).select(*keys, *route, F.lit(1.5).alias("price"), F.lit(2).alias("seats"))
    write_processing(weighted_mean(fares, FARE_KEYS), path)
    means = read_zone(spark, path)
    ops = spark.range(0, 60_000, 1, 8).select(
        *keys,
        *route,
        F.uuid().alias("companyName"),
        F.lit(1).alias("takeOffs"),
        F.lit(2).alias("distance"),
        F.lit(3).alias("seats"),
        F.lit("1").alias("time"),
    )
    plan = physical(curate_means(means, ops, zones[2]))
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan

    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }.items():
        conf(name, value)
    matched = match_operations(means, ops, FARE_KEYS, "inner")
    counted = matched.groupBy().agg(F.count("companyName").alias("n"))
    assert counted.first().n == 60_000
    counted.collect()
    assert "skew=true" in physical(counted).split("Initial Plan")[0]


def test_top_routes_keeps_no_more_than_asked(zones):
    assert "TakeOrderedAndProject(limit=10" in physical(top_routes(zones[0], 10))
    plan = physical(route_frequency(zones[0]))
    assert plan.count("HashAggregate") == 2


def test_proxy_reads_few_columns(spark):
    plan = detailed(route_frequency(proxy.fare(spark, SF_DIR)))
    columns = re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert "l_shipdate" not in columns and "l_quantity" not in columns


def test_curated_schema_is_what_curate_gives(spark, zones):
    df = curate(*zones)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in spark.createDataFrame([], CURATED_SCHEMA).schema
    ]
