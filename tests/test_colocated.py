"""Relations in buckets: joined without an exchange, whatever is refreshed, however crowded a key."""

import pytest
from helpers import SF_DIR, rows
from pyspark.sql import functions as F

from farelake.checks import proxy
from farelake.config import FARE_KEYS
from farelake.operators import match_operations, weighted_mean
from farelake.plans.colocated import Colocated


@pytest.fixture
def kept(session, tmp_path):
    session.conf.set("spark.sql.ansi.enabled", "true")
    session.sql("CREATE DATABASE IF NOT EXISTS colocated_test")
    yield Colocated("colocated_test", f"file://{tmp_path}/kept", buckets=4, part=50, least=20)
    session.sql("DROP DATABASE colocated_test CASCADE")


@pytest.fixture
def spark(session):
    return session


def sides(spark):
    """Fares and operations of which one key has a third of all rows, and some keys are null."""
    ops = proxy.ops(spark, SF_DIR, None)
    hot = {"month": 3, "company": 1, "origin": "N", "destination": 2, "year": 1997}
    third = F.col("takeOffs") <= 2
    ops = ops.withColumns({k: F.when(third, F.lit(v)).otherwise(F.col(k)).cast(ops.schema[k].dataType) for k, v in hot.items()})
    ops = ops.withColumn("origin", F.when(F.col("seats") == 7, F.lit(None)).otherwise(F.col("origin")))
    means = weighted_mean(proxy.fare(spark, SF_DIR, None), FARE_KEYS)
    extra = spark.createDataFrame(
        [(1997, 3, 1, "N", 2, 5.5, 3), (1996, 1, 0, None, 2, 1.0, 1)],
        "year int, month int, company bigint, origin string, destination int, priceAVG double, seats bigint",
    )
    return means.where(~((F.col("year") == 1997) & (F.col("month") == 3) & (F.col("company") == 1))).unionByName(extra), ops


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gives_what_the_plain_join_gives(spark, kept):
    means, ops = sides(spark)
    kept.keep_means(means, proxy.YEARS)
    kept.keep_operations(ops, proxy.YEARS)
    want = match_operations(means.where(F.col("year").isin(*proxy.YEARS)), ops)
    got = kept.match(spark, proxy.YEARS)
    assert got.columns == want.columns
    assert rows(got) == rows(want)
    crowded = spark.read.parquet(kept.crowded)
    assert crowded.count() > 900 and crowded.select(*FARE_KEYS).distinct().count() <= 50


def test_nothing_is_exchanged(spark, kept, conf_off):
    means, ops = sides(spark)
    kept.keep_means(means, proxy.YEARS)
    kept.keep_operations(ops, proxy.YEARS)
    text = plan(kept.match(spark, proxy.YEARS))
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" in text
    assert text.count("BroadcastExchange") == 3  # of the few crowded keys and their means


@pytest.fixture
def conf_off(session):
    before = session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_refresh_writes_its_year_only(spark, kept, tmp_path):
    means, ops = sides(spark)
    kept.keep_means(means, proxy.YEARS)
    kept.keep_operations(ops, proxy.YEARS)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "kept").rglob("*.parquet")}
    changed = ops.where(F.col("year") == 1996).withColumn("seats", F.col("seats") + 1)
    kept.keep_operations(changed, [1996])
    again = {p: p.stat().st_mtime_ns for p in (tmp_path / "kept").rglob("*.parquet")}
    assert {p for p in files if "year=1996" not in str(p)} <= set(again)
    assert all(files[p] == again[p] for p in files if "year=1996" not in str(p))
    want = match_operations(
        means.where(F.col("year").isin(*proxy.YEARS)), ops.where("year <> 1996").unionByName(changed)
    )
    assert rows(kept.match(spark, proxy.YEARS)) == rows(want)
    kept.keep_operations(ops, [1995])
    kept.keep_operations(ops.where("false"), [1997])
    want = match_operations(
        means.where(F.col("year").isin(*proxy.YEARS)),
        ops.where("year not in (1996, 1997)").unionByName(changed),
    )
    assert rows(kept.match(spark, proxy.YEARS)) == rows(want)


def test_another_session_finds_the_tables(spark, kept):
    means, ops = sides(spark)
    kept.keep_means(means, proxy.YEARS)
    before = rows(kept.means.read(spark))
    spark.sql("DROP TABLE colocated_test.means")  # its files stay: they are at a place of their own
    kept.means._create(spark, means.schema)
    assert rows(kept.means.read(spark)) == before


def test_buckets_are_files_by_key(spark, kept, tmp_path):
    means, _ = sides(spark)
    kept.keep_means(means, proxy.YEARS)
    for folder in (tmp_path / "kept" / "means").glob("year=*"):
        assert len(list(folder.glob("*.parquet"))) <= kept.buckets


def test_a_task_joins_a_bucket_of_one_year(spark, kept, conf_off):
    means, ops = sides(spark)
    kept.keep_means(means, proxy.YEARS)
    kept.keep_operations(ops, proxy.YEARS)
    text = plan(kept.match(spark, proxy.YEARS))
    assert len({line.split("SortMergeJoin")[1] for line in text.split("\n") if "SortMergeJoin" in line}) == len(proxy.YEARS)
    assert kept.match(spark, []).count() == 0
