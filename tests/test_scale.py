"""Branches that resume, joins that send less, and frequent keys without a shuffle of all."""

import random
from collections import Counter

import pytest
from helpers import SF_DIR, rows
from pyspark.sql import functions as F

from farelake import LakeConfig
from farelake.checks import landing, proxy
from farelake.config import FARE_KEYS
from farelake.operators import heavy, reduce_to_keys, top_keys, top_routes
from farelake.plans import branches, jobs
from farelake.plans.curate import curate_means


@pytest.fixture
def spark(session):
    session.conf.set("spark.sql.ansi.enabled", "true")
    return session


@pytest.fixture
def lake(spark, tmp_path):
    cfg = LakeConfig(
        landing=f"file://{tmp_path}/landing", processing=f"file://{tmp_path}/processing",
        curated=f"file://{tmp_path}/curated", years=(1996, 1997), origin=proxy.ORIGIN,
        month_file=f"price/{landing.MONTH_FILE}", table="branches_test.data{year}",
    )
    landing.write_month_files(spark, SF_DIR, cfg.landing_path("price"))
    landing.write_operations(spark, SF_DIR, cfg.landing_path(cfg.operations_dir))
    landing.write_airports(spark, SF_DIR, cfg.landing_path(cfg.airports_dir))
    spark.sql("CREATE DATABASE IF NOT EXISTS branches_test")
    yield cfg
    spark.sql("DROP DATABASE branches_test CASCADE")


def test_a_run_resumes_where_it_failed(spark, lake, monkeypatch):
    done = []
    for name in ("process_fares", "process_airports", "process_operations", "curate_and_publish"):
        work = getattr(jobs, name)
        monkeypatch.setattr(
            jobs, name, lambda s, c, name=name, work=work: done.append((name, c.years)) or work(s, c)
        )
    healthy = jobs.process_operations
    monkeypatch.setattr(jobs, "process_operations", lambda s, c: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        branches.run(spark, lake, "a")
    assert sorted(n for n, _ in done) == ["process_airports", "process_fares", "process_fares"]
    done.clear()
    monkeypatch.setattr(jobs, "process_operations", healthy)
    got = rows(branches.run(spark, lake, "a"))
    assert [n for n, _ in done] == ["process_operations", "curate_and_publish"]
    done.clear()
    assert rows(branches.run(spark, lake, "a")) == got and done == []
    monkeypatch.undo()
    assert rows(jobs.run(spark, lake)) == got


def test_a_year_that_failed_is_the_only_one_done_again(spark, lake, monkeypatch):
    work, done = jobs.process_fares, []

    def failing(s, c):
        if c.years == (1997,) and "failed" not in done:
            done.append("failed")
            raise RuntimeError("lost")
        done.append(c.years)
        return work(s, c)

    monkeypatch.setattr(jobs, "process_fares", failing)
    with pytest.raises(RuntimeError):
        branches.run(spark, lake, "b")
    branches.run(spark, lake, "b")
    assert done == [(1996,), "failed", (1997,)]


def keyed(spark, pairs):
    return spark.createDataFrame(pairs, "k bigint, s string, v int")


def test_reduction_loses_no_match(spark):
    rng = random.Random(4)
    left = keyed(spark, [(rng.randint(0, 5000), rng.choice("abc"), i) for i in range(20_000)])
    right = keyed(spark, [(rng.randint(0, 5000), rng.choice("abc"), i) for i in range(300)])
    reduced = reduce_to_keys(left, right, ["k", "s"])
    assert reduced.columns == left.columns
    want = left.join(right.select("k", "s").distinct(), ["k", "s"], "left_semi")
    assert rows(reduced.join(right.select("k", "s").distinct(), ["k", "s"], "left_semi")) == rows(want)
    assert reduced.count() <= 1.1 * want.count() < 0.1 * left.count()
    few = reduce_to_keys(left, right, ["k", "s"], words=1)  # overfull, and still right
    assert rows(few.join(right.select("k", "s").distinct(), ["k", "s"], "left_semi")) == rows(want)


def test_fewer_operations_are_shuffled(spark, tmp_path):
    """Means of one month against operations of all: what passes is what can match, and little else."""
    means = proxy.avg_fare(spark, SF_DIR).where("year = 1996 and month = 5")
    ops = proxy.ops(spark, SF_DIR)
    passed = reduce_to_keys(ops, means, FARE_KEYS).count()
    matching = ops.join(means.select(*FARE_KEYS), list(FARE_KEYS), "left_semi").count()
    assert matching <= passed <= matching + 0.01 * ops.count() and passed < 0.1 * ops.count()
    airports = proxy.airport(spark, SF_DIR)
    assert rows(curate_means(means, ops, airports, reduce=True)) == rows(curate_means(means, ops, airports))


def test_reduction_takes_keys_of_another_type(spark):
    left = keyed(spark, [(i, "a", i) for i in range(1000)])
    right = left.where("k % 100 = 0").select(F.col("k").cast("int").alias("k"), "s")
    assert {r.k for r in reduce_to_keys(left, right, ["k", "s"]).collect()} >= set(range(0, 1000, 100))


def test_reduction_comes_before_the_shuffle(spark, tmp_path):
    left, right = keyed(spark, [(i, "a", i) for i in range(5000)]), keyed(spark, [(1, "a", 1)])
    plan = reduce_to_keys(left, right, ["k", "s"]).repartition("k")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(k") < plan.index("BroadcastHashJoin")


def zipf(seed, n, keys):
    rng = random.Random(seed)
    return [(f"k{int(keys * rng.random() ** 4)}" if rng.random() > 0.01 else None, rng.choice([None, "x", "y"])) for _ in range(n)]


@pytest.mark.parametrize("capacity", [12, 40, 10_000])
def test_frequent_keys_are_exact(spark, capacity):
    pairs = zipf(1, 6000, 3000)
    df = spark.createDataFrame(pairs, "destination string, origin string").repartition(5)
    got = [tuple(r) for r in top_keys(df, 8, capacity=capacity).collect()]
    count = Counter(k for k, v in pairs if v is not None)
    want = sorted(count.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:8]
    assert got == want == [tuple(r) for r in top_routes(df, 8).collect()]


def test_a_sketch_never_counts_too_much_and_misses_a_known_number_at_most(spark):
    pairs = zipf(2, 4000, 500)
    df = spark.createDataFrame(pairs, "destination string, origin string").repartition(3)
    count = Counter(k for k, v in pairs if v is not None)
    found, missed = Counter(), {}
    for r in heavy._sketched(df, "destination", "origin", 30).collect():
        found[r.key] += r.n
        missed[r.part] = r.missed
    assert all(found[k] <= n <= found[k] + sum(missed.values()) for k, n in count.items())


def test_few_keys_are_shuffled_where_some_are_frequent(spark, monkeypatch):
    df = spark.createDataFrame(
        [("hot", "x")] * 3000 + [("warm", "x")] * 2000 + [(f"k{i}", "x") for i in range(3000)],
        "destination string, origin string",
    ).repartition(2)
    counted = []
    usual = heavy.route_frequency
    monkeypatch.setattr(heavy, "route_frequency", lambda d, *a: counted.append(d.select("destination").distinct().count()) or usual(d, *a))
    assert [tuple(r) for r in top_keys(df, 2, capacity=50).collect()] == [("hot", 3000), ("warm", 2000)]
    assert counted == [2]


@pytest.mark.parametrize("data", [[], [(None, "x")], [("a", None)], [("a", "x"), ("b", None)]])
def test_few_rows(spark, data):
    df = spark.createDataFrame(data, "destination string, origin string")
    assert rows(top_keys(df, 3)) == rows(top_routes(df, 3))
