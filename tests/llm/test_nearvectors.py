import math

import duckdb
import numpy as np
import pytest

from farelake.llm import nearvectors as module
from farelake.llm.nearvectors import Nearness, near_vectors
from farelake.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def frame(spark, rows, schema=SCHEMA):
    rows = [(i, None if v is None else [x if x is None else float(x) for x in v], 0) for i, v in rows]
    return spark.createDataFrame(rows, schema).repartition(4)


def plain(rows, cosine=0.9):
    """Every pair of rows."""
    units = []
    for _, v in rows:
        sound = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, np.float64) / np.abs(np.array(v, np.float64)).max() if sound else None)
    links = {i: set() for i in range(len(rows))}
    for i, x in enumerate(units):
        for j, y in enumerate(units[:i]):
            if x is not None and y is not None and len(x) == len(y):
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((key, len(links[i]), least, key == least))
    return sorted(out, key=repr)


def of(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, df.collect()), key=repr)


def near(rng, center, cosine):
    """A vector at just this cosine from a unit vector."""
    other = rng.standard_normal(len(center))
    other -= other @ center * center
    other /= np.linalg.norm(other)
    return cosine * center + math.sqrt(1 - cosine**2) * other


def unit(rng, size=64):
    x = rng.standard_normal(size)
    return x / np.linalg.norm(x)


def corpus_of(rng, n=900, size=64, crowd=300):
    """Lone vectors, pairs and chains about the threshold, exact copies, and one crowded direction."""
    rows = [unit(rng, size) for _ in range(n // 3)]
    for i in range(n // 6):
        x = unit(rng, size)
        rows += [x, near(rng, x, rng.uniform(0.85, 0.95)), near(rng, x, 0.97)]
    x = unit(rng, size)
    rows += [near(rng, x, rng.uniform(0.985, 0.999)) for _ in range(crowd)]
    rows += [near(rng, x, rng.uniform(0.88, 0.94)) for _ in range(40)]
    rows += rows[:20] + [2.0 * r for r in rows[5:15]] + [rows[0]] * 30
    return [(int(i), np.float32(r).tolist()) for i, r in zip(rng.permutation(len(rows)), rows, strict=True)]


@pytest.mark.parametrize(
    "how",
    [
        Nearness(),
        Nearness(fill=1024, block=32),
        Nearness(fill=8, missed=1e-9, block=50, sample=100),
        Nearness(fill=8, missed=1e-9, sample=2000, block=20),
        Nearness(cosine=0.8, fill=32, missed=1e-9, block=64),
    ],
    ids=str,
)
def test_equals_all_pairs(spark, how):
    rows = corpus_of(np.random.default_rng(1))
    assert of(near_vectors(frame(spark, rows), how)) == plain(rows, how.cosine)


@pytest.mark.parametrize("size", [3, 64, 70, 200])
def test_vectors_of_any_length(spark, size):
    rows = corpus_of(np.random.default_rng(size), n=240, size=size, crowd=60)
    how = Nearness(fill=64, missed=1e-9, block=40)
    assert of(near_vectors(frame(spark, rows), how)) == plain(rows)


def test_recall_at_the_threshold(spark):
    """Pairs exactly at the threshold, the hardest there are, among many others."""
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(1500):
        x = unit(rng)
        rows += [x, near(rng, x, 0.9005)]
    rows = [(i, r.tolist()) for i, r in enumerate(rows)]
    got = {r.vec_id: r for r in near_vectors(frame(spark, rows), Nearness(fill=16)).collect()}
    found = sum(got[2 * i].n_links == 1 == got[2 * i + 1].n_links for i in range(1500))
    assert found >= 0.98 * 1500
    assert all(r.component_id // 2 == i // 2 for i, r in got.items())


def test_number_of_tables():
    assert Nearness().tables(0) == Nearness().tables(511) == (0, 1)
    for n in (1000, 10**5, 10**9):
        signs, tables = Nearness().tables(n)
        alike = 1 - math.acos(0.9) / math.pi
        assert n / 2**signs < 2 * 256 and (1 - alike**signs) ** tables <= 0.01


def test_estimates_are_unbiased_with_the_deviation_stated():
    rng = np.random.default_rng(6)
    how = Nearness()
    errors, means = [], []
    for cosine in (0.0, 0.5, 0.9, 0.99):
        x = np.stack([unit(rng, 100) for _ in range(1500)])
        y = np.stack([near(rng, v, cosine) for v in x])
        tile = module._Tile.__new__(module._Tile)
        both = np.concatenate((x, y))
        nodes = [i.to_bytes(16, "little") for i in range(len(both))]
        code, planes, factor, low, step = module._coded(both, nodes, how)
        tile.code = np.frombuffer(b"".join(code), np.uint64).reshape(len(both), -1)
        tile.planes = np.frombuffer(b"".join(planes), np.uint64).reshape(len(both), module.PLANES, -1)
        tile.factor, tile.low, tile.step = map(np.array, (factor, low, step))
        tile.size = 128
        for i in range(1500):
            e, of_code, rounding = tile.estimates(np.array([i]), np.array([1500 + i]))
            errors.append((e[0, 0] - cosine) / math.sqrt((1 - cosine**2) * of_code[0, 0] + rounding[0, 0]))
            means.append(e[0, 0] - cosine)
    assert abs(np.mean(means)) < 0.005
    assert np.std(errors) < 1.1 and np.abs(errors).max() < how.deviations


def test_query_equals_its_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    want = duckdb.sql(ORACLE["op12_near_vectors"]).fetchall()
    assert of(QUERIES["op12_near_vectors"](spark, SF_DIR)) == sorted(want, key=repr)


def test_sql_equals_all_pairs(spark, tmp_path):
    rows = corpus_of(np.random.default_rng(9), n=60, crowd=20)
    rows += [(1000, None), (1001, [0.0] * 64), (1002, [math.nan] * 64), (1003, [None] + [1.0] * 63), (1004, [])]
    frame(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = duckdb.sql(ORACLE["op12_near_vectors"]).fetchall()
    assert sorted(want, key=repr) == plain(rows)
    assert of(QUERIES["op12_near_vectors"](spark, str(tmp_path))) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]),
        (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1e-30, 0.0]), (9, [1e30, 1.0]), (9, [0.0, 1.0]),
        (None, [3.0, 0.1]), (None, [-1.0, 0.0]), (-4, [0.0, 5.0]), (11, [1.0, 0.0, 0.0]), (12, [1.0]), (13, [2.5]),
        (14, [-0.0, 1.0]),
    ]
    extra = "node string, n int, ball int, keys string, component string"
    df = spark.createDataFrame(
        [(i, v, 0, "x", 1, 2, "k", "c") for i, v in rows], f"{SCHEMA}, {extra}"
    )
    assert of(near_vectors(df)) == plain(rows)


def test_doubles_are_compared_as_doubles(spark):
    x = [1.0, 0.0]
    y = [0.9, math.sqrt(1 - 0.81) * (1 + 1e-9)]  # under the threshold by less than a float can hold
    z = [0.9, math.sqrt(1 - 0.81) * (1 - 1e-9)]
    df = spark.createDataFrame([(1, x), (2, y), (3, z)], "vec_id bigint, embedding array<double>")
    assert [r.n_links for r in near_vectors(df).orderBy("vec_id").collect()] == [1, 1, 2]


def test_empty_table(spark):
    assert of(near_vectors(frame(spark, []))) == []
