"""Embeddings that point nearly the same way, found with binary codes of rotated vectors.

A random rotation spreads a vector evenly over its coordinates, so that their
signs are a code of one bit each. A factor stored beside the code corrects the
inner product of the code with another rotated vector, kept in four bits a
coordinate, to an unbiased estimate whose error has a known deviation. A pair
whose estimate stays under the threshold by several deviations is dropped;
all others are computed exactly.

Which vectors meet is decided by the leading signs under further rotations.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.llm.components import components
from farelake.llm.scratch import written

#: Bits of a coordinate of the rotated vector that codes are held against.
PLANES = 4
#: Queries that are held against the codes of a bucket at once.
QUERIES = 256
#: Sampled vectors that make a group of close ones worth a leader.
LEADS = 16


@dataclass(frozen=True)
class Nearness:
    """Vectors are linked from ``cosine`` on.

    ``missed``: the chance that a pair exactly at the threshold never meets;
    closer pairs are missed more rarely. ``fill``: vectors of a bucket if they
    were spread evenly. ``block``: vectors of a bucket that are compared in one
    task. ``sample``: vectors among which leaders of crowded directions are
    picked. ``deviations``: of an estimate, under the threshold, that drop a pair.
    """

    cosine: float = 0.9
    missed: float = 0.01
    fill: int = 256
    block: int = 1024
    sample: int = 8192
    deviations: float = 5.0
    seed: int = 12

    def __post_init__(self) -> None:
        if not 0 < self.cosine < 1 or not 0 < self.missed < 1:
            raise ValueError("the cosine and the share missed lie between 0 and 1")

    def tables(self, n: int) -> tuple[int, int]:
        """Signs of a key, and the number of keys, for ``n`` vectors."""
        signs = max(0, int(math.log2(max(1, n) / self.fill)))
        alike = 1 - math.acos(self.cosine) / math.pi
        if not signs:
            return 0, 1
        return signs, math.ceil(math.log(self.missed) / math.log1p(-(alike**signs)))

    @property
    def ball(self) -> float:
        """A cosine such that two vectors this close to a third one are linked for certain."""
        return math.cos(math.acos(self.cosine) / 2) + 1e-6


def _rotation(rows: int, size: int, seed: int) -> np.ndarray:
    """Rows of a random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, max(rows, 1))))
    return (q * np.where(np.diag(r) < 0, -1.0, 1.0)).T[:rows]


def _units(bodies: list[bytes], dim: int) -> np.ndarray:
    """Vectors of one length as rows, in double precision, scaled to length one."""
    x = np.stack([np.frombuffer(b, f"f{len(b) // dim}") for b in bodies]).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_dim(dims: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    dims = np.array(dims, np.int64)
    for dim in np.unique(dims).tolist():
        yield dim, np.flatnonzero(dims == dim)


def _parsed(vectors: DataFrame, id_type: str) -> DataFrame:
    """``vec_id``, ``node`` (a digest, null if the vector can link with nothing), ``dim``, ``body``.

    A body holds the vector divided by a power of two, which is exact, in
    single precision where that loses nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            sizes = pa.compute.list_value_length(column).fill_null(0).to_numpy()
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            nodes, bodies = [None] * len(sizes), [None] * len(sizes)
            for dim, at in _by_dim(sizes):
                if not dim:
                    continue
                x = flat[starts[at][:, None] + np.arange(dim)]
                largest = np.abs(x).max(axis=1)
                good = np.isfinite(largest) & (largest > 0)
                x, at = x[good], at[good]
                x = np.ldexp(x, -np.frexp(largest[good])[1][:, None]) + 0.0
                single = x.astype(np.float32)
                exact = (single == x).all(axis=1)
                for i, row, short, fits in zip(at.tolist(), x, single, exact, strict=True):
                    bodies[i] = (short if fits else row).tobytes()
                    nodes[i] = hashlib.blake2b(row.tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(nodes, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(bodies, pa.binary()),
                ],
                ["vec_id", "node", "dim", "body"],
            )

    return vectors.mapInArrow(run, f"vec_id {id_type}, node binary, dim int, body binary")


def _leaders(classes: DataFrame, n: int, how: Nearness) -> list[tuple[int, bytes, bytes]]:
    """``dim``, ``node`` and ``body`` of vectors that many others are certainly linked through.

    They are picked among a sample of about ``how.sample`` vectors, so they
    are at most that number by ``LEADS``. They only spare comparisons:
    vectors that no leader is close to are compared with each other.
    """
    ball = how.ball

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).sort_by("node")
        nodes, bodies = table["node"].to_pylist(), table["body"].to_pylist()
        out = []
        for dim, at in _by_dim(table["dim"].to_pylist()):
            x = _units([bodies[i] for i in at], dim)
            close = np.concatenate(
                [(x[i : i + 512] @ x.T >= ball).sum(axis=1) for i in range(0, len(x), 512)]
            )
            free = np.ones(len(x), bool)
            for i in np.argsort(-close, kind="stable").tolist():
                if close[i] < LEADS:
                    break
                if free[i]:
                    own = free & (x @ x[i] >= ball)
                    if own.sum() >= LEADS:
                        free &= ~own
                        out.append((dim, nodes[at[i]], bodies[at[i]]))
        if out:
            dims, nodes, bodies = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(dims, pa.int32()), pa.array(nodes, pa.binary()), pa.array(bodies, pa.binary())],
                ["dim", "node", "body"],
            )

    share = max(1, -(-n // how.sample))
    sampled = classes.where(F.pmod(F.xxhash64("node"), F.lit(share)) == 0)
    found = sampled.select("dim", "node", "body").repartition(1)
    rows = found.mapInArrow(run, "dim int, node binary, body binary").collect()
    return [(r.dim, bytes(r.node), bytes(r.body)) for r in rows]


def _coded(x: np.ndarray, nodes: list[bytes], how: Nearness) -> list[list]:
    """Code, planes, factor, least level and step of each unit vector."""
    size = 64 * -(-x.shape[1] // 64)
    padded = np.zeros((len(x), size))
    padded[:, : x.shape[1]] = x
    turned = padded @ _rotation(size, size, how.seed).T
    code = np.packbits(turned > 0, axis=1, bitorder="little")
    # What the code, as a vector of length one, has in common with the vector.
    factor = np.abs(turned).sum(axis=1) / math.sqrt(size)
    low = turned.min(axis=1)
    step = (turned.max(axis=1) - low) / (2**PLANES - 1)
    # Rounded up or down by a draw of the vector's own, so that it is right on average.
    draws = np.stack(
        [
            np.random.default_rng(int.from_bytes(node, "little")).random(size, np.float32)
            for node in nodes
        ]
    )
    levels = np.floor((turned - low[:, None]) / step[:, None] + draws)
    levels = np.clip(levels, 0, 2**PLANES - 1).astype(np.uint8)
    planes = np.stack(
        [np.packbits((levels >> p) & 1, axis=1, bitorder="little") for p in range(PLANES)], axis=1
    )
    return [
        [c.tobytes() for c in code],
        [p.tobytes() for p in planes],
        factor.tolist(),
        low.tolist(),
        step.tolist(),
    ]


_INDEX = (
    "node binary, dim int, body binary, n bigint, code binary, planes binary, "
    "factor double, low double, step double, ball int, keys array<bigint>"
)
_CODES = ("code", "planes", "factor", "low", "step")


def _indexed(classes: DataFrame, n: int, leaders: list, how: Nearness) -> DataFrame:
    """Each vector with its code, its keys, and the leader it is certainly linked through, or -1."""
    signs, tables = how.tables(n)
    shared = classes.sparkSession.sparkContext.broadcast(leaders)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            nodes, bodies = batch.column("node").to_pylist(), batch.column("body").to_pylist()
            codes = [[None] * rows for _ in _CODES]
            balls, keys = np.full(rows, -1, np.int32), np.zeros((rows, tables), np.int64)
            for dim, at in _by_dim(batch.column("dim").to_pylist()):
                x = _units([bodies[i] for i in at], dim)
                for column, values in zip(codes, _coded(x, [nodes[i] for i in at], how), strict=True):
                    for i, value in zip(at.tolist(), values, strict=True):
                        column[i] = value
                own = [i for i, (d, *_) in enumerate(shared.value) if d == dim]
                if own:
                    cosines = x @ _units([shared.value[i][2] for i in own], dim).T
                    nearest = cosines.argmax(axis=1)
                    near = cosines[np.arange(len(x)), nearest] >= how.ball
                    balls[at[near]] = np.array(own)[nearest[near]]
                for t in range(tables):
                    # A vector has no more signs of one rotation than coordinates.
                    parts = [
                        x @ _rotation(min(dim, signs - s), dim, how.seed + 1 + t + s * 65_537).T > 0
                        for s in range(0, signs, dim)
                    ]
                    for bits in parts:
                        for bit in bits.T:
                            keys[at, t] = keys[at, t] * 2 + bit
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("dim"),
                    batch.column("body"),
                    batch.column("n"),
                    *[
                        pa.array(c, pa.binary() if name in ("code", "planes") else pa.float64())
                        for name, c in zip(_CODES, codes, strict=True)
                    ],
                    pa.array(balls),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, rows * tables + 1, tables, np.int32)),
                        pa.array(keys.reshape(-1)),
                    ),
                ],
                [c.split()[0] for c in _INDEX.split(", ")],
            )

    return classes.select("node", "dim", "body", "n").mapInArrow(run, _INDEX)


_BUCKET = ("t", "dim", "bucket")


def _tiles(index: DataFrame, how: Nearness) -> DataFrame:
    """The rows of the index, once for each pair of blocks of a bucket that they are compared in.

    A bucket within a block's size is one tile. In a larger one, vectors of one
    leader that fill a block are blocks of their own, which are not compared
    with each other, since they are linked for certain.
    """
    rows = index.select("*", F.posexplode("keys").alias("t", "bucket"))
    sizes = rows.groupBy(*_BUCKET, "ball").agg(F.count("*").alias("size"))
    whole = Window.partitionBy(*_BUCKET)
    before = whole.orderBy("ball").rowsBetween(Window.unboundedPreceding, -1)
    own = (F.col("ball") >= 0) & (F.col("size") >= how.block)
    filled = F.when(own, F.ceil(F.col("size") / how.block)).otherwise(0)
    large = (
        sizes.withColumn("rest", F.ceil(F.sum(F.when(own, 0).otherwise(F.col("size"))).over(whole) / how.block))
        .withColumn("blocks", F.col("rest") + F.sum(filled).over(whole))
        .withColumn(
            "start", F.when(own, F.col("rest") + F.coalesce(F.sum(filled).over(before), F.lit(0))).otherwise(0)
        )
        .withColumn("span", F.when(own, filled).otherwise(F.col("rest")))
        .where(F.col("blocks") > 1)
        .select(*_BUCKET, "ball", "blocks", "start", "span", own.alias("alone"))
    )
    large = written(large, "blocks")
    dealt = rows.join(large, [*_BUCKET, "ball"], "left")
    block = F.col("start") + F.pmod(F.xxhash64("node"), F.col("span"))
    dealt = dealt.withColumn("block", F.coalesce(block, F.lit(0).cast("bigint")))
    others = F.filter(
        F.sequence(F.lit(0).cast("bigint"), F.coalesce("blocks", F.lit(1)) - 1),
        lambda j: ~(
            F.coalesce("alone", F.lit(False))
            & (j >= F.col("start"))
            & (j < F.col("start") + F.col("span"))
        ),
    )
    paired = dealt.withColumn("other", F.explode(others))
    return paired.select(
        *_BUCKET,
        F.least("block", "other").alias("low_block"),
        F.greatest("block", "other").alias("high_block"),
        "block", "node", "body", "n", *_CODES, "ball", "keys",
    )


class _Tile:
    """The vectors of a tile, in the order of their nodes."""

    def __init__(self, table: pa.Table):
        self.dim = table["dim"][0].as_py()
        self.t = table["t"][0].as_py()
        self.nodes = table["node"].to_pylist()
        self.bodies = table["body"].to_pylist()
        self.n = table["n"].to_numpy()
        self.ball = table["ball"].to_numpy()
        self.keys = np.stack(table["keys"].combine_chunks().to_numpy(zero_copy_only=False))
        self.block = table["block"].to_numpy()
        rows = len(self.nodes)
        self.code = np.frombuffer(b"".join(table["code"].to_pylist()), np.uint64).reshape(rows, -1)
        planes = np.frombuffer(b"".join(table["planes"].to_pylist()), np.uint64)
        self.planes = planes.reshape(rows, PLANES, -1)
        self.factor, self.low, self.step = (table[c].to_numpy() for c in ("factor", "low", "step"))
        self.size = 64 * self.code.shape[1]

    def estimates(
        self, x: np.ndarray, y: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unbiased estimates of the cosines of vectors ``x`` with those of ``y``, and the variances of their errors.

        The first is of the code's, for vectors at right angles, the second of the rounding's.
        """
        weights = 2.0 ** np.arange(PLANES)
        ones = np.bitwise_count(self.code[y]).sum(axis=1, dtype=np.int64)
        levels = np.bitwise_count(self.planes[x]).sum(axis=2, dtype=np.int64) @ weights
        common = np.zeros((len(x), len(y)))
        for p in range(PLANES):
            for w in range(self.code.shape[1]):
                both = self.planes[x, p, w][:, None] & self.code[y, w][None, :]
                common += weights[p] * np.bitwise_count(both)
        marked = self.low[x, None] * ones[None, :] + self.step[x, None] * common
        total = self.low[x] * self.size + self.step[x] * levels
        f = self.factor[y]
        estimate = (2 * marked - total[:, None]) / math.sqrt(self.size) / f[None, :]
        of_code = (1 - np.minimum(f, 1) ** 2) / (f**2 * max(self.size - 1, 1))
        rounding = (self.step[x, None] / 2 / f[None, :]) ** 2
        return estimate, of_code[None, :], rounding

    def candidates(self, how: Nearness) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that may be linked by their estimates; not those that one leader links."""
        low, high = self.block.min(), self.block.max()
        xs, ys = np.flatnonzero(self.block == low), np.flatnonzero(self.block == high)
        left, right = [], []
        for i in range(0, len(xs), QUERIES):
            x = xs[i : i + QUERIES]
            estimate, of_code, rounding = self.estimates(x, ys)
            # A pair at the threshold or above deviates less than one at right angles.
            error = np.sqrt((1 - how.cosine**2) * of_code + rounding)
            may = estimate + how.deviations * error >= how.cosine
            if low == high:
                may &= x[:, None] < ys[None, :]
            may &= (self.ball[x][:, None] != self.ball[ys][None, :]) | (self.ball[x] < 0)[:, None]
            a, b = np.nonzero(may)
            left.append(x[a])
            right.append(ys[b])
        return np.concatenate(left), np.concatenate(right)

    def links(self, how: Nearness) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs, by their exact cosines, that share no earlier key."""
        a, b = self.candidates(how)
        if not len(a):
            return a, b
        x = _units(self.bodies, self.dim)
        keep = np.concatenate(
            [
                np.einsum("ij,ij->i", x[a[i : i + 65_536]], x[b[i : i + 65_536]]) >= how.cosine
                for i in range(0, len(a), 65_536)
            ]
        )
        a, b = a[keep], b[keep]
        new = np.ones(len(a), bool)
        for t in range(self.t):
            new &= self.keys[a, t] != self.keys[b, t]
        return a[new], b[new]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that links lead to from each of ``n`` places."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _linked(tiles: DataFrame, how: Nearness) -> DataFrame:
    """``node``, ``links`` (weights of others linked in a tile) and ``root``, a node they lead to."""

    def run(table: pa.Table) -> pa.Table:
        tile = _Tile(table.sort_by("node"))
        n = len(tile.nodes)
        a, b = tile.links(how)
        links = np.bincount(a, tile.n[b], n) + np.bincount(b, tile.n[a], n)
        root = _roots(n, a, b)
        at = np.flatnonzero(links > 0)
        return pa.table(
            {
                "node": pa.array([tile.nodes[i] for i in at], pa.binary()),
                "links": pa.array(links[at].astype(np.int64)),
                "root": pa.array([tile.nodes[i] for i in root[at]], pa.binary()),
            }
        )

    groups = tiles.groupBy(*_BUCKET, "low_block", "high_block")
    return groups.applyInArrow(run, "node binary, links bigint, root binary")


def near_vectors(
    vectors: DataFrame,
    how: Nearness = Nearness(),
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Rows are linked if the cosine of their vectors, in double precision, is
    ``how.cosine`` or more; ``n_links`` counts the others that a row is linked
    with directly, ``component_id`` is the smallest id that links lead to, and
    ``kept`` says that it is the row's own. A link that is there is right: each is
    computed exactly, or follows from two vectors being closer to a third than
    half the angle. Some may be missing: pairs meet if they share a key of
    ``how.tables`` of the number of vectors, which at the threshold itself fails
    with a chance of ``how.missed``. Up to twice ``how.fill`` vectors all meet.

    Equal vectors, also those that differ by a power of two only, are one node
    with their number as weight. A null vector, one without components, zero, or
    with a component that is null, NaN or infinite links with nothing; nor do
    vectors of unlike lengths. Such a row is a component of its own. Rows
    without an id are linked like others; their component's id is null if no row
    of it has one. Rows that share an id are rows of their own. Other columns are
    not read. An empty table gives an empty result.
    """
    id_type = vectors.schema[key].dataType.simpleString()
    rows = _parsed(
        vectors.select(
            F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
        ),
        id_type,
    )
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.first("dim").alias("dim"),
        F.first("body").alias("body"),
        F.count("*").alias("n"),
        F.min("vec_id").alias("least_id"),
    )
    classes = written(classes, "vectors")
    total = classes.count()
    leaders = _leaders(classes, total, how)
    index = written(_indexed(classes, total, leaders, how), "index")
    found = written(_linked(_tiles(index, how), how), "found")

    spark = vectors.sparkSession
    led = spark.createDataFrame(
        [(i, bytearray(node)) for i, (_, node, _) in enumerate(leaders)], "ball int, leader binary"
    )
    in_balls = index.where("ball >= 0").select("node", "ball", "n")
    weights = in_balls.groupBy("ball").agg(F.sum("n").alias("together"))
    edges = found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    edges = edges.unionAll(in_balls.join(led, "ball").select("node", "leader").toDF("a", "b"))
    belongs = components(edges, "vector_links").select(F.col("id").alias("node"), "component")

    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    certain = in_balls.join(weights, "ball").select("node", (F.col("together") - F.col("n")).alias("certain"))
    known = (
        classes.select("node", "n", "least_id")
        .join(counted, "node", "left")
        .join(certain, "node", "left")
        .join(belongs, "node", "left")
        .select(
            "node",
            "least_id",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0)) + F.coalesce("certain", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    known = written(known, "known")
    least = written(
        known.groupBy("component").agg(F.min("least_id").alias("component_id")), "components"
    )
    known = written(known.join(least, "component").select("node", "n_links", "component_id"), "known")
    alone = F.col("node").isNull()
    return rows.select("vec_id", "node").join(known, "node", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.lit(True)).otherwise(F.col("vec_id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )
