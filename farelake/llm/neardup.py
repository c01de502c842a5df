"""Near duplicates: a chosen-path set similarity join over word shingles.

Texts are sets of word shingles. A tree starts with all sets in one node. A
node sends each of its sets to one child per chosen minwise function, named by
the set's smallest token under it, so that sets share a child with the
probability of their similarity. Nodes that are small enough are compared
exhaustively on sketches, larger ones branch on, and several independent trees
bring the share of missed pairs below a stated one. Pairs are confirmed on
the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.llm.components import components
from farelake.llm.scratch import removed, written
from farelake.llm.words import U64, Words, chunks, grams_inside, mix, seeds, sequence_hashes
from farelake.operators import reduce_to_keys

#: Bytes of a sketch: for each of so many ranges of token hashes, a byte of the smallest in it.
SKETCH = 256
#: Children per set and node, each by a minwise function of its own.
BRANCHES = 2
#: Sets of a large leaf that are in each of its blocks.
SHARED = 16


@dataclass(frozen=True)
class Similarity:
    """Sets of ``words``-word shingles are linked from a Jaccard similarity of ``percent`` / 100.

    ``trees`` are walked. A node is a leaf, whose sets are all compared, if it
    has at most ``small`` sets, or keeps more than half of its parent's, since
    branching does not take sets apart that are much alike, or is ``depth``
    levels down. Large leaves are compared in blocks of ``block`` sets.
    """

    words: int = 5
    percent: int = 80
    trees: int = 4
    small: int = 256
    block: int = 512
    depth: int = 4

    def missed(self) -> float:
        """Share of pairs right at the threshold that meet in no leaf of any tree."""
        meet = 1.0
        for _ in range(self.depth):
            meet = 1 - (1 - self.percent / 100 * meet) ** BRANCHES
        return (1 - meet) ** self.trees


def shingles(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each; where each text's start; its words.

    ASCII letters are lower-cased. A text of fewer than ``n`` words has its
    whole sequence as its only shingle, and one without words none.
    """
    words = Words(column, lower=True)
    h = words.hashes()
    at, g = grams_inside(words, h, n)
    of = words.doc[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        g = np.concatenate((g, sequence_hashes(words, h, n)[short]))
        of = np.concatenate((of, short))
    order = np.lexsort((g, of))
    g, of = g[order], of[order]
    if len(g):
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (of[1:] != of[:-1])
        g, of = g[new], of[new]
    return g, np.searchsorted(of, np.arange(len(words.counts) + 1)), words.counts


def _functions(level: int, how: Similarity) -> np.ndarray:
    """The minwise functions of a level: one for each branch of each path of each tree."""
    return seeds(how.trees * BRANCHES ** (level + 1), 11 + 1000 * level)


def _minima(g: np.ndarray, bounds: np.ndarray, functions: np.ndarray) -> np.ndarray:
    """The smallest hash of each set under each function; sets must not be empty."""
    out = np.empty((len(bounds) - 1, len(functions)), np.uint64)
    for i, seed in enumerate(functions):
        out[:, i] = np.minimum.reduceat((g ^ seed) * U64(0xD6E8FEB86659FD93), bounds[:-1])
    return out


def _sketches(g: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n = len(bounds) - 1
    of = np.repeat(np.arange(n), np.diff(bounds))
    cell = of * SKETCH + (g >> U64(56)).astype(np.int64)
    first = np.ones(len(g), bool)
    first[1:] = cell[1:] != cell[:-1]
    out = np.zeros(n * SKETCH, np.uint8)
    out[cell[first]] = ((g[first] >> U64(40)) % U64(255) + U64(1)).astype(np.uint8)
    return out.reshape(n, SKETCH)


def _names(g: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """A 128-bit name of each set; sets must not be empty."""
    sums = [np.add.reduceat(mix(g ^ s), bounds[:-1]) for s in seeds(2, 12)]
    return [r.tobytes() for r in np.stack(sums, 1)]


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def signatures(docs: DataFrame, how: Similarity) -> DataFrame:
    """``doc_id``, ``digest``, ``n_shingles``, the set's 128-bit name, its minwise tokens at the roots and its sketch.

    A text without words has null in the last three.
    """
    functions = _functions(0, how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            g, bounds, _ = shingles(batch.column("text"), how.words)
            sizes = np.diff(bounds)
            some = np.flatnonzero(sizes)
            names = minima = sketches = [None] * len(sizes)
            if len(some):
                full = np.append(bounds[some], len(g))
                names, minima, sketches = (np.full(len(sizes), None, object) for _ in range(3))
                names[some] = _names(g, full)
                minima[some] = [r.tobytes() for r in _minima(g, full, functions)]
                sketches[some] = [r.tobytes() for r in _sketches(g, full)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("digest"),
                    pa.array(sizes.astype(np.int64)),
                    *(pa.array(list(x), pa.binary()) for x in (names, minima, sketches)),
                ],
                ["doc_id", "digest", "n_shingles", "name", "minima", "sketch"],
            )

    return docs.mapInArrow(
        run, "doc_id bigint, digest bigint, n_shingles bigint, name binary, minima binary, sketch binary"
    )


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of the documents in ``ids``, and a few others.

    They are told by a table of bits of a bounded size, so no text is shuffled.
    """
    return reduce_to_keys(docs.select("doc_id", "text"), ids.select("doc_id"), ["doc_id"])


def _deeper(ids: DataFrame, docs: DataFrame, level: int, how: Similarity) -> DataFrame:
    """``doc_id`` and ``minima``, the minwise tokens of a level, of the sets in ``ids`` (``doc_id``, ``name``)."""
    functions = _functions(level, how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            g, bounds, _ = shingles(batch.column("text"), how.words)
            some = np.flatnonzero(np.diff(bounds))
            if len(some):
                full = np.append(bounds[some], len(g))
                minima = [r.tobytes() for r in _minima(g, full, functions)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(some)),
                        *(pa.array(x, pa.binary()) for x in (_names(g, full), minima)),
                    ],
                    ["doc_id", "name", "minima"],
                )

    chosen = _among(docs, ids)
    found = chosen.mapInArrow(run, "doc_id bigint, name binary, minima binary")
    return found.join(ids, ["doc_id", "name"], "left_semi").dropDuplicates(["doc_id"]).drop("name")


def _branched(
    node: np.ndarray, path: np.ndarray, minima: np.ndarray, level: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each branch, the child of each row's node and the child's path.

    A path is the number of a tree and of the branches taken in it. It has
    functions of its own, so what two sets lose on one path says nothing of another.
    """
    for branch in range(BRANCHES):
        place = path * BRANCHES + branch
        token = minima[np.arange(len(minima)), place]
        yield mix(token ^ mix(node + seeds(1, 1000 + level)[0]) ^ U64(branch + 1)), place


def _children(rows: DataFrame, level: int) -> DataFrame:
    """``node``, ``path``, ``doc_id``, ``parent`` one level down.

    ``rows`` have ``node``, ``path``, ``doc_id``, ``minima`` and ``n``; ``parent`` is the parent's size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            minima = np.frombuffer(b"".join(batch.column("minima").to_pylist()), np.uint64)
            minima = minima.reshape(batch.num_rows, -1)
            node = batch.column("node").to_numpy(zero_copy_only=False).view(np.uint64)
            path = batch.column("path").to_numpy(zero_copy_only=False)
            ids, sizes = batch.column("doc_id"), batch.column("n")
            for child, place in _branched(node, path, minima, level):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(child)), pa.array(place), ids, sizes],
                    ["node", "path", "doc_id", "parent"],
                )

    return rows.select("node", "path", "doc_id", "minima", "n").mapInArrow(
        run, "node bigint, path bigint, doc_id bigint, parent bigint"
    )


def _leaves(sets: DataFrame, docs: DataFrame, how: Similarity) -> DataFrame:
    """``node``, ``doc_id``, ``n`` of all nodes that are compared; ``n`` is the node's size.

    Only nodes of two sets or more are walked, so what is carried from level to
    level is a small part of the input. Tokens below the roots are made from the
    texts again, of the sets in large nodes only.
    """
    trees = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(how.trees - 1).cast("bigint")))
    roots = sets.select(trees.alias("node"), "doc_id", "minima", F.lit(None).cast("bigint").alias("n"))
    rows = _children(roots.withColumn("path", F.col("node")), 0)
    leaves, used = [], []
    for level in range(1, how.depth + 1):
        rows = written(rows, "nodes")
        # Written first: adaptive execution can split a crowded node of a join, but not above an aggregate.
        sizes = written(rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        sized = written(rows.join(sizes, "node"), "sized")
        removed(rows, sizes)
        used.append(sized)
        small, dense = F.col("n") <= how.small, F.col("n") * 2 > F.col("parent")
        leaf = F.lit(True) if level == how.depth else small | F.coalesce(dense, F.lit(False))
        leaves.append(sized.where(leaf).select("node", "doc_id", "n"))
        large = sized.where(~leaf).select("node", "path", "doc_id", "n")
        if level == how.depth or large.isEmpty():
            break
        ids = sets.join(large.select("doc_id"), "doc_id", "left_semi").select("doc_id", "name")
        deeper = written(_deeper(ids, docs, level, how), "deeper")
        used.append(deeper)
        rows = _children(large.join(deeper, "doc_id"), level)
    found = written(reduce(DataFrame.unionByName, leaves), "leaves")
    removed(*used)
    return found


def _similar(
    sketches: np.ndarray, sizes: np.ndarray, rows: np.ndarray, columns: np.ndarray, how: Similarity
) -> np.ndarray:
    """Estimated similarity of sets to others, zero where it can't reach the threshold.

    Bytes of sketches that are unlike differ in four of their eight bits on the
    average, so the bits that differ tell how many bytes are unlike. A pair is
    out if that is five deviations and one byte below the threshold, by the bytes that
    either set fills: less than one in 10^5 of the pairs at the threshold, for any number of them.
    """
    t = how.percent / 100
    out = np.empty((len(rows), len(columns)), np.float32)
    bits = np.ascontiguousarray(sketches.view(np.uint64).T)
    filled = np.ascontiguousarray(np.packbits(sketches > 0, axis=1).view(np.uint64).T)
    others, filled_others = bits[:, None, columns], filled[:, None, columns]
    for i in range(0, len(rows), 32):
        own = rows[i : i + 32]
        unlike = np.bitwise_count(bits[:, own, None] ^ others).sum(0, dtype=np.uint16)
        either = np.bitwise_count(filled[:, own, None] | filled_others).sum(0, dtype=np.uint16)
        either = np.maximum(1, either).astype(np.float32)
        near = 1 - unlike / (4 * either)
        least = t - np.float32(5 * math.sqrt(t * (1 - t) * 1.25)) / np.sqrt(either) - 1 / either
        out[i : i + 32] = np.where(near < least, 0, np.maximum(near, np.float32(1e-3)))
    a, b = sizes[rows][:, None], sizes[columns]
    out[100 * np.minimum(a, b) < how.percent * np.maximum(a, b)] = 0
    return out


def _forest(likeness: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a spanning forest, the most similar ones (Prim's algorithm)."""
    nearest, to = likeness[0].copy(), np.zeros(len(likeness), np.int64)
    left = np.ones(len(likeness), bool)
    left[0] = False
    out = []
    for _ in range(len(likeness) - 1):
        j = int(np.where(left, nearest, -1).argmax())
        if nearest[j] > 0:
            out.append((int(to[j]), j))
        left[j] = False
        closer = likeness[j] > nearest
        nearest[closer], to[closer] = likeness[j][closer], j
    return out


def _by_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted rows again, with all rows of a node in one batch."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        nodes = table.column("node").to_numpy()
        cut = int(np.searchsorted(nodes, nodes[-1]))
        if cut:
            yield table.slice(0, cut).combine_chunks().to_batches()[0]
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks().to_batches()[0]


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    nodes = batch.column("node").to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(nodes)) + 1
    for i, j in zip(np.append(0, cuts), np.append(cuts, len(nodes)), strict=True):
        if j - i > 1:
            yield int(i), int(j)


def _sketched(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, set sizes and sketches."""
    sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8)
    ids, sizes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "n_shingles"))
    return ids, sizes, sketches.reshape(len(ids), SKETCH)


def _pairs(members: DataFrame, how: Similarity) -> DataFrame:
    """Pairs ``a`` < ``b``: a spanning forest of those of a node whose sketches are alike.

    ``members`` have ``node``, ``doc_id``, ``n_shingles`` and ``sketch``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_node(batches):
            ids, sizes, sketches = _sketched(batch)
            found = [np.zeros((0, 2), np.int64)]
            for i, j in _grouped(batch):
                all_ = np.arange(j - i)
                likeness = _similar(sketches[i:j], sizes[i:j], all_, all_, how)
                found.append(ids[i + np.array(_forest(likeness), np.int64).reshape(-1, 2)])
            pairs = np.sort(np.concatenate(found), axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(x)) for x in pairs.T], ["a", "b"]
            )

    dealt = members.select("node", "doc_id", "n_shingles", "sketch").repartition("node")
    return dealt.sortWithinPartitions("node", "doc_id").mapInArrow(run, "a bigint, b bigint").distinct()


def _doubtful(members: DataFrame, how: Similarity) -> DataFrame:
    """Those ``members`` whose sketch is alike to one of another component of their node.

    ``members`` have ``node``, ``doc_id``, ``component``, ``n_shingles``,
    ``sketch`` and ``side``; in nodes with sides, 0 is compared with 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_node(batches):
            ids, sizes, sketches = _sketched(batch)
            parts, sides = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("component", "side")
            )
            keep = np.zeros(len(ids), bool)
            for i, j in _grouped(batch):
                part, side = parts[i:j], sides[i:j]
                if side[0] >= 0:
                    rows, columns = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                else:
                    kinds, counts = np.unique(part, return_counts=True)
                    rows, columns = np.flatnonzero(part != kinds[counts.argmax()]), np.arange(j - i)
                alike = _similar(sketches[i:j], sizes[i:j], rows, columns, how) > 0
                alike &= part[rows][:, None] != part[columns]
                keep[i + rows[alike.any(1)]] = True
                keep[i + columns[alike.any(0)]] = True
            kept = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(kept) for c in ("node", "doc_id", "component")],
                ["node", "doc_id", "component"],
            )

    dealt = members.select("node", "doc_id", "n_shingles", "sketch", "component", "side")
    dealt = dealt.repartition("node").sortWithinPartitions("node", "doc_id", "side")
    found = dealt.mapInArrow(run, "node bigint, doc_id bigint, component bigint")
    return found.dropDuplicates(["node", "doc_id"])


def _blocks(leaves: DataFrame, how: Similarity) -> DataFrame:
    """Leaves, with those that are still large cut into blocks by a hash of the id.

    The hash is the same in all nodes, so that a group that meets in many of
    them gives the same pairs. A few sets of a large leaf are in all its
    blocks: a group that is much of the leaf is then one component, not one for each block.
    """
    parts = F.ceil(F.col("n") / F.lit(how.small * 4)) * 4
    block = F.pmod(F.xxhash64("doc_id"), parts)
    large = leaves.where(F.col("n") > how.small).select(
        "node", "doc_id", parts.alias("parts"), block.alias("block")
    )
    first = Window.partitionBy("node").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    shared = large.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= SHARED)
    everywhere = shared.select(
        "node", "doc_id", "block",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("other"),
    ).where("other <> block")
    dealt = large.select("node", "doc_id", "block").unionAll(
        everywhere.select("node", "doc_id", F.col("other").alias("block"))
    )
    return leaves.where(F.col("n") <= how.small).select("node", "doc_id").unionAll(
        dealt.select(F.xxhash64("node", "block").alias("node"), "doc_id")
    )


def _across(
    leaves: DataFrame, labelled: DataFrame, how: Similarity
) -> tuple[DataFrame, list[DataFrame]]:
    """Nodes that hold several components; those still large as pairs of blocks; the tables they come from.

    Of a large node only the sets outside its commonest component meet all
    others, block by block.
    """
    members = written(leaves.join(labelled, "doc_id"), "members")
    sizes = members.groupBy("node", "component").agg(F.count("*").alias("rows"))
    mixed = (
        sizes.groupBy("node")
        .agg(
            F.max_by("component", F.struct("rows", "component")).alias("main"),
            F.max("rows").alias("most"),
            F.sum("rows").alias("all"),
        )
        .where("most < all")
    )
    mixed = written(mixed, "mixed")
    told = written(members.join(mixed, "node"), "told")
    small = told.where(F.col("n") <= how.small).select(
        "node", "doc_id", "component", F.lit(-1).alias("side")
    )
    sides = {
        "mine": F.ceil((F.col("all") - F.col("most")) / F.lit(how.block)).cast("bigint"),
        "theirs": F.ceil(F.col("all") / F.lit(how.block)).cast("bigint"),
    }
    large = told.where(F.col("n") > how.small).withColumns(sides)
    large = large.withColumn("hash", F.xxhash64("doc_id", "node"))
    queries = large.where(F.col("component") != F.col("main")).select(
        "node", "doc_id", "component", F.lit(0).alias("side"),
        F.pmod("hash", "mine").alias("i"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("theirs") - 1)).alias("j"),
    )
    against = large.select(
        "node", "doc_id", "component", F.lit(1).alias("side"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("mine") - 1)).alias("i"),
        F.pmod("hash", "theirs").alias("j"),
    )
    tiles = queries.unionByName(against).select(
        F.xxhash64("node", "i", "j").alias("node"), "doc_id", "component", "side"
    )
    return small.unionByName(tiles), [members, mixed, told]


def _sets(ids: DataFrame, docs: DataFrame, names: DataFrame, how: Similarity) -> DataFrame:
    """``doc_id`` and ``set``, the sorted shingle hashes, of the documents in ``ids``; ``names`` tells which set of an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            g, bounds, _ = shingles(batch.column("text"), how.words)
            some = np.flatnonzero(np.diff(bounds))
            if not len(some):
                continue
            full = np.append(bounds[some], len(g))
            sets = pa.ListArray.from_arrays(pa.array(full, pa.int32()), pa.array(_signed(g)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(some)), pa.array(_names(g, full), pa.binary()), sets],
                ["doc_id", "name", "set"],
            )

    found = _among(docs, ids).mapInArrow(run, "doc_id bigint, name binary, set array<bigint>")
    wanted = names.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
    known = found.join(wanted, ["doc_id", "name"], "left_semi").select("doc_id", "set")
    return written(known.dropDuplicates(["doc_id"]), "full_sets")


def _linked(pairs: DataFrame, docs: DataFrame, names: DataFrame, how: Similarity) -> DataFrame:
    """Those pairs whose full sets are similar enough."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    sets = _sets(named, docs, names, how)
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("one")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("set").alias("other")), "b"
    )
    common = F.size(F.array_intersect("one", "other")).cast("bigint")
    union = F.size("one") + F.size("other") - F.col("common")
    found = written(
        both.withColumn("common", common)
        .where(F.col("common") * 100 >= union * F.lit(how.percent))
        .select("a", "b"),
        "linked",
    )
    removed(sets)
    return found


def _common(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many elements each pair of sets shares, counted on bits of the shared elements."""
    n = len(bounds) - 1
    of = np.repeat(np.arange(n), np.diff(bounds))
    found, back, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(counts > 1)
    place = np.full(len(found), -1)
    place[shared] = np.arange(len(shared))
    at = place[back]
    out = np.zeros((n, n), np.int64)
    for low in range(0, len(shared), 4096):  # a bounded number of elements at a time
        width = min(4096, len(shared) - low)
        here = (at >= low) & (at < low + width)
        cells = np.zeros((n, -(-width // 64) * 64), np.uint8)
        cells[of[here], at[here] - low] = 1
        bits = np.ascontiguousarray(np.packbits(cells, axis=1).view(np.uint64).T)
        for i in range(n):
            out[i] += np.bitwise_count(bits & bits[:, i, None]).sum(0, dtype=np.int64)
    return out


def _joined(tiles: DataFrame, sets: DataFrame, how: Similarity) -> DataFrame:
    """Links between components of a tile, no more than connect them, confirmed on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_node(batches):
            nodes, ids, parts = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "doc_id", "component")
            )
            cuts = np.flatnonzero(np.diff(nodes)) + 1
            a, b = [], []
            for i, j in zip(np.append(0, cuts), np.append(cuts, len(ids)), strict=True):
                own = batch.column("set").slice(i, j - i)
                sizes = pa.compute.list_value_length(own).to_numpy(zero_copy_only=False)
                common = _common(own.flatten().to_numpy(), np.append(0, np.cumsum(sizes)))
                union = sizes[:, None] + sizes - common
                close = (common * 100 >= union * how.percent) & (
                    parts[i:j][:, None] != parts[i:j]
                )
                for x, y in _forest(close.astype(np.float32)):
                    a.append(ids[i + x])
                    b.append(ids[i + y])
            x, y = np.array(a, np.int64), np.array(b, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"]
            )

    whole = tiles.join(sets, "doc_id").select("node", "doc_id", "component", "set")
    dealt = whole.repartition("node").sortWithinPartitions("node", "doc_id")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, how: Similarity = Similarity(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Texts with equal sets are one class, named by its smallest id; only classes
    are joined. Candidate pairs of a node are a spanning forest at first, which
    is enough where all of them hold. Where a node's classes are not all
    connected by then, the sets of those that are alike to another component
    come together and are compared in full, and again only links that connect
    are written. So no group's pairs are ever written, and of the pairs of a leaf that
    could change a component, those are left out whose sketches are too unlike by chance,
    less than one in 10^5.

    ``component_id`` is the smallest id reachable over links, and ``kept`` says
    that it is the row's own. A null text is empty; a text without words is
    linked with nothing. Rows without an id take part only as copies of others:
    they get the component of rows with an equal set, if there are any, and
    else null, and then they are kept. Rows that repeat an id are one document,
    linked by copies of any of its sets, and compared by one of them, the one whose
    name is smallest. Ids must be integers, or text that names one. Other columns are not read.
    """
    return _placed(docs, how, key, text).drop("digest")


def _placed(docs: DataFrame, how: Similarity, key: str, text: str) -> DataFrame:
    """The rows of ``near_duplicates``, with the ``digest`` of the row's text."""
    rows = docs.select(
        F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    ).withColumn("digest", F.xxhash64("text"))
    found = written(signatures(rows, how), "signatures")
    classes = (
        found.where("name IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("rep"))
    )
    classes = written(classes, "classes")
    reps = classes.where("rep IS NOT NULL")
    # An id with several sets is compared by the one with the smallest name.
    reps = reps.groupBy("rep").agg(F.min("name").alias("name")).withColumnRenamed("rep", "doc_id")
    sets = (
        found.join(reps, ["name", "doc_id"], "left_semi")
        .select("doc_id", "name", "n_shingles", "minima", "sketch")
        .dropDuplicates(["doc_id"])
    )
    sets = written(sets, "sets")
    names = sets.select("doc_id", "name")
    leaves = _leaves(sets, rows, how)
    told = sets.select("doc_id", "n_shingles", "sketch")

    alone = _blocks(leaves, how).join(told, "doc_id")
    pairs = written(_pairs(alone, how), "pairs")
    links = _linked(pairs, rows, names, how)
    removed(pairs)
    parts = written(components(links), "components")

    label = F.coalesce("component", "doc_id").alias("component")
    members = leaves.select("doc_id").distinct()
    labelled = members.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", label
    )
    across, used = _across(leaves, labelled, how)
    tiles = written(_doubtful(across.join(told, "doc_id"), how), "tiles")
    removed(*used)
    full = _sets(tiles, rows, names, how)
    links = links.unionByName(written(_joined(tiles, full, how), "linked"))
    removed(full)
    parts = written(components(links), "components")

    placed = classes.join(parts.withColumnRenamed("id", "rep"), "rep", "left").select(
        "name", F.coalesce("component", "rep").alias("component_id")
    )
    own = F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        found.select("doc_id", "digest", "n_shingles", "name")
        .join(placed, "name", "left")
        .select("doc_id", "digest", "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_duplicates(
    docs: DataFrame, how: Similarity = Similarity(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; rows without an id stay."""
    found = _placed(docs, how, key, text)
    # An id may stand for several texts, of which only some are copies.
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("gone"), "digest").distinct()
    same = F.xxhash64(docs[text].cast("string")) == gone["digest"]
    return docs.join(gone, (docs[key].cast("bigint") == gone["gone"]) & same, "left_anti")
