"""Mixing sources to target weights by fixed-length blocks.

The words of a source, document after document, are cut into blocks of a fixed
length. Output shards draw their blocks' sources from a multinomial
distribution, the slots of a source are mapped to its blocks by a pseudorandom
permutation of block numbers, and blocks are joined by number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.llm.scratch import written
from farelake.llm.words import U64, chunks, mix

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Blocks have ``block_words`` words and shards ``shard_blocks`` blocks; ``most`` epochs of a source."""

    block_words: int = 256
    shard_blocks: int = 1024
    most: float = 3.0
    seed: int = 17


def cycling_weights(sources: Sequence[str | None]) -> list[float]:
    """1, 2, 3, 1, 2, 3 and so on."""
    return [1.0 + i % 3 for i in range(len(sources))]


def targets(sizes: Sequence[int], weights: Sequence[float], most: float) -> list[float]:
    """Shares of all sizes by weight, none above ``most`` times its size; the excess goes to the others."""
    out = [0.0] * len(sizes)
    left, open_ = float(sum(sizes)), set(range(len(sizes)))
    while open_:
        weight = sum(weights[i] for i in open_)
        if weight <= 0:
            break
        full = [i for i in sorted(open_) if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = most * sizes[i]
            open_.remove(i)
        left = max(0.0, left - sum(out[i] for i in full))
    return out


def _permuted(x: np.ndarray, n: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """Place of each index ``x`` below ``n`` in the permutation that ``key`` names; ``back``: the index at a place.

    A Feistel network permutes the numbers below a power of four; a number that
    lands at ``n`` or above is sent through again, so it walks along its cycle
    until it is below ``n``. Backwards it walks the same cycle the other way.
    """
    half = np.ones(len(x), np.uint64)
    while (small := (U64(1) << (half * U64(2))) < n).any():
        half[small] += U64(1)
    low = (U64(1) << half) - U64(1)
    out = x.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        a, b = out[todo] >> half[todo], out[todo] & low[todo]
        for turn in (3, 2, 1, 0) if back else (0, 1, 2, 3):
            if back:
                a, b = b ^ (mix(a ^ mix(key[todo] + U64(turn))) & low[todo]), a
            else:
                a, b = b, a ^ (mix(b ^ mix(key[todo] + U64(turn))) & low[todo])
        out[todo] = (a << half[todo]) | b
        todo = todo[out[todo] >= n[todo]]
    return out


def _slots_for(words: int, size: int, block: int, tail_at: Callable[[int], int]) -> tuple[int, int]:
    """Slots that hold ``words`` words of a source of ``size`` words, and the words of the last slot."""
    if words <= 0 or size <= 0:
        return 0, 0
    blocks = -(-size // block)
    tail = size - (blocks - 1) * block
    epochs, rest = divmod(words, size)
    if not rest:
        slots, last = epochs * blocks, epochs - 1
        return slots, tail if tail_at(last) == blocks - 1 else block
    place = tail_at(epochs)
    if rest <= place * block:
        m = -(-rest // block)
        return epochs * blocks + m, rest - (m - 1) * block
    if rest <= place * block + tail:
        return epochs * blocks + place + 1, rest - place * block
    after = rest - place * block - tail
    m = -(-after // block)
    return epochs * blocks + place + 1 + m, after - (m - 1) * block


def _key(seed: int, source: np.ndarray, epoch: np.ndarray) -> np.ndarray:
    return mix(mix(source.astype(np.uint64) + U64(seed)) + epoch.astype(np.uint64))


def _tail_place(n: int, source: int, seed: int) -> Callable[[int], int]:
    """In which slot of an epoch the last block of a source comes."""

    def find(epoch: int) -> int:
        key = _key(seed, np.array([source]), np.array([epoch]))
        last, all_ = np.array([n - 1], np.uint64), np.array([n], np.uint64)
        return int(_permuted(last, all_, key, back=True)[0])

    return find


#: Runs of shards, and numbers about them, that the driver holds.
CHUNKS, NUMBERS = 4096, 1 << 22


@dataclass(frozen=True)
class Shards:
    """How many slots each shard has of each source, shard by shard.

    Each shard draws from a multinomial distribution, from a seed of its own. The
    sums of all draws then miss the wanted ``slots`` by a little: of a source
    drawn too often, shards give up places, in the proportion they hold it,
    and these go to the sources drawn too seldom. All depends on sums over the
    shards before, which are kept for runs of shards only.
    """

    slots: tuple[int, ...]
    shard_blocks: int
    seed: int

    @property
    def total(self) -> int:
        return sum(self.slots)

    @property
    def number(self) -> int:
        return -(-self.total // self.shard_blocks)

    @property
    def run(self) -> int:
        """Shards in a run."""
        runs = max(1, min(CHUNKS, NUMBERS // max(1, len(self.slots))))
        return max(1, -(-self.number // runs))

    @property
    def runs(self) -> int:
        return -(-self.number // self.run)

    def drawn(self, run: int) -> np.ndarray:
        """A row of counts for each shard of a run, as they were drawn."""
        shards = np.arange(run * self.run, min(self.number, (run + 1) * self.run))
        share = np.array(self.slots, float) / self.total
        size, more = divmod(self.total, self.number)
        return np.stack(
            [
                np.random.Generator(np.random.PCG64([self.seed, int(i)])).multinomial(
                    size + (i < more), share
                )
                for i in shards
            ]
        ).astype(np.int64)

    def settled(self, run: int, before: np.ndarray, held: np.ndarray) -> np.ndarray:
        """The counts of a run's shards after the exchange.

        ``before``: what the shards before have drawn of each source; ``held``:
        what all have.
        """
        counts = self.drawn(run)
        upto = before + np.cumsum(counts, 0)
        over = held - np.array(self.slots)
        givers, takers = np.flatnonzero(over > 0), np.flatnonzero(over < 0)
        if not len(givers):
            return counts
        edges = np.concatenate((before[None], upto))[:, givers]
        given = _share(edges, over[givers], held[givers])
        counts[:, givers] -= np.diff(given, axis=0)
        # Free places are numbered over all shards, scattered, and dealt out by what is missing.
        free = given.sum(1)
        places = np.arange(free[0], free[-1], dtype=np.uint64)
        all_ = np.full(len(places), int(over[givers].sum()), np.uint64)
        key = np.full(len(places), mix(np.array([self.seed], np.uint64))[0])
        scattered = _permuted(places, all_, key)
        to = takers[np.searchsorted(np.cumsum(-over[takers]), scattered.astype(np.int64), "right")]
        shard = np.repeat(np.arange(len(counts)), np.diff(free))
        np.add.at(counts, (shard, to), 1)
        return counts


def _share(part: np.ndarray, over: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """``part`` * ``over`` / ``whole``, rounded down."""
    if int(part.max(initial=0)) * int(over.max(initial=0)) < 2**62:
        return part * over // whole
    return (part.astype(object) * over.astype(object) // whole.astype(object)).astype(np.int64)


def _by_run(spark: SparkSession, shards: Shards, count: Callable[[int], np.ndarray]) -> np.ndarray:
    """What tasks count over all shards of each run, a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("id").to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i]), pa.array([count(i).sum(0)], pa.list_(pa.int64()))], ["run", "n"]
                )

    rows = _runs(spark, shards).mapInArrow(run, "run bigint, n array<bigint>").collect()
    return np.array([r.n for r in sorted(rows)], np.int64).reshape(shards.runs, len(shards.slots))


def _runs(spark: SparkSession, shards: Shards) -> DataFrame:
    return spark.range(0, shards.runs, 1, max(1, shards.runs))


def _before(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts, 0) - counts


def _ordered(rows: DataFrame) -> DataFrame:
    """Each row with its place in the word stream of its source, ``start``.

    Rows are sorted by source and id into partitions of even size, so a source
    with most rows fills many of them. Word counts are summed up inside each
    partition; the sums of a source's partitions are added up apart.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "size", "row"]
    dealt = rows.repartitionByRange(parts, "source_ix", *order)
    sized = written(dealt.withColumn("part", F.spark_partition_id()), "ordered")
    inside = Window.partitionBy("part", "source_ix").orderBy(*order)
    before = Window.partitionBy("source_ix").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sized.groupBy("source_ix", "part").agg(F.sum("size").alias("words"))
    offsets = sums.select(
        "source_ix", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")
    )
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        sized.withColumn("upto", upto)
        .join(offsets, ["source_ix", "part"])
        .withColumn("start", F.col("offset") + F.col("upto") - F.col("size"))
        .drop("part", "upto", "offset")
    )


@dataclass(frozen=True)
class Plan:
    """What a mix takes of each source: one row per source, in order of the sources."""

    sources: tuple[str | None, ...]
    sizes: tuple[int, ...]
    targets: tuple[float, ...]
    slots: tuple[int, ...]
    last: tuple[int, ...]


def plan_mix(
    sized: DataFrame, how: Mix, weigh: Callable[[Sequence[str | None]], Sequence[float]]
) -> Plan:
    """Targets and slots of the sources of ``sized`` (``source``, ``size``), by code point, null last.

    One row per source comes to the driver; what is found out there takes the
    same time for any number of blocks.
    """
    rows = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("size"))
        .orderBy(F.col("source").asc_nulls_last())
        .collect()
    )
    sources, sizes = tuple(r.source for r in rows), tuple(int(r["size"]) for r in rows)
    wanted = targets(sizes, weigh(sources), how.most)
    slots = [
        _slots_for(
            min(round(t), int(how.most * size)),
            size,
            how.block_words,
            _tail_place(-(-size // how.block_words), i, how.seed),
        )
        for i, (t, size) in enumerate(zip(wanted, sizes, strict=True))
    ]
    return Plan(sources, sizes, tuple(wanted), tuple(s for s, _ in slots), tuple(w for _, w in slots))


def _filled(spark: SparkSession, plan: Plan, how: Mix) -> DataFrame:
    """``shard``, ``slot``, ``source_ix``, ``block``, ``filled``: which block fills each slot.

    Tasks draw the shards' counts, twice to add them up over runs of shards,
    and once more to make the slots.
    """
    schema = "shard bigint, slot int, source_ix int, block bigint, filled int"
    shards = Shards(plan.slots, how.shard_blocks, how.seed)
    if not shards.total:
        return spark.createDataFrame([], schema)
    drawn = _by_run(spark, shards, shards.drawn)
    drawn_before, held = _before(drawn), drawn.sum(0)
    settled = _by_run(spark, shards, lambda i: shards.settled(i, drawn_before[i], held))
    settled_before = _before(settled)
    blocks = np.array([-(-s // how.block_words) for s in plan.sizes], np.int64)
    tails = np.array(plan.sizes, np.int64) - (blocks - 1) * how.block_words
    slots, last = np.array(plan.slots, np.int64), np.array(plan.last, np.int64)

    def of_shard(shard: int, own: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
        source = np.repeat(np.arange(len(own)), own)
        rank = np.arange(len(source)) - np.repeat(np.cumsum(own) - own, own)
        k = rank + first[source]
        n = blocks[source]
        key = _key(how.seed, source, k // n)
        block = _permuted((k % n).astype(np.uint64), n.astype(np.uint64), key).astype(np.int64)
        words = np.where(block == n - 1, tails[source], how.block_words)
        words = np.where(k == slots[source] - 1, last[source], words)
        # Sources are spread over the shard by another permutation.
        total = np.full(len(k), len(k), np.uint64)
        own_key = mix(np.array([shard + how.seed], np.uint64))[0]
        slot = _permuted(np.arange(len(k), dtype=np.uint64), total, np.full(len(k), own_key))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(k), shard, np.int64)),
                pa.array(slot.astype(np.int32)),
                pa.array(source.astype(np.int32)),
                pa.array(block),
                pa.array(words.astype(np.int32)),
            ],
            ["shard", "slot", "source_ix", "block", "filled"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("id").to_pylist():
                counts = shards.settled(i, drawn_before[i], held)
                first = settled_before[i] + _before(counts)
                for j, own in enumerate(counts):
                    yield of_shard(i * shards.run + j, own, first[j])

    return _runs(spark, shards).mapInArrow(run, schema)


def _pieces(placed: DataFrame, block: int) -> DataFrame:
    """The runs of words that documents have in the blocks of their source.

    ``at`` is where in its block a run begins, ``doc_from`` where in its
    document, whose words begin at ``place`` in those of the source.
    """
    id_type = placed.schema["doc_id"].dataType.simpleString()
    fields = (
        f"source_ix int, block bigint, doc_id {id_type}, row bigint, "
        "place bigint, doc_from bigint, at int, words int"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = batch.column("start").to_numpy(zero_copy_only=False)
            end = start + batch.column("size").to_numpy(zero_copy_only=False)
            first, last = start // block, (end - 1) // block
            n = np.where(end > start, last - first + 1, 0)
            of = np.repeat(np.arange(len(n)), n)
            number = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            low = np.maximum(start[of], number * block)
            high = np.minimum(end[of], (number + 1) * block)
            own = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("source_ix").take(own),
                    pa.array(number),
                    batch.column("doc_id").take(own),
                    batch.column("row").take(own),
                    pa.array(start[of]),
                    pa.array(low - start[of]),
                    pa.array((low - number * block).astype(np.int32)),
                    pa.array((high - low).astype(np.int32)),
                ],
                ["source_ix", "block", "doc_id", "row", "place", "doc_from", "at", "words"],
            )

    return placed.select("source_ix", "doc_id", "row", "size", "start").mapInArrow(run, fields)


#: Fields of a run, with their types.
_RUN = {
    "shard": "bigint", "slot": "int", "source_ix": "int", "block": "bigint",
    "at": "int", "place": "bigint", "doc_from": "bigint", "words": "int",
}


def _worded(pieces: DataFrame, rows: DataFrame, once: bool) -> DataFrame:
    """``pieces`` with the ``text`` of each run.

    A document's runs, as many as its words at most, go to its text, so each
    text is moved once. Rows that share id and text have their runs together;
    unless there are none such (``once``), one of them is kept to read from.
    """
    lists = pieces.groupBy("doc_id", "row").agg(F.collect_list(F.struct(*_RUN)).alias("runs"))
    lists = lists.withColumnsRenamed({"doc_id": "of", "row": "of_row"})
    texts = rows if once else rows.dropDuplicates(["doc_id", "row"])
    same = F.equal_null(texts["doc_id"], lists["of"]) & F.equal_null(texts["row"], lists["of_row"])
    joined = texts.join(lists, same).select("doc_id", "row", "text", "runs")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    kinds = ", ".join(f"{n} {kind}" for n, kind in _RUN.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            own, of, out = batch.column("runs"), [], []
            for i, (body, runs) in enumerate(
                zip(batch.column("text").to_pylist(), own.to_pylist(), strict=True)
            ):
                words = (body or "").encode().split()
                for r in runs:
                    out.append(b" ".join(words[r["doc_from"] : r["doc_from"] + r["words"]]))
                of += [i] * len(runs)
            flat = own.flatten()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(of, pa.int64())),
                    *(flat.field(n) for n in _RUN),
                    pa.array(out, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", *_RUN, "text"],
            )

    return joined.mapInArrow(run, f"doc_id {id_type}, {kinds}, text string")


@dataclass(frozen=True)
class Mixed:
    """``documents``: a row per document; ``pieces``: its runs of words in the slots of the mix.

    Both have ``source_ix``, and ``place``, where in its source a document's words
    begin: no two documents with words share both.
    """

    documents: DataFrame
    pieces: DataFrame
    plan: Plan


def mix_sources(
    docs: DataFrame,
    how: Mix = Mix(),
    weigh: Callable[[Sequence[str | None]], Sequence[float]] = cycling_weights,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    with_text: bool = True,
) -> Mixed:
    """Mix the words of ``docs`` so that each source has its target share.

    ``documents`` has ``doc_id``, ``size``, ``source_size`` and ``target`` of
    every row; ``pieces`` has ``shard``, ``slot``, ``source``, ``block``,
    ``at`` (where in the slot), ``doc_id``, ``doc_from`` (where in the
    document), ``words`` (how many) and, if wanted, ``text``. The targets are
    met to the word, and no source is read more than ``how.most`` times. Reruns
    agree.

    A null or empty text has no words and so no piece; rows without a source
    are a source of their own. Rows without an id, and rows that repeat an id,
    each take their own place. Ids may be of any type that can be ordered, and
    keep it. Other columns are not read. Empty tables give empty results.
    """
    spark = docs.sparkSession
    body = F.col(text).cast("string")
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(body, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64(body).alias("row"),
        body.alias("text"),
    )
    sized = written(rows.drop("text"), "sizes")
    plan = plan_mix(sized, how, weigh)
    names = spark.createDataFrame(
        [
            (i, *x)
            for i, x in enumerate(zip(plan.sources, plan.sizes, plan.targets, strict=True))
        ],
        "source_ix int, source string, source_size bigint, target double",
    )
    same = F.equal_null(sized["source"], names["source"])
    numbered = sized.join(names, same).select("doc_id", "size", "row", "source_ix")
    placed = _ordered(numbered)
    slots = _filled(spark, plan, how)
    taken = F.least("words", F.col("filled") - F.col("at"))
    pieces = (
        _pieces(placed, how.block_words)
        .join(slots.hint("merge"), ["source_ix", "block"])  # its rows are made by tasks: no estimate holds
        .withColumn("words", taken)
        .where("words > 0")
        .drop("filled")
    )
    if with_text:
        again = sized.where("size > 0").groupBy("doc_id", "row").agg(F.count("*").alias("n"))
        once = again.where("n > 1").isEmpty()
        pieces = _worded(pieces, rows.where("size > 0").select("doc_id", "row", "text"), once)
    pieces = pieces.join(names.select("source_ix", "source"), "source_ix")
    documents = placed.join(names, "source_ix").select(
        "doc_id", "size", "source_size", "target", "source_ix", F.col("start").alias("place")
    )
    return Mixed(documents, pieces, plan)


def mixed_blocks(mixed: Mixed) -> DataFrame:
    """One row per slot: ``shard``, ``slot``, ``source``, ``block``, ``n_words``, ``doc_ids``, ``text``.

    A slot has a block's words at most, so what is gathered in a row is bounded.
    """
    run = F.struct("at", "doc_id", "words", "text")
    ordered = F.array_sort(F.collect_list(run))
    rows = mixed.pieces.groupBy("shard", "slot", "source", "block").agg(ordered.alias("runs"))
    return rows.select(
        "shard",
        "slot",
        "source",
        "block",
        F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + r["words"]).alias("n_words"),
        F.col("runs.doc_id").alias("doc_ids"),
        F.array_join("runs.text", " ").alias("text"),
    )


def taken_by_document(mixed: Mixed) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` of every document.

    ``taken`` counts the words that the mix takes of that row, repeats included;
    rows that share an id, or have none, have counts of their own.
    """
    taken = mixed.pieces.groupBy("source_ix", "place").agg(F.sum("words").alias("taken"))
    # A document without words begins where the next one does.
    place = F.when(F.col("size") > 0, F.col("place"))
    rows = mixed.documents.withColumn("place", place)
    return rows.join(taken, ["source_ix", "place"], "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
    )
