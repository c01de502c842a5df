"""Phrases whose words keep together, counted in suffix subtrees built group by group.

Prefixes of suffixes are grouped so that a group's suffixes fit a memory
budget; a prefix beyond it is extended by its next word. Each task builds the
subtrees of its own texts, cut off at the depth of the longest phrase, and
sends them to their groups. A group merges what it gets, apart from all others,
and reads the counts of phrases from the totals of the leaves below them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.llm.scratch import written
from farelake.llm.words import FIRST, LOWER, U64, Words, chunks, mix, text_buffer

#: Text whose words or suffixes a task adds up before it sends them, in bytes.
CHUNK = 4 << 20
#: Text that a task takes apart at once to find suffixes; what it holds of a chunk is their hashes only.
PART = 1 << 20
#: Hash functions that are tried until no two words share a hash.
TRIES = 8
#: Parts of a language whose best phrases are found first.
PARTS = 16
#: Prefixes are weighed in this many bins, as a power of two, by their first word.
BINS = 14

# Marks that part pieces, and blanks that part the words of a piece.
_MARK = np.zeros(256, bool)
_MARK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_MARK
_WORD[[0x20, 0x09]] = False


@dataclass(frozen=True)
class Phrases:
    """Phrases of 2 to ``longest`` words that occur ``least`` times; ``top`` of each language.

    A phrase is dropped if a longer one around it occurs at least ``covered``
    percent as often. ``budget`` is the number of suffixes in a group.
    ``hash_bits`` is for tests of words that share a hash.
    """

    longest: int = 3
    least: int = 10
    covered: int = 50
    top: int = 2000
    budget: int = 1 << 19
    filter_bits: int = 26
    hash_bits: int = 64

    def __post_init__(self) -> None:
        if self.longest < 2 or self.least < 1 or self.budget < 1:
            raise ValueError("phrases have two words or more, and occur once or more")


class _Pieces(Words):
    """Words in lower case, and how many of a piece are left from each word on."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = text_buffer(column)
        self.data = LOWER[self.data]
        word = _WORD[self.data]
        inner = self.offsets[(self.offsets > 0) & (self.offsets < len(word))]
        edge = np.zeros(len(word) + 1, bool)
        edge[inner] = True
        starts, ends = word.copy(), word.copy()
        starts[1:] &= ~word[:-1] | edge[1:-1]
        ends[:-1] &= ~word[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        marks = np.searchsorted(np.flatnonzero(_MARK[self.data]), self.starts)
        last = np.ones(len(self.starts), bool)  # of its piece
        last[:-1] = (marks[1:] != marks[:-1]) | (self.doc[1:] != self.doc[:-1])
        at = np.flatnonzero(last)
        self.left = at[np.searchsorted(at, np.arange(len(last)))] - np.arange(len(last)) + 1

    def named(self, langs: pa.Array, how: Phrases, seed: int) -> np.ndarray:
        """A hash of each word together with its text's language; never zero."""
        codes = langs.dictionary_encode()
        of_lang = np.array(
            [_of_language(lang, seed) for lang in codes.dictionary.to_pylist()], np.uint64
        )
        h = self.hashes(seed) ^ of_lang[codes.indices.to_numpy()][self.doc]
        return np.maximum(mix(h) >> U64(64 - how.hash_bits), U64(1))

    def alike(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words at some places are, byte for byte, those at others."""
        rest = self.ends[a] - self.starts[a]
        out = rest == self.ends[b] - self.starts[b]
        padded = np.concatenate((self.data, np.zeros(8, np.uint8)))
        eights = np.ndarray(len(self.data) + 1, np.uint64, padded, strides=(1,))
        left, x, y, rest = np.flatnonzero(out), self.starts[a][out], self.starts[b][out], rest[out]
        while len(left):
            differ = (eights[x] ^ eights[y]) & FIRST[np.minimum(rest, 8)]
            out[left[differ != 0]] = False
            more = np.flatnonzero(rest > 8)
            left, x, y, rest = left[more], x[more] + 8, y[more] + 8, rest[more] - 8
        return out

    def spelled(self, at: np.ndarray) -> pa.Array:
        """The bytes of the words at some places."""
        sizes = self.ends[at] - self.starts[at]
        offsets = np.append(0, np.cumsum(sizes))
        places = np.arange(offsets[-1]) + np.repeat(self.starts[at] - offsets[:-1], sizes)
        data = np.ascontiguousarray(self.data[places])
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        ).cast(pa.binary())


def _of_language(lang: str, seed: int) -> int:
    digest = hashlib.blake2b(lang.encode(), digest_size=8, salt=seed.to_bytes(8, "little"))
    return int.from_bytes(digest.digest(), "little")


def _words(docs: DataFrame, how: Phrases, seed: int) -> DataFrame:
    """``hash``, ``lang``, ``word``, ``n`` of words that occur often enough, and ``words`` that share the hash.

    Words that share a hash with another are there however often they occur. A
    row without a word has the number of all words of a language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=CHUNK):
            words = _Pieces(batch.column("text"))
            langs = batch.column("lang")
            h = words.named(langs, how, seed)
            found, first, inverse, n = np.unique(
                h, return_index=True, return_inverse=True, return_counts=True
            )
            codes = langs.dictionary_encode()
            lang_of = codes.indices.to_numpy()[words.doc]
            totals = np.bincount(lang_of, minlength=len(codes.dictionary))
            # Other words under the hash of the first are told of beside it.
            same = first[inverse]
            every = np.arange(len(h))
            others = np.flatnonzero((lang_of != lang_of[same]) | ~words.alike(every, same))
            found, first = np.append(found, h[others]), np.append(first, others)
            n = np.append(n, np.zeros(len(others), np.int64))
            names = codes.dictionary.to_pylist()
            hashes = np.array([_of_language(lang, seed) for lang in names], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(found, hashes).view(np.int64)),
                    pa.concat_arrays([langs.take(pa.array(words.doc[first])), codes.dictionary]),
                    pa.concat_arrays([words.spelled(first), pa.nulls(len(names), pa.binary())]),
                    pa.array(np.append(n, totals)),
                ],
                ["hash", "lang", "word", "n"],
            )

    counted = docs.mapInArrow(run, "hash bigint, lang string, word binary, n bigint")
    # Tasks have added up their own; a hash meets in one place, with all words that have it.
    sums = counted.repartition("hash").groupBy("hash", "lang", "word").agg(F.sum("n").alias("n"))
    total_of = F.when(F.col("word").isNull(), F.col("lang")).alias("total_of")
    by_hash = sums.groupBy("hash", total_of).agg(
        F.min_by("lang", F.struct("lang", "word")).alias("lang"),
        F.min("word").alias("word"),
        F.sum("n").alias("n"),
        F.count("word").alias("words"),
    )
    often = (F.col("n") >= how.least) | (F.col("words") != 1)
    return written(by_hash.where(often).drop("total_of"), "words")


def _told_apart(docs: DataFrame, how: Phrases) -> tuple[DataFrame, int]:
    """The words, and a hash function under which no two words of the corpus share a hash."""
    for seed in range(TRIES):
        words = _words(docs, how, seed)
        if words.where(F.col("words") > 1).isEmpty():
            return words.drop("words"), seed
    raise RuntimeError(f"words share a hash under each of {TRIES} functions")


def _passing(words: DataFrame, how: Phrases) -> np.ndarray:
    """One bit for each hash of a word that occurs often enough, and of some others.

    Sixteen bits a word, up to 2 ** ``filter_bits`` in all: a fuller bitmap
    lets more words through that are then counted, and loses none.
    """
    n = words.count()
    bits = int(min(how.filter_bits, max(15, (16 * n).bit_length())))
    bit = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1)) + 1
    parts = (
        words.groupBy(F.bitmap_bucket_number(bit).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()
    )
    out = np.zeros((1 << bits) // 8, np.uint8)
    for p in parts:
        own = np.frombuffer(bytes(p.bits), np.uint8)
        out[(p.part - 1) * len(own) : p.part * len(own)] = own[: len(out)]
    return out


def _grouped(words: DataFrame, how: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """For each bin of first words its group, and the number of groups it is dealt to by the next word.

    Bins are packed, in order, into groups of at most ``budget`` suffixes; a
    bin beyond that is extended: its suffixes are told apart by their next word.
    """
    weights = np.zeros(1 << BINS, np.int64)
    by_bin = words.groupBy(F.shiftrightunsigned("hash", 64 - BINS).alias("bin"))
    for r in by_bin.agg(F.sum("n").alias("n")).collect():
        weights[r.bin] = r.n
    group, parts = np.zeros(len(weights), np.int64), np.ones(len(weights), np.int64)
    current, room = 0, how.budget
    for i, weight in enumerate(weights.tolist()):
        if weight > how.budget:
            parts[i] = -(-weight // how.budget)
            if room < how.budget:
                current += 1
            group[i], current, room = current, current + int(parts[i]), how.budget
            continue
        if weight > room:
            current, room = current + 1, how.budget
        group[i] = current
        room -= weight
    return group, parts


def _combined(levels: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Suffixes in order, equal ones as one with their sum."""
    if not len(n):
        return levels, n
    order = np.lexsort(levels[::-1])
    levels, n = [x[order] for x in levels], n[order]
    first = np.append(True, reduce(np.logical_or, (x[1:] != x[:-1] for x in levels)))
    at = np.flatnonzero(first)
    return [x[at] for x in levels], np.add.reduceat(n, at)


def _starts(levels: list[np.ndarray]) -> list[np.ndarray]:
    """Per level, the rows at which a node of the subtree starts."""
    out, new = [], np.zeros(len(levels[0]), bool)
    new[:1] = True
    for x in levels:
        new = new.copy()
        new[1:] |= x[1:] != x[:-1]
        out.append(np.flatnonzero(new))
    return out


def _packed(levels: list[np.ndarray], n: np.ndarray) -> bytes:
    """A subtree: per level its nodes' words and numbers of children, of which leaves have counts."""
    starts = _starts(levels)
    parts = [np.array([len(s) for s in starts], np.int64)]
    for x, own, below in zip(levels, starts, [*starts[1:], None], strict=True):
        edges = np.searchsorted(below, np.append(own, len(n))) if below is not None else None
        parts += [x[own], (np.diff(edges) if edges is not None else n).astype(np.uint32)]
    return b"".join(p.tobytes() for p in parts)


def _unpacked(block: bytes, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    sizes = np.frombuffer(block, np.int64, depth)
    at, nodes = 8 * depth, []
    for size in sizes.tolist():
        words = np.frombuffer(block, np.uint64, size, at)
        at += 8 * size
        nodes.append((words, np.frombuffer(block, np.uint32, size, at)))
        at += 4 * size
    levels, counts = [], nodes[-1][1].astype(np.int64)
    for level in range(depth):
        x = nodes[level][0]
        for below in range(level, depth - 1):
            x = np.repeat(x, nodes[below][1])
        levels.append(x)
    return levels, counts


def _subtrees(
    docs: DataFrame,
    how: Phrases,
    seed: int,
    passing: np.ndarray,
    grouped: tuple[np.ndarray, np.ndarray],
) -> DataFrame:
    """``group``, ``block``: the subtrees that the texts of a chunk give to each group.

    A suffix ends with its piece, or before a word that does not occur often
    enough, since no phrase with that word does.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((passing, *grouped))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, group, parts = shared.value
        low = U64(8 * len(bitmap) - 1)

        def suffixes(batch: pa.RecordBatch) -> tuple[int, list[np.ndarray]]:
            """The bytes of some texts, and the group and the words of each of their suffixes."""
            words = _Pieces(batch.column("text"))
            h = words.named(batch.column("lang"), how, seed)
            bit = (h & low).astype(np.int64)
            often = (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            follows = np.zeros(len(h), bool)
            follows[:-1] = often[1:] & (words.left[:-1] > 1)
            at = np.flatnonzero(often & follows)
            levels = [h[at], h[at + 1]]
            going = np.ones(len(at), bool)
            for i in range(2, how.longest):
                going = going & follows[np.minimum(at + i - 1, len(h) - 1)]
                levels.append(np.where(going, h[np.minimum(at + i, len(h) - 1)], U64(0)))
                at = np.where(going, at, 0)
            bins = (levels[0] >> U64(64 - BINS)).astype(np.int64)
            of = group[bins] + (mix(levels[1]) % parts[bins].astype(np.uint64)).astype(np.int64)
            return len(words.data), [of, *levels]

        def subtrees(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            held.clear()
            (of, *levels), n = _combined(columns, np.ones(len(columns[0]), np.int64))
            del columns
            if not len(n):
                return
            bounds = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            blocks = [
                _packed([x[s:e] for x in levels], n[s:e])
                for s, e in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(of[bounds[:-1]]), pa.array(blocks, pa.binary())], ["group", "block"]
            )

        held, size = [], 0
        for batch in chunks(batches, limit=min(PART, CHUNK)):
            more, found = suffixes(batch)
            held.append(found)
            size += more
            if size >= CHUNK:
                yield from subtrees(held)
                size = 0
        if held:
            yield from subtrees(held)

    return docs.mapInArrow(run, "group bigint, block binary")


def _counted(blocks: DataFrame, how: Phrases) -> DataFrame:
    """``key`` (hashes of words) and ``n`` of the phrases that occur often enough."""
    depth, least = how.longest, how.least

    def merge(table: pa.Table) -> pa.Table:
        each = [_unpacked(b, depth) for b in table["block"].to_pylist()]
        levels = [np.concatenate([x[i] for x, _ in each]) for i in range(depth)]
        levels, n = _combined(levels, np.concatenate([c for _, c in each]))
        keys, totals = [], []
        for size, starts in zip(range(2, depth + 1), _starts(levels)[1:], strict=True):
            sums = np.add.reduceat(n, starts)
            kept = (sums >= least) & (levels[size - 1][starts] != 0)
            flat = np.stack([x[starts[kept]] for x in levels[:size]], axis=1).reshape(-1)
            keys.append(
                pa.ListArray.from_arrays(
                    pa.array(np.arange(0, len(flat) + 1, size, np.int32)),
                    pa.array(flat.view(np.int64)),
                )
            )
            totals.append(sums[kept])
        return pa.table({"key": pa.concat_arrays(keys), "n": np.concatenate(totals)})

    return blocks.groupBy("group").applyInArrow(merge, "key array<bigint>, n bigint")


def _lowest_cuts(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """``key``, ``a``, ``l``, ``r``, ``score`` of each phrase, cut in two where it scores lowest."""
    size = F.size("key")
    cuts = phrases.select("key", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select(
        "key", "a", "k",
        F.slice("key", F.lit(1), F.col("k")).alias("first"),
        F.slice("key", F.col("k") + 1, size - F.col("k")).alias("rest"),
    )
    sides = cuts.join(counts.select(F.col("key").alias("first"), F.col("n").alias("l")), "first")
    sides = sides.join(counts.select(F.col("key").alias("rest"), F.col("n").alias("r")), "rest")
    # Exact for counts up to 10^15: no product has more than 38 digits.
    a = F.col("a").cast("decimal(15,0)")
    above = (a * a * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)")
    below = (F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")).cast("decimal(38,0)")
    cut = F.struct(F.call_function("div", above, below).alias("score"), "k", "l", "r")
    lowest = sides.groupBy("key").agg(F.max("a").alias("a"), F.min(cut).alias("cut"))
    return lowest.select("key", "a", "cut.l", "cut.r", "cut.score")


def _uncovered(scored: DataFrame, phrases: DataFrame, how: Phrases) -> DataFrame:
    """Without the phrases inside a longer one that occurs often enough beside them."""
    if how.longest < 3:
        return scored
    size = F.size("key")
    inside = phrases.where(size > 2).select(
        "key", "a", F.explode(F.sequence(F.lit(2), size - 1)).alias("words")
    )
    inside = inside.select(
        "key", "a", "words", F.explode(F.sequence(F.lit(1), size - F.col("words") + 1)).alias("at")
    )
    cover = (
        inside.select(F.slice("key", F.col("at"), F.col("words")).alias("key"), "a")
        .groupBy("key")
        .agg(F.max("a").alias("cover"))
    )
    stays = F.coalesce(F.col("cover") * 100 < F.col("a") * how.covered, F.lit(True))
    return scored.join(cover, "key", "left").where(stays).drop("cover")


def collocations(
    docs: DataFrame, how: Phrases = Phrases(), text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are lower-cased (A to Z) and split at ``. , ; : ! ?`` and line ends
    into pieces, and these at spaces and tabs into words. ``a`` is how often a
    phrase occurs within pieces, overlaps included, ``n`` the number of all
    words of the language. Cut after its first k words, a phrase has a first
    part that occurs ``l`` times and a rest that occurs ``r`` times, and scores
    floor(10^6 a a / (l r)); the lowest-scoring cut counts, of equal ones the
    first. Ranks are by score, then ``a``, then the phrase in byte order, so ties
    have one order.

    All counts are exact and over whole texts. Words are told apart by a hash
    that no two words of the corpus share, which is checked each time; if two
    do, another function is taken. Words and phrases that do not occur ``least``
    times are left out on the way, since no phrase around them can.

    A null or empty text has no words; a null language is ``und``. Repeated
    rows count each time; other columns are not read. An empty table gives an
    empty result.
    """
    language = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    rows = docs.select(F.col(text).cast("string").alias("text"), language.alias("lang"))
    words, seed = _told_apart(rows, how)
    totals = words.where("word IS NULL").select("lang", F.col("n").alias("words_of_lang"))
    words = words.where("word IS NOT NULL")

    blocks = _subtrees(rows, how, seed, _passing(words, how), _grouped(words, how))
    phrases = written(_counted(blocks, how), "phrases")
    counts = phrases.unionAll(words.select(F.array("hash").alias("key"), "n"))
    phrases = phrases.withColumnRenamed("n", "a")
    best = _uncovered(_lowest_cuts(phrases, counts), phrases, how)

    for i in range(how.longest):
        own = words.select(
            F.col("hash").alias(f"hash{i}"),
            F.col("word").cast("string").alias(f"word{i}"),
            *(["lang"] if i == 0 else []),
        )
        best = best.withColumn(f"hash{i}", F.get("key", F.lit(i))).join(own, f"hash{i}", "left")
    phrase = F.concat_ws(" ", *[f"word{i}" for i in range(how.longest)])
    best = best.select("lang", phrase.alias("phrase"), "a", "l", "r", "score")
    # The best of each part of a language first, so that its last task gets no more for more input.
    by = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    parts = Window.partitionBy("lang", part).orderBy(*by)
    best = best.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= how.top)
    order = Window.partitionBy("lang").orderBy(*by)
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= how.top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
        F.col("words_of_lang").alias("n"), "score",
    )
