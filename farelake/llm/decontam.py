"""Benchmark decontamination with spaced seeds.

A mask marks some positions of a short run of words and ignores the others, so
that runs which differ only in ignored positions have equal hashes. Hashes of
the benchmark's and of the documents' runs are joined; around each hit the two
word sequences are laid side by side and the words that agree are counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.scratch import written
from farelake.llm.words import U64, Words, chunks, mix, seeds

#: Masks of weight six over nine to eleven words.
MASKS = ("110101011", "1101100101", "11100010011", "1011011001")


@dataclass(frozen=True)
class Overlap:
    """A document overlaps an item if, of ``window`` words in a row of the item, ``percent`` agree.

    An item with fewer words must agree over its whole length, and one with
    fewer than ``least`` is not searched for. ``filter_bits`` is the size, as a
    power of two, of the filter that tasks hold.
    """

    masks: tuple[str, ...] = MASKS
    window: int = 20
    percent: int = 75
    least: int = 8
    filter_bits: int = 26


def _mask_hashes(h: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The hash of the marked words of each run."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, k in enumerate(seeds(len(mask), 31 + 1000 * number)):
        if mask[i] == "1":
            total += h[i : i + n] * (k | U64(1))
    return mix(total)


def _fitting(how: Overlap, words: int) -> list[tuple[int, str]]:
    """Masks for an item: those that fit in, or one over all of a shorter item's words."""
    return [(i, m) for i, m in enumerate(how.masks) if len(m) <= words]


def _items(items: DataFrame, how: Overlap) -> DataFrame:
    """``item_id``, ``words`` (hashes) and ``runs`` (hash, position) of the items long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            w = Words(batch.column("text"), lower=True)
            h = w.hashes()
            ids, words, runs = [], [], []
            for i, item in enumerate(batch.column("item_id").to_pylist()):
                own = h[w.bounds[i] : w.bounds[i + 1]]
                if len(own) < how.least or item is None:
                    continue
                ids.append(item)
                words.append(own.view(np.int64))
                runs.append(
                    [
                        {"hash": int(x), "at": at}
                        for k, m in _fitting(how, len(own))
                        for at, x in enumerate(_mask_hashes(own, m, k).view(np.int64))
                    ]
                    or [{"hash": int(_whole(own).view(np.int64)[0]), "at": 0}]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(words, pa.list_(pa.int64())),
                    pa.array(runs, pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32())]))),
                ],
                ["item_id", "words", "runs"],
            )

    return items.mapInArrow(
        run, "item_id bigint, words array<bigint>, runs array<struct<hash: bigint, at: int>>"
    )


def _whole(own: np.ndarray) -> np.ndarray:
    return _mask_hashes(own, "1" * len(own), 100 + len(own))


def _filter(runs: DataFrame, bits: int) -> np.ndarray:
    """The bits of all hashes: a bitmap of 2 ** ``bits`` bits whatever the number of hashes.

    It comes to the driver in pieces of 32,768 bits that were merged by Spark.
    """
    low = (1 << bits) - 1
    mask = F.lit(low)
    bit = F.explode(
        F.array(
            *(
                F.shiftrightunsigned("hash", s).bitwiseAND(mask) + 1  # pieces count from one
                for s in (0, 64 - bits, (64 - bits) // 2)
            )
        )
    )
    pieces = (
        runs.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()
    )
    out = np.zeros((1 << bits) // 8, np.uint8)
    for p in pieces:
        own = np.frombuffer(bytes(p.bits), np.uint8)
        at = (p.piece - 1) * len(own)
        out[at : at + len(own)] = own
    return out


def _passages(docs: DataFrame, bitmap: np.ndarray, lengths: list[int], how: Overlap) -> DataFrame:
    """``doc_id``, ``start``, ``words`` and ``hits`` of the stretches around runs that pass the filter.

    Each stretch reaches as far as the comparison around any of its hits does.
    """
    bits = how.filter_bits
    runs = [(len(m), lambda h, m=m, i=i: _mask_hashes(h, m, i)) for i, m in enumerate(how.masks)]
    runs += [
        (n, lambda h, n=n: _mask_hashes(h, "1" * n, 100 + n)) for n in lengths
    ]
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value

        def passes(x: np.ndarray) -> np.ndarray:
            left = np.arange(len(x))
            for shift in (0, 64 - bits, (64 - bits) // 2):
                p = (x[left] >> U64(shift)) & U64((1 << bits) - 1)
                left = left[(bitmap[p >> U64(3)] >> (p & U64(7)).astype(np.uint8)) & 1 == 1]
            return left

        for batch in chunks(batches):
            w = Words(batch.column("text"), lower=True)
            h = w.hashes()
            at, hashes = [], []
            for length, of in runs:
                x = of(h)
                found = passes(x)
                found = found[w.doc[found] == w.doc[found + length - 1]] if len(found) else found
                at.append(found)
                hashes.append(x[found])
            at, hashes = np.concatenate(at), np.concatenate(hashes)
            order = np.argsort(at, kind="stable")
            at, hashes = at[order], hashes[order]
            if not len(at):
                continue
            # Hits whose surroundings meet share a stretch.
            reach = how.window + max(n for n, _ in runs)
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) > reach) | (w.doc[at[1:]] != w.doc[at[:-1]])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at)) - 1
            of = w.doc[at[first]]
            low = np.maximum(at[first] - reach, w.bounds[of])
            high = np.minimum(at[last] + reach, w.bounds[of + 1])
            signed = h.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(of)),
                    pa.array(low - w.bounds[of], pa.int64()),
                    pa.array([signed[a:b] for a, b in zip(low, high, strict=True)], pa.list_(pa.int64())),
                    pa.array(
                        [
                            [
                                {"hash": int(x), "at": int(p)}
                                for x, p in zip(
                                    hashes[i : j + 1].view(np.int64), at[i : j + 1] - a, strict=True
                                )
                            ]
                            for i, j, a in zip(first, last, low, strict=True)
                        ],
                        pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32())])),
                    ),
                ],
                ["doc_id", "start", "words", "hits"],
            )

    return docs.mapInArrow(
        run,
        "doc_id bigint, start bigint, words array<bigint>, hits array<struct<hash: bigint, at: int>>",
    )


def _agreement(
    doc: np.ndarray, item: np.ndarray, shift: int, how: Overlap
) -> tuple[int, int, int, int]:
    """The best window of the item laid over the document at ``shift``.

    Words that agree, the window's length, and its start in the item and the document.
    """
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    length = min(how.window, len(item))
    if high - low < length:
        return 0, length, 0, 0
    same = item[low:high] == doc[low + shift : high + shift]
    sums = np.concatenate(([0], np.cumsum(same)))
    counts = sums[length:] - sums[:-length]
    best = int(counts.argmax())
    return int(counts[best]), length, low + best, low + best + shift


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    how: Overlap = Overlap(),
    key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """One row per document and benchmark item that overlap, for their best window.

    ``doc_id``, ``item_id``, ``agree`` (words that are equal), ``of`` (the
    window's words), ``item_start`` and ``doc_start`` (in words). Words are runs
    of other bytes than ASCII white space, ASCII letters lower-cased.

    Tasks hold a Bloom filter of the benchmark's hashes, whose size is fixed; a
    larger benchmark makes more runs pass it and loses none. What passes meets
    the benchmark's hashes in a join.

    Rows without an id and empty or null texts overlap with nothing. Repeated
    rows count once. Other columns are not read, and empty tables give an empty result.
    """
    texts = F.col(text).cast("string").alias("text")
    known = items.select(F.col(item_key).cast("bigint").alias("item_id"), texts)
    bench = written(_items(known, how), "items")
    runs = bench.select("item_id", F.explode("runs").alias("run")).select("item_id", "run.*")
    short = bench.select(F.size("words").alias("n")).where(
        F.col("n") < min(map(len, how.masks))
    )
    lengths = sorted(r.n for r in short.distinct().collect())
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("doc_id"), texts)
    found = written(_passages(rows, _filter(runs, how.filter_bits), lengths, how), "passages")

    hits = found.select("doc_id", "start", F.explode("hits").alias("hit")).select(
        "doc_id", "start", "hit.hash", F.col("hit.at").alias("doc_at")
    )
    shifts = (
        hits.join(runs, "hash")
        .select("doc_id", "start", "item_id", (F.col("doc_at") - F.col("at")).alias("shift"))
        .distinct()
    )
    # Of a stretch, a shift needs no more than lies beside the item.
    skipped = F.greatest("shift", F.lit(0))
    reach = F.size("item") + F.least("shift", F.lit(0))
    beside = (
        shifts.join(bench.select("item_id", F.col("words").alias("item")), "item_id")
        .join(found.select("doc_id", "start", F.col("words").alias("doc")), ["doc_id", "start"])
        .withColumn("doc", F.slice("doc", skipped + 1, F.greatest(reach, F.lit(0))))
        .withColumn("start", F.col("start") + skipped)
        .withColumn("shift", F.least("shift", F.lit(0)))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, items_ = batch.column("doc"), batch.column("item")
            out = [
                _agreement(
                    docs_[i].values.to_numpy(), items_[i].values.to_numpy(), shift, how
                )
                for i, shift in enumerate(batch.column("shift").to_pylist())
            ]
            agree, of, item_start, doc_start = (
                np.array(out, np.int64).reshape(-1, 4).T if out else np.zeros((4, 0), np.int64)
            )
            starts = batch.column("start").to_numpy(zero_copy_only=False) + doc_start
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("item_id"),
                    *(pa.array(np.ascontiguousarray(x)) for x in (agree, of, item_start, starts)),
                ],
                ["doc_id", "item_id", "agree", "of", "item_start", "doc_start"],
            )

    counted = beside.mapInArrow(
        run,
        "doc_id bigint, item_id bigint, agree bigint, of bigint, item_start bigint, doc_start bigint",
    ).where(F.col("agree") * 100 >= F.col("of") * F.lit(how.percent))
    best = F.max(F.struct("agree", "of", -F.col("item_start"), -F.col("doc_start"))).alias("best")
    return counted.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id",
        "item_id",
        "best.agree",
        "best.of",
        (-F.col("best.col3")).alias("item_start"),
        (-F.col("best.col4")).alias("doc_start"),
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, how: Overlap = Overlap(), key: str = "doc_id", **names: str
) -> DataFrame:
    """The rows of ``docs`` that overlap no item, with all their columns."""
    gone = contaminated(docs, items, how, key, **names).select(F.col("doc_id").alias("gone"))
    gone = gone.distinct()
    return docs.join(gone, docs[key].cast("bigint") == gone["gone"], "left_anti")
