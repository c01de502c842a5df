"""Removing passages that occur before: windows of words, with a count-min prefilter.

A window is a run of consecutive words of one document. One pass counts
anchors of windows in a count-min sketch, which tasks fill for themselves and
Spark merges. The sketch never counts too little, so a window whose anchor it
counts once occurs once. The second pass groups all other windows exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.scratch import written
from farelake.llm.words import U64, Words, chunks, grams, mix, seeds

#: Cells in a piece of the sketch.
PIECE = 1 << 16
#: Anchors that a task holds before it hands on its counts.
HELD = 4 << 20


@dataclass(frozen=True)
class Windows:
    """Windows of ``words`` words; a sketch of two rows of 2 ** ``bits`` cells.

    A window's anchor is its smallest run of ``words`` - ``spread`` words.
    """

    words: int = 20
    spread: int = 8
    bits: int = 27

    def __post_init__(self) -> None:
        if not 0 < self.spread < self.words or self.bits < 16:
            raise ValueError("a window needs room for its anchor, and a sketch one piece at least")


def _anchors(words: Words, h: np.ndarray, how: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each window, hash of its anchor, and where the anchor stands."""
    n = len(h) - how.words + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    g = grams(h, how.words - how.spread, 41)
    least = g[:n].copy()
    for i in range(1, how.spread + 1):
        np.minimum(least, g[i : i + n], out=least)
    place = np.zeros(n, np.int64)
    for i in range(how.spread, -1, -1):  # the first of equal ones, so no two windows share it by chance
        place[g[i : i + n] == least] = i
    inside = np.flatnonzero(words.doc[:n] == words.doc[how.words - 1 :])
    return inside, least[inside], place[inside] + inside


def _cells(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(anchors ^ seeds(2, 42)[row]) >> U64(64 - bits)).astype(np.int64)


def _counted(docs: DataFrame, how: Windows) -> DataFrame:
    """``piece``, ``cells``: the cells that a task has counted, each twice at most."""

    def packed(anchors: np.ndarray) -> pa.RecordBatch:
        pieces, cells = [], []
        for row in range(2):
            at = np.sort(_cells(anchors, row, how.bits))
            keep = np.ones(len(at), bool)
            keep[2:] = at[2:] != at[:-2]
            at = at[keep]
            number = at // PIECE
            cuts = np.flatnonzero(np.diff(number)) + 1
            offsets = (at % PIECE).astype(np.uint16)
            pieces += (number[np.append(0, cuts)] + (row << (how.bits - 16))).tolist()
            cells += [x.tobytes() for x in np.split(offsets, cuts)]
        return pa.RecordBatch.from_arrays(
            [pa.array(pieces, pa.int32()), pa.array(cells, pa.binary())], ["piece", "cells"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in chunks(batches):
            words = Words(batch.column("text"))
            _, least, place = _anchors(words, words.hashes(), how)
            if not len(place):
                continue
            first = np.ones(len(place), bool)
            first[1:] = place[1:] != place[:-1]
            held.append(least[first])
            n += len(held[-1])
            if n >= HELD:
                yield packed(np.concatenate(held))
                held, n = [], 0
        if held:
            yield packed(np.concatenate(held))

    return docs.select("text").mapInArrow(run, "piece int, cells binary")


def _repeated_cells(docs: DataFrame, how: Windows) -> np.ndarray:
    """Bits of the cells that count two or more, of both rows: a fixed number of bytes.

    Pieces of the sketch are merged by the tasks one after the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, counts = None, np.zeros(PIECE, np.int64)

        def merged() -> pa.RecordBatch:
            bits = np.packbits(counts > 1, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([piece], pa.int32()), pa.array([bits], pa.binary())], ["piece", "bits"]
            )

        for batch in batches:
            for number, cells in zip(
                batch.column("piece").to_pylist(), batch.column("cells").to_pylist(), strict=True
            ):
                if number != piece:
                    if piece is not None and (counts > 1).any():
                        yield merged()
                    piece, counts = number, np.zeros(PIECE, np.int64)
                counts += np.bincount(np.frombuffer(cells, np.uint16), minlength=PIECE)
        if piece is not None and (counts > 1).any():
            yield merged()

    dealt = _counted(docs, how).repartition("piece").sortWithinPartitions("piece")
    out = np.zeros((2 << how.bits) // 8, np.uint8)
    for r in dealt.mapInArrow(run, "piece int, bits binary").collect():
        at = r.piece * (PIECE // 8)
        out[at : at + PIECE // 8] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def _suspects(words: Words, h: np.ndarray, bits: np.ndarray, how: Windows) -> np.ndarray:
    """Starts of the windows whose anchors the sketch counts more than once."""
    inside, least, place = _anchors(words, h, how)
    if not len(inside):
        return inside
    first = np.ones(len(place), bool)
    first[1:] = place[1:] != place[:-1]
    anchors = least[first]
    often = np.ones(len(anchors), bool)
    for row in range(2):
        at = _cells(anchors, row, how.bits) + (row << how.bits)
        often &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return inside[often[np.cumsum(first) - 1]]


def _window_hashes(
    words: Words, h: np.ndarray, at: np.ndarray, how: Windows
) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each window, of two hashes of each word that have nothing to do with each other."""
    high = grams(h, how.words, 43)[at]
    return high.view(np.int64), grams(words.hashes(45), how.words, 44)[at].view(np.int64)


def remove_repeats(
    docs: DataFrame, how: Windows = Windows(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``text``.

    Each word is removed that is covered by a window whose words, unchanged,
    also start earlier: in a document with a smaller id, or before in the same
    one. Windows are judged on the input, not on what is left. ``text`` has the
    words that are kept, joined by one space.

    The sketch, 2 ** (bits - 2) bytes whatever the input, is all that tasks hold
    beside their rows; a corpus that overfills it only sends more windows to
    the exact pass. That pass finds the first place of each window, with a
    combining aggregate, and gives each document its own first places back; its
    other suspect windows are repeats.

    A null text is empty and has no words. Rows without an id come behind all
    ids below 2 ** 62, in the order of a hash of their text. Rows that share an
    id are documents of their own, none of which is earlier than another. Ids
    must be integers, or text that names one. Other columns are not read. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    shared = spark.sparkContext.broadcast(_repeated_cells(rows, how))
    nameless = F.lit(2**62) + F.pmod(F.xxhash64("text"), F.lit(2**62))
    keyed = rows.select(
        F.coalesce("doc_id", nameless).alias("id"), "doc_id", F.xxhash64("text").alias("row"), "text"
    )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words = Words(batch.column("text"))
            h = words.hashes()
            at = _suspects(words, h, shared.value, how)
            if not len(at):
                continue
            high, low = _window_hashes(words, h, at, how)
            # A window that a document has again is a repeat for certain.
            of = words.doc[at]
            once = np.sort(
                np.unique(
                    mix(high.view(np.uint64)) + low.view(np.uint64) + mix(of.astype(np.uint64)),
                    return_index=True,
                )[1]
            )
            at, of = at[once], of[once]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(high[once]),
                    pa.array(low[once]),
                    batch.column("id").take(pa.array(of)),
                    batch.column("row").take(pa.array(of)),
                    pa.array((at - words.bounds[of]).astype(np.int64)),
                ],
                ["high", "low", "id", "row", "start"],
            )

    def windows_of(rows: DataFrame) -> DataFrame:
        return rows.select("id", "row", "text").mapInArrow(
            windows, "high bigint, low bigint, id bigint, row bigint, start bigint"
        )

    found = windows_of(keyed)
    # One number that orders places by document and start, which an aggregate can update in place.
    room = F.lit(2**31).cast("decimal(18,0)")
    place = F.col("id").cast("decimal(19,0)") * room + F.col("start").cast("decimal(18,0)")
    firsts = (
        found.groupBy("high", "low")
        .agg(F.min(place).alias("place"))
        .select(F.pmod("place", room).cast("bigint").alias("start"), "place")
        .select(
            ((F.col("place") - F.col("start").cast("decimal(18,0)")) / room)
            .cast("bigint")
            .alias("id"),
            "start",
        )
    )
    shared_ids = written(
        keyed.groupBy("id").agg(F.min("row").alias("a"), F.max("row").alias("b")).where("a <> b").select("id"),
        "shared_ids",
    )
    some = not shared_ids.isEmpty()
    if some:
        # Rows of one id are not earlier than each other, so each may hold first places of its own.
        theirs = windows_of(keyed.join(shared_ids, "id", "left_semi"))
        least = found.groupBy("high", "low").agg(F.min("id").alias("least"))
        theirs = theirs.join(least, ["high", "low"]).where(F.col("id") == F.col("least"))
        firsts = (
            firsts.join(shared_ids, "id", "left_anti")
            .withColumn("row", F.lit(None).cast("bigint"))
            .unionByName(theirs.select("id", "row", "start"))
        )
        firsts = firsts.groupBy("id", "row")
    else:
        firsts = firsts.groupBy("id")
    own = written(firsts.agg(F.collect_list("start").alias("firsts")), "firsts")
    if some:
        # A null stands for all rows of an id.
        given = own.withColumnsRenamed({"id": "of", "row": "of_row"})
        same = (keyed["id"] == given["of"]) & F.coalesce(keyed["row"] == given["of_row"], F.lit(True))
        with_firsts = keyed.join(given, same, "left")
    else:
        with_firsts = keyed.join(own, "id", "left")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words = Words(batch.column("text"))
            h = words.hashes()
            at = _suspects(words, h, shared.value, how)
            firsts = batch.column("firsts")
            starts = firsts.flatten().to_numpy(zero_copy_only=False)
            of = np.repeat(
                np.arange(len(firsts)),
                pa.compute.list_value_length(firsts).fill_null(0).to_numpy(zero_copy_only=False),
            )
            repeats = np.setdiff1d(at, starts + words.bounds[of])
            if len(repeats):
                edges = np.zeros(len(h) + 1, np.int64)
                edges[repeats] += 1
                edges[repeats + how.words] -= 1
                covered = np.cumsum(edges[:-1]) > 0
            else:
                covered = np.zeros(len(h), bool)
            removed = np.bincount(words.doc[covered], minlength=batch.num_rows)
            texts = []
            for i, body in enumerate(batch.column("text").to_pylist()):
                own = (body or "").encode().split()
                if removed[i]:
                    own = compress(own, ~covered[words.bounds[i] : words.bounds[i + 1]])
                texts.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(removed.astype(np.int64)),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "text"],
            )

    return with_firsts.select("doc_id", "text", "firsts").mapInArrow(
        remove, "doc_id bigint, n_words bigint, n_removed bigint, text string"
    )
