"""Document quality from positive and unlabelled texts.

A linear model of text features is fitted by non-negative positive-unlabelled
risk minimisation: trusted positives are labelled 1, all other texts are a
mixture of good and bad ones whose share of good ones is estimated first.
Labels of bad documents are never used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.scratch import written
from farelake.llm.words import SPACE, Words, chunks, grams_inside, mix

# Classes of bytes; the features are how often one class follows another.
_CLASSES = ("", " \t\r\x0b\x0c", "\n", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
            "0123456789", ".", ",;:", "!?", "'\"`-()[]{}", "|", "#$%&*", "@_/\\=<>+~^")
_KINDS = len(_CLASSES) + 1  # the last is for bytes beyond ASCII, the first for other control bytes
_KIND = np.zeros(256, np.int64)
for _i, _letters in enumerate(_CLASSES):
    _KIND[[ord(c) for c in _letters]] = _i
_KIND[128:] = _KINDS - 1
DIMENSIONS = _KINDS * _KINDS + 11
#: Times that a task goes through each batch of rows in a round.
PASSES = 20


def text_features(column: pa.Array) -> np.ndarray:
    """A row of ``DIMENSIONS`` numbers for each whole text; zeros for an empty one."""
    words = Words(column, lower=False)
    data, offsets = words.data, words.offsets
    n, sizes = len(column), np.diff(offsets)
    out = np.zeros((n, DIMENSIONS), np.float32)
    doc = np.repeat(np.arange(n), sizes)
    kind = _KIND[data]
    if len(data) > 1:
        follows = doc[1:] == doc[:-1]
        cell = (doc[1:] * _KINDS + kind[:-1]) * _KINDS + kind[1:]
        pairs = np.bincount(cell[follows], minlength=n * _KINDS**2).reshape(n, -1)
        out[:, : _KINDS**2] = np.sqrt(pairs / np.maximum(1, sizes - 1)[:, None])
    counts = np.maximum(1, words.counts)
    letters = np.bincount(doc[~SPACE[data]], minlength=n) if n else np.zeros(0)
    h = words.hashes()
    rest = out[:, _KINDS**2 :]
    rest[:, 0] = np.log1p(sizes)
    rest[:, 1] = np.log1p(words.counts)
    rest[:, 2] = letters / counts
    for place, length in ((3, 1), (4, 3)):
        at, g = grams_inside(words, h, length)
        of = words.doc[at]
        once = np.unique(mix(g) + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True)[1]
        seen = np.bincount(of[once], minlength=n) / np.maximum(1, np.bincount(of, minlength=n))
        rest[:, place] = np.where(words.counts >= length, seen, 1)
    rest[:, 5] = np.minimum(1, 20 / counts)
    if len(h):
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (words.doc[1:] == words.doc[:-1])
        lower, upper = kind == 3, (kind == 4) | (kind == 5)
        named = np.add.reduceat((lower | upper | (data > 127)).astype(np.int32), words.starts) > 0
        shouted = np.add.reduceat(lower.astype(np.int32), words.starts) == 0
        signs = np.add.reduceat((kind >= 9) & (kind < _KINDS - 1), words.starts, dtype=np.int32)
        flags = (again, ~named, named & shouted, signs > 0, signs > 2)
        for place, flag in enumerate(flags, 6):
            share = np.bincount(words.doc[flag], minlength=n) / counts
            rest[:, place] = np.sqrt(share)
    out[words.counts == 0] = 0
    return out


@dataclass(frozen=True)
class QualityModel:
    """Weights for standardised features; ``prior`` is the estimated share of good texts."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def margin(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale).clip(-8, 8) @ self.weights + self.bias

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(features).clip(-30, 30)))


def _vectors(cells: pa.Array) -> np.ndarray:
    """Features kept as bytes, as a matrix."""
    n = len(cells)
    return np.frombuffer(b"".join(cells.to_pylist()), np.float16).reshape(n, -1).astype(np.float32)


def featurise(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``features`` (half-precision numbers as bytes) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = text_features(batch.column("text")).astype(np.float16)
            cells = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), cells], ["doc_id", "features"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, features binary"
    )


def _moments(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each feature over all rows; each task returns two sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((2, DIMENSIONS)), 0
        for batch in batches:
            x = _vectors(batch.column("features")).astype(np.float64)
            total += [x.sum(0), (x * x).sum(0)]
            n += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array([n]), pa.array([total.tobytes()], pa.binary())], ["n", "sums"]
        )

    parts = vectors.select("features").mapInArrow(run, "n bigint, sums binary").collect()
    n = max(1, sum(p.n for p in parts))
    first, second = sum((np.frombuffer(p.sums).reshape(2, -1) for p in parts), np.zeros((2, DIMENSIONS))) / n
    return first, np.sqrt(np.maximum(second - first**2, 1e-6))


def _descend(
    x: np.ndarray, positives: np.ndarray, w: np.ndarray, velocity: np.ndarray, prior: float, rate: float
) -> None:
    """One step down the non-negative risk of a batch of unlabelled rows, in place.

    The risk of unlabelled rows as negatives, less the positives' part of it,
    estimates the negatives' risk. Once it has fallen below zero, the model
    fits the unlabelled rows too closely, and the step goes up that part only.
    A prior below zero fits positives against unlabelled rows plainly.
    """
    unlabelled = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
    trusted = 1 / (1 + np.exp(-(positives @ w).clip(-30, 30)))
    of_unlabelled = x.T @ unlabelled / len(x)
    if prior < 0:
        gradient = positives.T @ (trusted - 1) / len(positives) + of_unlabelled
    else:
        as_negative = of_unlabelled - prior * (positives.T @ trusted) / len(positives)
        risk = -np.log1p(-unlabelled + 1e-9).mean() + prior * np.log1p(-trusted + 1e-9).mean()
        if risk < 0:
            gradient = -as_negative
        else:
            gradient = prior * (positives.T @ (trusted - 1)) / len(positives) + as_negative
    gradient[:-1] += 1e-4 * w[:-1]
    velocity *= 0.9
    velocity -= rate * gradient
    w += velocity


def _drawn(trusted: DataFrame, most: int) -> list[bytes]:
    """The features of trusted rows in the order of their hashes, ``most`` at most.

    Counts of ranges of hashes tell which ranges hold that many rows. Only these
    come to the driver, with equal ones as one, however many tasks there are.
    """
    part = F.shiftright(F.xxhash64("features"), 52)
    total, last = 0, None
    for r in sorted(trusted.groupBy(part.alias("part")).count().collect()):
        total, last = total + r[1], r.part
        if total >= most:
            break
    if last is None:
        return []
    kept = trusted.where(part <= last).groupBy("features").agg(F.count("*").alias("n"))
    rows = kept.orderBy(F.xxhash64("features")).limit(most).collect()
    return [*islice(chain.from_iterable(repeat(r.features, r.n) for r in rows), most)]


def _rounds(
    unlabelled: DataFrame,
    positives: np.ndarray,
    mean: np.ndarray,
    scale: np.ndarray,
    prior: float,
    rounds: int,
    batch_rows: int,
) -> np.ndarray:
    """Weights after ``rounds`` rounds, in each of which every task descends through all its rows.

    A round starts from the mean of the weights that the tasks came to.
    """
    weights = np.zeros(DIMENSIONS + 1)

    def whitened(x: np.ndarray) -> np.ndarray:
        return np.hstack([((x - mean) / scale).clip(-8, 8), np.ones((len(x), 1))])

    # Sent once, as the bytes that they came as, and not with each round's code.
    shared = unlabelled.sparkSession.sparkContext.broadcast(positives.astype(np.float16))
    for turn in range(rounds):
        start = weights.copy()
        rate = 0.1 / (1 + turn)

        def run(
            batches: Iterator[pa.RecordBatch], start: np.ndarray = start, rate: float = rate
        ) -> Iterator[pa.RecordBatch]:
            trusted = whitened(shared.value.astype(np.float32))
            w, velocity, n, step = start.copy(), np.zeros(DIMENSIONS + 1), 0, 0
            for batch in batches:
                rows = whitened(_vectors(batch.column("features")))
                n += len(rows)
                for i in [*range(0, len(rows), batch_rows)] * PASSES:
                    at = np.arange(step * batch_rows, (step + 1) * batch_rows) % len(trusted)
                    _descend(rows[i : i + batch_rows], trusted[at], w, velocity, prior, rate)
                    step += 1
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n]), pa.array([w.tobytes()], pa.binary())], ["n", "w"]
                )

        parts = unlabelled.select("features").mapInArrow(run, "n bigint, w binary").collect()
        if parts:
            weights = np.average([np.frombuffer(p.w) for p in parts], axis=0, weights=[p.n for p in parts])
    shared.destroy()
    return weights


def _prior(unlabelled: DataFrame, positives: np.ndarray, plain: QualityModel, least: float) -> float:
    """Share of good texts among unlabelled ones, no more than what any threshold shows.

    Above any threshold, the share of unlabelled rows over the share of
    positives is at least the prior, and comes near it where hardly a bad text
    scores. The smallest such ratio is taken over thresholds that keep the share
    ``least`` of the positives, which the plain model must not have seen. Each
    task returns a histogram.
    """
    margins = np.sort(plain.margin(positives))
    cuts = np.quantile(margins, np.linspace(0, 1 - least, 33))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above, n = np.zeros(len(cuts), np.int64), 0
        for batch in batches:
            margins = np.sort(plain.margin(_vectors(batch.column("features"))))
            above += len(margins) - np.searchsorted(margins, cuts)
            n += len(margins)
        yield pa.RecordBatch.from_arrays(
            [pa.array([n]), pa.array([above.tobytes()], pa.binary())], ["n", "above"]
        )

    parts = unlabelled.select("features").mapInArrow(run, "n bigint, above binary").collect()
    n = sum(p.n for p in parts)
    if not n:
        return 0.5
    share = sum(np.frombuffer(p.above, np.int64) for p in parts) / n
    kept = (len(margins) - np.searchsorted(margins, cuts)) / len(margins)
    return float(np.clip((share / kept).min(), 0.05, 0.99))


def fit_quality(
    vectors: DataFrame,
    trusted: Column,
    max_positives: int = 20_000,
    rounds: int = 4,
    batch_rows: int = 512,
    least: float = 0.5,
) -> QualityModel:
    """Fit a model to rows of ``features``, of which those with ``trusted`` are known to be good.

    At most ``max_positives`` trusted rows, drawn by a hash of their features,
    go to the driver and to each task; all others count as unlabelled, and each
    of them is read in each round. Without trusted or other rows the model
    knows nothing and scores 0.5.
    """
    rows = vectors.withColumn("trusted", F.coalesce(trusted, F.lit(False)))
    cells = _drawn(rows.where("trusted").select("features"), max_positives)
    unlabelled = rows.where("NOT trusted")
    mean, scale = _moments(vectors)
    if not cells:
        return QualityModel(mean, scale, np.zeros(DIMENSIONS), 0.0, 0.5)
    positives = _vectors(pa.array(cells, pa.binary()))
    order = np.random.Generator(np.random.PCG64(1)).permutation(len(positives))
    positives = positives[order]

    def fitted(prior: float, trusted: np.ndarray, turns: int) -> QualityModel:
        w = _rounds(unlabelled, trusted, mean, scale, prior, turns, batch_rows)
        return QualityModel(mean, scale, w[:-1], float(w[-1]), prior)

    half = (len(positives) + 1) // 2
    plain = fitted(-1.0, positives[:half], 1)
    prior = _prior(unlabelled, positives[half:] if half < len(positives) else positives, plain, least)
    return fitted(prior, positives, rounds)


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with all its columns and the score of each whole text, from 0 to 1.

    A column named like ``score`` is replaced. Null and empty texts get a score too.
    """
    rest = [f for f in docs.schema if f.name.lower() != score.lower()]
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            values = model.score(text_features(batch.column(text))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], [*names, score])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return docs.select(*(F.col(f"`{n}`") for n in names)).mapInArrow(run, f"{fields}, `{score}` double")


def held_out(key: str, of: int) -> Column:
    """Whether the CRC-32 of the id as text leaves no remainder."""
    return F.crc32(F.col(key).cast("string")) % of == 0


def fit_from_labels(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    folds: int = 5,
    **options: int | float,
) -> QualityModel:
    """Fit on the whole texts of ``docs``, trusting those labelled 1 outside the held-out fold.

    An id that has been labelled both ways is not trusted. Held-out texts and
    those without an id count as unlabelled.
    """
    sure = (
        labels.where(F.col(key).isNotNull() & ~held_out(key, folds))
        .groupBy(F.col(key).alias("doc_id"))
        .agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
        .where("least = 1 AND most = 1")
        .select("doc_id", F.lit(True).alias("sure"))
    )
    vectors = written(featurise(docs, key, text).join(sure, "doc_id", "left"), "features")
    return fit_quality(vectors, F.col("sure"), **options)
