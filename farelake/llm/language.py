"""Language of a text as a mixture of languages.

A language is a distribution of hashed byte n-grams, learned from all texts that
name it. The proportions of the languages in a document are inferred by
expectation-maximisation, and the set of languages is the one with the largest
penalised likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.words import U64, Words, chunks, mix

#: The language of texts without a letter.
UNDETERMINED = "und"
#: Bytes of text whose n-grams a task holds at once; bounds its memory, also in one long text.
PIECE = 1 << 18

_FOLD = np.full(256, ord(" "), np.uint8)  # all but letters becomes a space
_FOLD[128:] = np.arange(128, 256)
for _c in range(ord("a"), ord("z") + 1):
    _FOLD[[_c, _c - 32]] = _c


@dataclass(frozen=True)
class NGrams:
    """n-grams of ``lengths`` bytes in 2 ** ``bits`` cells; ``rounds`` of EM at most."""

    lengths: tuple[int, ...] = (2, 3)
    bits: int = 14
    rounds: int = 20
    smoothing: float = 0.5


@dataclass(frozen=True)
class LanguageModel:
    """``logs`` has the logarithm of each cell's probability in each language, one row each."""

    languages: tuple[str, ...]
    logs: np.ndarray
    shares: np.ndarray

    @cached_property
    def likelihoods(self) -> tuple[np.ndarray, np.ndarray]:
        """Each cell's probabilities as parts of its largest, and their logarithms."""
        table = np.exp(self.logs - self.logs.max(0)) + 1e-30
        return table, np.log(table)


def _cells(words: Words, how: NGrams, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The text and the cell of each n-gram with a letter in it, of the texts from ``low`` to ``high``.

    They come in parts, in no order, of the n-grams that start in ``PIECE`` bytes. A
    text shorter than the shortest n-gram is one together with the spaces before it.
    """
    begin, end = int(words.offsets[low]), int(words.offsets[high])
    longest, shift = max(how.lengths), U64(64 - how.bits)
    for first in range(begin, end, PIECE):
        last = min(first + PIECE, end)
        data = _FOLD[words.data[first : min(last + longest - 1, end)]]
        letter = data != ord(" ")
        texts = np.searchsorted(words.offsets, (first, first + len(data) - 1), "right") - 1
        bounds = np.clip(words.offsets[texts[0] : texts[1] + 2], first, first + len(data))
        doc = np.repeat(np.arange(texts[0], texts[1] + 1), np.diff(bounds))
        for n in how.lengths:
            m = min(last - first, len(data) - n + 1)
            if m <= 0:
                continue
            code = np.full(m, U64(n), np.uint64)
            some = np.zeros(m, bool)
            for i in range(n):
                code = (code << U64(8)) | data[i : i + m]
                some |= letter[i : i + m]
            some &= doc[:m] == doc[n - 1 : n - 1 + m]
            at = np.flatnonzero(some)
            yield doc[at], (mix(code[at]) >> shift).astype(np.int64)
    sizes, n = np.diff(words.offsets[low : high + 1]), min(how.lengths)
    codes, of = [], []
    for i in (low + np.flatnonzero((sizes > 0) & (sizes < n))).tolist():
        own = _FOLD[words.data[words.offsets[i] : words.offsets[i + 1]]].tolist()
        if any(b != ord(" ") for b in own):
            code = n
            for b in [ord(" ")] * (n - len(own)) + own:
                code = (code << 8 | b) & 0xFFFFFFFFFFFFFFFF
            codes.append(code)
            of.append(i)
    if codes:
        yield np.array(of, np.int64), (mix(np.array(codes, np.uint64)) >> shift).astype(np.int64)


def _counted(words: Words, how: NGrams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct cells of each text, how often they occur, and where each text's begin.

    A few texts at a time are counted in a table with a row each.
    """
    size, n = 1 << how.bits, len(words.counts)
    found, counts, bounds = [], [], [np.zeros(1, np.int64)]
    step = max(1, (1 << 17) >> how.bits)
    for low in range(0, n, step):
        rows = min(step, n - low)
        table = np.zeros(rows * size, np.int64)
        for of, cells in _cells(words, how, low, low + rows):
            table += np.bincount((of - low) * size + cells, minlength=len(table))
        at = np.flatnonzero(table != 0)
        found.append(at % size)
        counts.append(table[at])
        bounds.append(bounds[-1][-1] + np.searchsorted(at, np.arange(1, rows + 1) * size))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0), bounds[0]
    return np.concatenate(found), np.concatenate(counts).astype(np.float64), np.concatenate(bounds)


def learn(docs: DataFrame, text: str, lang: str, how: NGrams = NGrams()) -> LanguageModel:
    """Count the n-grams of all whole texts with a language.

    Tasks count for themselves; Spark adds the counts of a language and piece
    of the cells up. The driver gets 2 ** ``bits`` numbers for each language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in chunks(batches, limit=PIECE):
            words = Words(batch.column("text"))
            names = batch.column("lang").to_numpy(zero_copy_only=False)
            kinds, kind = np.unique(names.astype(str), return_inverse=True)
            size = 1 << how.bits
            counts = np.zeros(len(kinds) * size, np.int64)
            for of, cells in _cells(words, how, 0, len(names)):
                counts += np.bincount(kind[of] * size + cells, minlength=len(counts))
            texts = np.bincount(kind, minlength=len(kinds))
            for i, name in enumerate(kinds):
                own = totals.setdefault(str(name), np.zeros(size + 1, np.int64))
                own[:size] += counts[i * size : (i + 1) * size]
                own[size] += texts[i]
        for name, own in totals.items():
            cells = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(cells), pa.string()),
                    pa.array(cells.astype(np.int32)),
                    pa.array(own[cells]),
                ],
                ["lang", "cell", "n"],
            )

    named = docs.where(F.col(lang).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    )
    counts = (
        named.mapInArrow(run, "lang string, cell int, n bigint")
        .groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list("cell").alias("cells"), F.collect_list("n").alias("counts"))
        .orderBy("lang")
        .collect()
    )
    size = 1 << how.bits
    table = np.zeros((len(counts), size + 1))
    for i, r in enumerate(counts):
        table[i, r.cells] = r.counts
    grams, texts = table[:, :size] + how.smoothing, table[:, size]
    logs = np.log(grams / grams.sum(1, keepdims=True)) if len(counts) else np.zeros((0, size))
    return LanguageModel(tuple(r.lang for r in counts), logs, texts / max(1.0, texts.sum()))


#: Rounds of EM before which it is tested whether more of them can matter.
TESTED = (2, 5, 10)


def _fitted(
    likelihood: np.ndarray,
    counts: np.ndarray,
    shares: np.ndarray,
    rounds: int,
    enough: float = -np.inf,
) -> tuple[np.ndarray, float]:
    """Proportions of one text after ``rounds`` of EM, and its log likelihood under them.

    ``likelihood`` has a row per language. The log likelihood is concave, so it is
    nowhere above its tangent at the proportions at hand. Once that shows that no
    proportions come above ``enough``, those at hand are returned.
    """
    total = counts.sum()
    for turn in range(rounds):
        mixed = shares @ likelihood
        slopes = likelihood @ (counts / mixed)
        if turn in TESTED and enough > -np.inf:
            value = float(counts @ np.log(mixed))
            if value + slopes.max() - total < enough - 1e-9 * (1 + abs(value)):
                return shares, value
        shares = shares * slopes
        shares /= shares.sum()
    return shares, float(counts @ np.log(shares @ likelihood))


def _set_of(
    likelihood: np.ndarray,
    counts: np.ndarray,
    shares: np.ndarray,
    value: float,
    penalty: float,
    rounds: int,
) -> np.ndarray:
    """Proportions of the languages of one text, zero for those not in its set.

    The language with the smallest share goes as long as the likelihood, first
    ``value``, falls by less than the penalty of a language.
    """
    while (shares > 0).sum() > 1:
        fewer = shares.copy()
        fewer[np.where(shares > 0, shares, np.inf).argmin()] = 0
        fewer = np.where(fewer > 0, fewer + 1e-9, 0)
        fewer, without = _fitted(likelihood, counts, fewer / fewer.sum(), rounds)
        if without + penalty < value:
            break
        shares, value = fewer, without
    return shares


def mixtures(
    words: Words, model: LanguageModel, how: NGrams = NGrams()
) -> tuple[np.ndarray, np.ndarray]:
    """A row per text with the proportions of the languages, all zero without letters; a certainty.

    Where one language is chosen, the certainty is its probability among single
    languages, and else it is 1.

    A text goes through EM with all languages. Its set is then chosen by its
    likelihood less, for each language, half the logarithm of its length. No set
    can have more likelihood than that of all languages, so one language is best
    if it comes within one penalty of that, and EM ends once this is certain;
    only other texts try sets in between. A byte counts once, although n-grams
    overlap.
    """
    cells, counts, bounds = _counted(words, how)
    out = np.zeros((len(bounds) - 1, len(model.languages)))
    certainty = np.ones(len(out))
    if not len(model.languages):
        return out, certainty
    counts = counts / len(how.lengths)
    start = np.maximum(model.shares, 1e-3)
    start /= start.sum()
    table, logs = model.likelihoods
    for i in np.flatnonzero(np.diff(bounds)).tolist():
        part = slice(bounds[i], bounds[i + 1])
        at, n = cells[part], counts[part]
        likelihood = table.take(at, 1)
        alone = logs.take(at, 1) @ n
        penalty = 0.5 * np.log(max(2.0, n.sum()))
        enough = alone.max() + penalty
        shares, value = _fitted(likelihood, n, start, how.rounds, enough)
        if enough >= value:
            out[i, alone.argmax()] = 1
            certainty[i] = 1 / np.exp(alone - alone.max()).sum()
        else:
            out[i] = _set_of(likelihood, n, shares, value, penalty, how.rounds)
    return out, certainty


def _has_letter(words: Words, texts: pa.Array) -> np.ndarray:
    """Whether a text has a letter of any script."""
    data = words.data
    plain = _FOLD[data] < 128
    plain &= _FOLD[data] != ord(" ")
    out, other = np.zeros((2, len(words.counts)), bool)
    some = np.flatnonzero(np.diff(words.offsets))
    if len(some):
        out[some] = np.logical_or.reduceat(plain, words.offsets[some])
        other[some] = np.logical_or.reduceat(data > 127, words.offsets[some])
    for i in np.flatnonzero(other & ~out):
        out[i] = any(c.isalpha() for c in texts[i].as_py())
    return out


def identify(
    docs: DataFrame,
    model: LanguageModel,
    how: NGrams = NGrams(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``lang``, ``score``, ``languages``, ``proportions``.

    ``lang`` is the language with the largest proportion in the chosen set, the
    first by name of equal ones, and ``score`` its proportion, times its probability
    among single languages if it is the only one. Whole texts are
    read. A text that is null or has no letter, and any text if no language was
    learned, is ``und`` with a score of 0. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=PIECE):
            words = Words(batch.column("text"))
            shares, certainty = mixtures(words, model, how)
            shares[~_has_letter(words, batch.column("text"))] = 0
            lang, score, names, parts = [], [], [], []
            for own, sure in zip(shares, certainty, strict=True):
                order = [i for i in np.argsort(-own, kind="stable") if own[i] > 0]
                names.append([model.languages[i] for i in order])
                parts.append([float(own[i]) for i in order])
                lang.append(names[-1][0] if order else UNDETERMINED)
                score.append(min(1.0, parts[-1][0] * float(sure)) if order else 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(names, pa.list_(pa.string())),
                    pa.array(parts, pa.list_(pa.float64())),
                ],
                ["doc_id", "lang", "score", "languages", "proportions"],
            )

    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run,
        f"doc_id {kind}, lang string, score double, languages array<string>, proportions array<double>",
    )


def held_out(key: str, of: int, remainder: int) -> Column:
    """Whether the CRC-32 of the id as text leaves the remainder; not for a null id."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % of == remainder, F.lit(False))
