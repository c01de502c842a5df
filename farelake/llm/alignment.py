"""Aligning the tokens that two tokenizers make of the same text.

Tokens are kept in Arrow tables. Taking the entries' bytes by id gives the
joined bytes, running sums give where each token ends in its document, and a
hash join of the ends finds where tokens of both end together. Links are
counted by pair within a chunk of documents; Spark merges the counts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.scratch import written
from farelake.llm.words import chunks

#: Words that are encoded as one text.
TOGETHER = 64
# Bytes after which a word may end: the printable ones of ASCII.
_CLOSED = np.zeros(256, bool)
_CLOSED[0x21:0x7F] = True


@dataclass(frozen=True)
class Vocabularies:
    """Files of a byte-level BPE (A) and of a SentencePiece model (B), at the same place on all executors.

    A takes the text behind one space, which B adds by itself.
    """

    a: str = "/opt/tokenizers/byte_bpe_50k.json"
    b: str = "/opt/tokenizers/piece_bpe_32k.model"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for themselves, the other bytes for
    256 and on, in their order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers and the bytes of each of their entries."""

    def __init__(self, how: Vocabularies):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(how.a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=how.b)
        byte_of = _byte_of()
        entries = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            known = all(c in byte_of for c in token)
            entries[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.bytes_a = pa.array(entries, pa.large_binary())
        size = self.b.get_piece_size()
        self.bytes_b = pa.array(
            [
                bytes([int(piece[3:-1], 16)])
                if self.b.is_byte(i)
                else piece.replace("▁", " ").encode()
                for i, piece in enumerate(self.b.id_to_piece(list(range(size))))
            ],
            pa.large_binary(),
        )
        # Decimal ids, each with the mark behind it: one within a group, one at its end.
        self.named_a, self.named_b = (
            pa.array([f"{i}{m}".encode() for m in marks for i in range(n)], pa.large_binary())
            for n, marks in ((len(self.bytes_a), ",|"), (size, ",;"))
        )

        # Where a word may be cut off before its space: neither tokenizer has tokens across it.
        self.cuts = self._splits_a(how) and self._splits_b(size)

    def _splits_a(self, how: Vocabularies) -> bool:
        """Whether A parts texts before a space that follows a printable character of ASCII, whatever stands around."""
        with open(how.a, encoding="utf-8") as f:
            made_of = json.load(f)
        parts = made_of["pre_tokenizer"] or {}
        return made_of["normalizer"] is None and (
            parts.get("type"), parts.get("add_prefix_space"), parts.get("use_regex")
        ) == ("ByteLevel", False, True)

    def _splits_b(self, size: int) -> bool:
        """Whether B keeps all spaces, and none stands inside a piece behind another character."""
        pieces = self.b.id_to_piece(list(range(size)))
        kept = "".join(self.b.id_to_piece(self.b.encode("a  b ")))
        return kept == "▁a▁▁b▁" and not any("▁" in p.lstrip("▁") for p in pieces)

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that start with the space that A is given."""
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode([t[1:] for t in texts], num_threads=1)

    def encode(self, texts: list[bytes]) -> tuple[pa.ListArray, pa.ListArray]:
        """The ids that A and B make of texts, each of which starts with a space.

        Texts are cut into words, and each distinct word is encoded once.
        """
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        first = np.zeros(len(data), bool)
        if self.cuts:
            first = data == 0x20
            first[1:] &= _CLOSED[data[:-1]]
            first[ends - 1] = False
        first[ends - sizes] = True
        starts = np.flatnonzero(first)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(starts),
            [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)],
        ).dictionary_encode()
        of_text = np.append(0, np.searchsorted(starts, ends))
        distinct = words.dictionary.to_pylist()
        return tuple(
            _regrouped(_encoded(run, entries, distinct).take(words.indices), of_text)
            for run, entries in ((self.encode_a, self.bytes_a), (self.encode_b, self.bytes_b))
        )


def _regrouped(lists: pa.ListArray, bounds: np.ndarray) -> pa.ListArray:
    """Lists of neighbours as one list each."""
    offsets = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))
    return pa.ListArray.from_arrays(pa.array(offsets[bounds].astype(np.int32)), lists.flatten())


def _encoded(
    run: Callable[[list[str]], list[list[int]]], entries: pa.Array, words: list[bytes]
) -> pa.ListArray:
    """The ids of each word.

    Words that end in a printable character are encoded as one text together
    with others, and told apart by where they end. Where that fails, and for
    all others, each is a text of its own.
    """
    sizes = pc.binary_length(entries).to_numpy()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    closed = _CLOSED[np.fromiter((w[-1] for w in words), np.int64, len(words))]

    def attempt(order: np.ndarray, text_of: np.ndarray) -> tuple[pa.ListArray, np.ndarray]:
        """Ids of the words in this order, and which words are in texts that could not be told apart."""
        firsts = np.flatnonzero(np.append(True, text_of[1:] != text_of[:-1]))
        bounds = np.append(firsts, len(order)).tolist()
        ordered = [words[i] for i in order.tolist()]
        texts = zip(bounds[:-1], bounds[1:], strict=True)
        found = [np.array(x, np.int32) for x in run([b"".join(ordered[s:e]).decode() for s, e in texts])]
        upto = np.cumsum([len(x) for x in found])
        ids = np.concatenate(found)
        of_text = np.repeat(np.arange(len(found)), np.diff(np.append(0, upto)))
        # Ends of ids and of words, counted from the start of their text.
        made = np.append(0, np.cumsum(sizes[ids]))
        made = made[1:] - made[np.append(0, upto[:-1])][of_text]
        wanted = np.cumsum(lengths[order])
        wanted -= (wanted - lengths[order])[firsts][text_of]
        keys = (of_text << 40) + made
        at = np.minimum(np.searchsorted(keys, (text_of << 40) + wanted), len(keys) - 1)
        lasts = np.array(bounds[1:]) - 1
        parted = keys[at] == (text_of << 40) + wanted
        parted[lasts] &= at[lasts] == upto - 1
        good = np.bincount(text_of, ~parted) == 0
        alone = firsts == lasts
        at[lasts[alone]] = upto[alone] - 1
        good |= alone
        kept = good[text_of]
        counts = np.diff(np.append(-1, at))
        counts[firsts] = at[firsts] + 1 - np.append(0, upto[:-1])
        offsets = np.append(0, np.cumsum(counts[kept])).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[good[of_text]])), ~kept

    if not words:
        return pa.array([], pa.list_(pa.int32()))
    together, alone = np.flatnonzero(closed), np.flatnonzero(~closed)
    order = np.concatenate((together, alone))
    groups = -(-len(together) // TOGETHER)
    text_of = np.concatenate((np.arange(len(together)) // TOGETHER, groups + np.arange(len(alone))))
    lists, failed = attempt(order, text_of)
    if failed.any():
        again = order[failed]
        order = np.concatenate((order[~failed], again))
        lists = pa.concat_arrays([lists, attempt(again, np.arange(len(again)))[0]])
    return lists.take(pa.array(np.argsort(order)))


def _texts(column: pa.Array) -> list[str | None]:
    """None for a text that is null, empty or no UTF-8, and so has no tokens."""

    def read(raw: bytes | None) -> str | None:
        try:
            return raw.decode() if raw else None
        except UnicodeDecodeError:
            return None

    return [read(raw) for raw in column.cast(pa.binary()).to_pylist()]


def _faithful(lists: pa.ListArray, entries: pa.Array, wanted: list[bytes]) -> np.ndarray:
    """For which texts the joined bytes of the tokens are those wanted."""
    taken = entries.take(lists.flatten())
    _, offsets, data = taken.buffers()
    at = np.frombuffer(offsets, np.int64, len(taken) + 1, taken.offset * 8)
    bounds = at[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    joined = memoryview(data or b"").cast("B")
    return np.array(
        [joined[s:e] == w for s, e, w in zip(bounds[:-1], bounds[1:], wanted, strict=True)], bool
    )


class _Side:
    """The tokens of one tokenizer: ids, documents, and where each ends, in its document and overall."""

    def __init__(self, lists: pa.ListArray, entries: pa.Array):
        self.ids = lists.flatten().to_numpy()
        self.doc = pc.list_parent_indices(lists).to_numpy()
        self.counts = pc.list_value_length(lists).to_numpy()
        sizes = pc.binary_length(entries).take(lists.flatten())
        self.overall = pc.cumulative_sum(sizes).to_numpy()
        self.first = np.cumsum(self.counts) - self.counts  # of each document; none is empty
        before = self.overall[self.first] - sizes.to_numpy()[self.first]
        self.ends = self.overall - np.repeat(before, self.counts)

    def table(self, name: str) -> pa.Table:
        return pa.table({"doc": self.doc, "end": self.ends, name: np.arange(len(self.ids))})


class Aligned:
    """The groups and links of documents whose tokens both join to the same bytes."""

    def __init__(self, a: _Side, b: _Side):
        self.a, self.b = a, b
        shared = a.table("a").join(
            b.table("b"), ["doc", "end"], join_type="inner", use_threads=False
        )
        self.last_a, self.last_b = (np.sort(shared[name].to_numpy()) for name in "ab")
        n = len(a.counts)
        self.n_groups = np.bincount(a.doc[self.last_a], minlength=n)
        # Between two neighbouring ends of either kind lies one token of each: a link.
        ends = np.sort(np.concatenate((a.overall, b.overall)), kind="stable")
        if len(ends):
            ends = ends[np.append(True, ends[1:] != ends[:-1])]
        of_a, of_b = np.searchsorted(a.overall, ends), np.searchsorted(b.overall, ends)
        self.doc = a.doc[of_a]
        self.pair = (a.ids[of_a].astype(np.int64) << 32) | b.ids[of_b]
        self.n_links = np.bincount(self.doc, minlength=n)

    def digests(self, tokenizers: Tokenizers) -> list[str]:
        """The groups of each document as text, hashed."""
        a, b = self.a, self.b
        group_a = np.searchsorted(self.last_a, np.arange(len(a.ids)))
        group_b = np.searchsorted(self.last_b, np.arange(len(b.ids)))
        upto_a, upto_b = self.last_a + 1, np.append(0, self.last_b + 1)
        place_a = np.arange(len(a.ids)) + upto_b[group_a]
        place_b = np.arange(len(b.ids)) + upto_a[group_b]
        # Entries of both, in the order in which they are written.
        closes_a, closes_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
        closes_a[self.last_a] = 1
        closes_b[self.last_b] = 1
        n_a, n_b = len(tokenizers.bytes_a), len(tokenizers.bytes_b)
        entry = np.empty(len(a.ids) + len(b.ids), np.int64)
        entry[place_a] = a.ids + closes_a * n_a
        entry[place_b] = b.ids + closes_b * n_b + 2 * n_a
        named = pa.concat_arrays([tokenizers.named_a, tokenizers.named_b]).take(pa.array(entry))
        _, offsets, data = named.buffers()
        at = np.frombuffer(offsets, np.int64, len(named) + 1, named.offset * 8)
        bounds = at[np.append(0, np.cumsum(a.counts + b.counts))]
        text = memoryview(data or b"").cast("B")
        return [
            hashlib.sha256(text[s : e - 1]).hexdigest()  # without the last mark
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        ]


#: Columns of a document, and of the pairs of a chunk with the documents that hold them.
_OF_DOC = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_OF_PAIRS = "used array<int>, times array<int>, pairs array<bigint>, held array<int>"


def _chunk(
    batch: pa.RecordBatch, chunk: int, tokenizers: Tokenizers, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """A row per document with the places of its pairs in the chunk's list, and a row with that list."""
    n = batch.num_rows
    read = _texts(batch.column("text"))
    live = np.array([i for i, t in enumerate(read) if t], np.int64)
    wanted = [f" {read[i]}".encode() for i in live]
    a, b = tokenizers.encode(wanted)
    good = _faithful(a, tokenizers.bytes_a, wanted) & _faithful(b, tokenizers.bytes_b, wanted)
    live = live[good]
    counts = {name: np.zeros(n, np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
    digests, used, times = [""] * n, [[]] * n, [[]] * n
    pairs, held = None, None
    if len(live):
        mask = pa.array(good)
        both = Aligned(
            _Side(a.filter(mask), tokenizers.bytes_a), _Side(b.filter(mask), tokenizers.bytes_b)
        )
        counts["n_a"][live], counts["n_b"][live] = both.a.counts, both.b.counts
        counts["n_groups"][live], counts["n_links"][live] = both.n_groups, both.n_links
        per_doc = (
            pa.table({"doc": both.doc, "pair": both.pair})
            .group_by(["doc", "pair"], use_threads=False)
            .aggregate([([], "count_all")])
        )
        per_pair = (
            per_doc.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
        )
        pairs, held = per_pair["pair"].to_numpy(), per_pair["count_all"].to_numpy()
        at = np.searchsorted(pairs, per_doc["pair"].to_numpy()).astype(np.int32)
        doc = per_doc["doc"].to_numpy()
        order = np.lexsort((at, doc))
        cuts = np.searchsorted(doc[order], np.arange(1, len(live)))
        for i, digest, x, y in zip(
            live.tolist(),
            both.digests(tokenizers),
            np.split(at[order], cuts),
            np.split(per_doc["count_all"].to_numpy()[order].astype(np.int32), cuts),
            strict=True,
        ):
            digests[i], used[i], times[i] = digest, x, y
    of_docs = [batch.column("doc_id"), *counts.values(), digests, used, times]
    nothing = [None] * n
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(x, f.type) if not isinstance(x, pa.Array) else x
            for x, f in zip([[chunk] * n, *of_docs, nothing, nothing], schema, strict=True)
        ],
        schema=schema,
    )
    if pairs is not None:
        row = [chunk, *[None] * 8, pairs, held]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema
        )


def align_tokens(
    docs: DataFrame,
    how: Vocabularies = Vocabularies(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: how its tokens of two vocabularies lie over each other.

    ``n_a``, ``n_b``: tokens. Byte offsets where tokens of both end cut them
    into ``n_groups`` groups, of which ``groups_sha256`` hashes the ids. A link
    is a token of A and one of B whose bytes overlap. The count of a pair of
    ids is the number of rows that hold it linked; ``count_sum`` adds it up over
    the ``n_links`` links, and ``n_best`` is the number of links whose count is
    the highest that their id of A has anywhere, ties included.

    A text that is null, empty or no UTF-8, or whose tokens do not join to its
    bytes behind a space, has zeros and an empty ``groups_sha256``. Rows are
    never merged: copies and rows of one id count each. The id keeps its type
    and may be null; other columns are not read. An empty table gives an empty
    result.

    Texts are tokenized once, in chunks of a bounded number of bytes (a longer
    text is a chunk of its own), and each distinct word of a chunk once, where
    the vocabularies show that no token reaches from a word into the next. A chunk lists its distinct pairs once, so what
    meets the counts grows with the chunks' vocabularies and not with the
    links; the counts come back to a chunk in one list and are never broadcast.
    """
    id_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kept = f"chunk bigint, doc_id {id_type}, {_OF_DOC}, {_OF_PAIRS}"

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(how)
        chunk = TaskContext.get().partitionId() << 32
        schema = None
        for batch in chunks(batches):
            schema = schema or pa.schema(
                [("chunk", pa.int64()), ("doc_id", batch.schema.field("doc_id").type)]
                + [(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
                + [("groups_sha256", pa.string())]
                + [(n, pa.list_(pa.int32())) for n in ("used", "times")]
                + [("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int32()))]
            )
            yield from _chunk(batch, chunk, tokenizers, schema)
            chunk += 1

    parts = written(rows.mapInArrow(tokenize, kept), "tokens")
    listed = parts.where(F.col("pairs").isNotNull()).select(
        "chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "_")
    ).select("chunk", "at", F.col("_.pairs").alias("pair"), F.col("_.held").alias("held"))
    counts = listed.groupBy("pair").agg(F.sum("held").alias("n"))
    counts = written(counts.withColumn("a", F.shiftright("pair", 32)), "pairs")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    known = counts.join(highest, "a").select(
        "pair", "n", (F.col("n") == F.col("highest")).alias("best")
    )
    back = listed.join(known, "pair").select(F.col("chunk").alias("part"), "at", "n", "best")

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        n, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, bool)
        at = right["at"].to_numpy()
        n[at], best[at] = right["n"].to_numpy(), right["best"].to_numpy()
        left = left.combine_chunks()
        used, times = left["used"].combine_chunks(), left["times"].combine_chunks()
        places, links = used.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        bounds = np.append(0, np.cumsum(pc.list_value_length(used).to_numpy()))

        def sums(x: np.ndarray) -> np.ndarray:
            return np.diff(np.append(0, np.cumsum(x))[bounds])

        return left.drop_columns(["chunk", "used", "times"]).add_column(
            6, "n_best", pa.array(sums(links * best[places]))
        ).add_column(7, "count_sum", pa.array(sums(links * n[places])))

    of_docs = parts.where(F.col("used").isNotNull()).drop("pairs", "held")
    result = f"doc_id {id_type}, {_OF_DOC}, n_best bigint, count_sum bigint"
    return of_docs.groupBy("chunk").cogroup(back.groupBy("part")).applyInArrow(add_up, result)
