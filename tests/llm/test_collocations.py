import random
import re
from collections import Counter

import corpus
import numpy as np
import pyarrow as pa
import pytest

from farelake.llm import collocations as module
from farelake.llm.collocations import Phrases, collocations
from farelake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, how=Phrases()):
    """Everything counted in one place, with Python's integers."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, how.longest + 1):
                counts.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    found = {k: n for k, n in counts.items() if len(k) > 2 and n >= how.least}
    covers = Counter()
    for (lang, *words), n in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = (lang, *words[i : i + size])
                covers[part] = max(covers[part], n)
    out = {}
    for (lang, *words), a in found.items():
        if 100 * covers[(lang, *words)] >= how.covered * a and covers[(lang, *words)]:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, each in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(each)[: how.top], 1)
    )


def of(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def frame(spark, rows):
    return corpus.documents(spark, [(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)])


def drawn(seed, texts=150, words=60, names=40):
    """Texts over few words, of which some keep together, with marks between."""
    rng = random.Random(seed)
    vocabulary = corpus.prose(seed, names)
    out = []
    for _ in range(texts):
        parts = []
        for _ in range(words):
            parts.append(rng.choice(vocabulary[: 1 + int(names * rng.random() ** 2)]))
            if rng.random() < 0.2:
                parts.append(rng.choice(["New York City", "new YORK", "à la carte", "à la"]))
        out.append((rng.choice([" ", "  ", "\t"]).join(parts).replace("ba", rng.choice(["ba", "b.a", "b,\na", "ba"])), rng.choice(["en", "fr", None, "", "und"])))
    return out


@pytest.mark.parametrize(
    "how",
    [Phrases(), Phrases(least=2), Phrases(longest=2), Phrases(longest=5, least=3),
     Phrases(budget=50), Phrases(budget=1, longest=4), Phrases(filter_bits=15), Phrases(top=7), Phrases(covered=90)],
    ids=str,
)
def test_equals_a_plain_count(spark, how):
    rows = drawn(1)
    assert of(collocations(frame(spark, rows), how)) == plain(rows, how)


def test_ties_and_overlaps(spark):
    rows = [("x x x x x x x x x x x x x", "en"), ("b a, b a; c d! " * 12, "en"), ("é z é z " * 12, "en")]
    rows += [("one two three. " * 20 + "two three. " * 30, "de")]
    got = of(collocations(frame(spark, rows)))
    assert got == plain(rows)
    assert [r[2] for r in got if r[0] == "de"][:1] == ["two three"]  # 20 of 50 are inside the longer one


def test_query_equals_a_plain_count(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text", "lang")
    assert of(QUERIES["op11_collocations"](spark, SF_DIR)) == plain(map(tuple, docs.collect()))


def test_another_function_is_taken_where_words_share_a_hash(spark, monkeypatch):
    tried = []
    words = module._words
    monkeypatch.setattr(module, "_words", lambda docs, how, seed: tried.append(seed) or words(docs, how, seed))
    rows = drawn(2)
    how = Phrases(hash_bits=13)
    try:
        assert of(collocations(frame(spark, rows), how)) == plain(rows, how)
    except RuntimeError:
        assert len(tried) == module.TRIES
    assert len(tried) > 1
    with pytest.raises(RuntimeError, match="share a hash"):
        collocations(frame(spark, rows), Phrases(hash_bits=4))


def test_counts_beyond_64_bits(spark):
    key, n = [1, 2], 9_000_000_000_000
    phrases = spark.createDataFrame([(key, n)], "key array<bigint>, a bigint")
    counts = spark.createDataFrame(
        [([1], n + 1), ([2], n + 2), (key, n)], "key array<bigint>, n bigint"
    )
    got = module._lowest_cuts(phrases, counts).first()
    assert got.score == 1_000_000 * n * n // ((n + 1) * (n + 2))


def test_subtrees_survive_packing():
    rng = np.random.default_rng(3)
    levels = [rng.integers(0, 5, 400).astype(np.uint64) for _ in range(4)]
    levels, n = module._combined(levels, np.ones(400, np.int64))
    back, counts = module._unpacked(module._packed(levels, n), 4)
    assert all((x == y).all() for x, y in zip(levels, back, strict=True)) and (n == counts).all()


def test_groups_hold_their_budget():
    class Bins:
        def __init__(self, weights):
            self.rows = [type("R", (), {"bin": i, "n": n})() for i, n in weights.items()]

        def groupBy(self, _):
            return self

        agg = groupBy

        def collect(self):
            return self.rows

    weights = {0: 4, 1: 5, 2: 3, 7: 100, 8: 1, 9: 10, 11: 9, 12: 2}
    import unittest.mock as mock

    with mock.patch.object(module, "F"):
        group, parts = module._grouped(Bins(weights), Phrases(budget=10))
    assert parts[7] == 10 and (parts[[0, 1, 2, 8, 9, 11, 12]] == 1).all()
    loads = Counter()
    for i, n in weights.items():
        loads[int(group[i])] += n / parts[i]
    assert max(loads.values()) <= 10
    own = set(range(int(group[7]), int(group[7] + parts[7])))
    assert not own & {int(group[i]) for i in weights if i != 7}


def test_pieces_end_with_their_text():
    words = module._Pieces(pa.array(["A b", "c,d e", None, "", "f"]))
    assert words.left.tolist() == [2, 1, 1, 2, 1, 1]
    assert words.spelled(np.arange(6)).to_pylist() == [b"a", b"b", b"c", b"d", b"e", b"f"]


def test_odd_rows(spark):
    rows = [(r[1], r[2]) for r in corpus.ODD]
    for how in (Phrases(least=2), Phrases()):
        assert of(collocations(corpus.odd(spark), how)) == plain(rows, how)


def test_empty_table(spark):
    assert of(collocations(corpus.empty(spark))) == []


def test_a_task_holds_the_hashes_of_a_chunk(monkeypatch):
    """Texts are taken apart in small parts, whose suffixes meet in the same blocks."""
    import tracemalloc
    from types import SimpleNamespace

    def blocks(part):
        monkeypatch.setattr(module, "PART", part, raising=False)
        context = SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x))
        docs = SimpleNamespace(
            sparkSession=SimpleNamespace(sparkContext=context), mapInArrow=lambda run, _: run(iter([batch]))
        )
        every = np.full(1 << 12, 255, np.uint8)
        grouped = np.arange(1 << module.BINS) % 9, np.ones(1 << module.BINS, np.int64)
        tracemalloc.start()
        got = [r for out in module._subtrees(docs, Phrases(), 0, every, grouped) for r in out.to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return got, peak

    rng = random.Random(4)
    vocabulary = corpus.prose(4, 3000)
    texts = [" ".join(rng.choices(vocabulary, k=2000)) + "." for _ in range(150)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": ["en"] * len(texts)})
    monkeypatch.setattr(module, "CHUNK", sum(map(len, texts)))
    (small, low), (whole, high) = blocks(1 << 16), blocks(module.CHUNK)
    assert small == whole and [r["group"] for r in whole] == list(range(9))
    # A suffix takes some 130 bytes while a chunk is added up, whatever its texts take.
    assert low < 135 * 300_000 and low < 0.9 * high
