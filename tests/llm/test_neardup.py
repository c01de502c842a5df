import random

import corpus
import numpy as np
import pytest

from farelake.llm import neardup
from farelake.llm.components import components
from farelake.llm.neardup import Similarity, drop_near_duplicates, near_duplicates
from farelake.llm.queries import LINKED, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def sets(rows, n):
    out = []
    for key, text in rows:
        w = (text or "").encode().lower().split()
        grams = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)] or ([tuple(w)] if w else [])
        out.append((key, frozenset(grams)))
    return out


def fold(rows, how):
    """Smallest id reachable over links, by comparing all pairs."""
    named = sets(rows, how.words)
    root = {key: key for key, _ in named}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(named):
        for b, t in named[:i]:
            if s and t and 100 * len(s & t) >= how.percent * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((key, len(s), find(key), find(key) == key) for key, s in named)


def cluster(n, words=120, seed=3):
    """Near copies of one text, most of them not alike enough to each other."""
    rng = random.Random(seed)
    return [(i, corpus.edited(seed, words, i, rng.randint(0, 6))) for i in range(n)]


@pytest.mark.parametrize(
    "how",
    [
        Similarity(words=3, percent=85),
        Similarity(words=5, percent=80),
        # So small that all of the group's nodes are large: branches, blocks, tiles.
        Similarity(words=3, percent=85, small=8, block=8, trees=4),
    ],
)
def test_equals_all_pairs(spark, how):
    rows = cluster(90) + [(1000 + i, corpus.text(100 + i, 40)) for i in range(60)]
    rows += [(2000, "a b"), (2001, "A  b"), (2002, "a c"), (2003, ""), (2004, None), (2005, "a b")]
    got = near_duplicates(corpus.documents(spark, rows), how)
    assert sorted(map(tuple, got.collect())) == fold(rows, how)


def test_query_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op3_near_duplicates"](spark, SF_DIR)
    assert sorted(map(tuple, got.collect())) == fold(rows, LINKED)


def test_odd_rows(spark):
    got = near_duplicates(corpus.odd(spark), LINKED)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [
            (1, 0, 1, True),
            (2, 0, 2, True),
            (3, 0, 3, True),
            (4, 1, 4, True),
            (5, 58, -9, False),
            (5, 58, -9, False),
            (6, 58, -9, False),
            (None, 58, -9, False),
            (None, 48, None, True),
            (8, _long(), 8, True),
            (-9, 58, -9, True),
        ],
        key=repr,
    )


def _long():
    return len(sets([corpus.ODD[9][:2]], 3)[0][1])


def test_kept_rows_keep_their_columns(spark):
    docs = corpus.odd(spark)
    kept = drop_near_duplicates(docs, LINKED)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [-9, 0, 0, 1, 2, 3, 4, 8]


def test_an_id_with_a_copy_and_a_text_of_its_own_keeps_the_latter(spark):
    rows = [(3, corpus.text(1, 60)), (7, corpus.text(1, 60)), (7, corpus.text(2, 60))]
    kept = drop_near_duplicates(corpus.documents(spark, rows), LINKED)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [rows[0], rows[2]]


def test_empty_table(spark):
    assert near_duplicates(corpus.empty(spark), LINKED).count() == 0


def test_pairs_are_seldom_missed():
    assert Similarity(words=3, percent=85).missed() < 1e-5
    assert Similarity().missed() < 1e-4


@pytest.mark.parametrize("percent", [80, 85])
def test_pairs_at_the_threshold_meet_on_the_deepest_level(percent):
    """Of pairs of sets of exactly that similarity, all levels walked, as the formula says."""
    how, pairs, size = Similarity(percent=percent), 4000, 100
    rng = np.random.default_rng(percent)
    union = rng.integers(0, 1 << 64, (pairs, size), np.uint64)
    half = percent + (size - percent) // 2
    sets = [union[:, :half], np.concatenate((union[:, :percent], union[:, half:]), 1)]
    tokens = []
    for level in range(how.depth):
        functions = neardup._functions(level, how)
        tokens.append([
            neardup._minima(np.ascontiguousarray(s).ravel(), np.arange(pairs + 1) * s.shape[1], functions)
            for s in sets
        ])
    met = np.zeros(pairs, bool)
    for tree in range(how.trees):
        start = np.full(pairs, tree, np.uint64), np.full(pairs, tree)
        walks = [(start, start, np.ones(pairs, bool))]
        for level, (left, right) in enumerate(tokens):
            walks = [
                (a, b, alive & (a[0] == b[0]))
                for one, other, alive in walks
                for a, b in zip(
                    neardup._branched(*one, left, level), neardup._branched(*other, right, level), strict=True
                )
            ]
        met |= np.any([alive for _, _, alive in walks], axis=0)
    assert (~met).sum() <= 2 and pairs * how.missed() < 0.1


@pytest.mark.parametrize(
    ("percent", "shared", "more"),
    [(80, 4, (0, 1)), (80, 8, (1, 1)), (85, 6, (0, 1)), (80, 80, (10, 10)), (80, 800, (100, 100))],
)
def test_sketches_of_small_sets_lose_no_link(percent, shared, more):
    how, pairs = Similarity(percent=percent), 20_000 if shared < 100 else 2_000
    rng = np.random.default_rng(shared)
    union = rng.integers(0, 1 << 64, (pairs, shared + sum(more)), np.uint64)
    one, other = union[:, : shared + more[0]], np.delete(union, np.s_[shared : shared + more[0]], 1)
    sketches, sizes = [], []
    for s in (one, other):
        s = np.sort(s, axis=1)
        sketches.append(neardup._sketches(s.ravel(), np.arange(pairs + 1) * s.shape[1]))
        sizes.append(np.full(pairs, s.shape[1]))
    lost = 0
    for i in range(0, pairs, 100):
        own = slice(i, i + 100)
        pair = np.concatenate([s[own] for s in sketches]), np.concatenate([n[own] for n in sizes])
        likeness = neardup._similar(*pair, np.arange(100), np.arange(100, 200), how)
        lost += int((np.diagonal(likeness) <= 0).sum())
    assert lost <= 1


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    links += [(7, 7), (None, 3), (500, -4)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint"))
    expected = [(i, 0) for i in range(41)] + [(i, 100) for i in range(100, 160)]
    assert sorted(map(tuple, got.collect())) == sorted([*expected, (500, -4), (-4, -4)])
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert components(none).count() == 0


def test_an_id_with_two_texts_gives_the_same_result_each_time(spark):
    rows = [(7, corpus.text(1, 200)), (7, corpus.text(2, 200)), (9, corpus.edited(1, 200, 5, 2)), (10, corpus.edited(2, 200, 6, 2)), (11, corpus.text(2, 200))]
    found = set()
    for i in range(4):
        docs = corpus.documents(spark, rows[i:] + rows[:i]).repartition(1 + i)
        found.add(tuple(sorted(map(tuple, neardup.near_duplicates(docs).collect()))))
    assert len(found) == 1
    by = {(k, n): c for k, n, c, _ in found.pop()}
    assert {c for (k, _), c in by.items() if k in (7, 11)} == {7}  # a copy of either text is linked
