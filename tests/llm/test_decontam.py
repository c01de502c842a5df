import corpus
import numpy as np
import pytest

from farelake.llm.decontam import Overlap, contaminated, drop_contaminated

ITEM = corpus.prose(900, 40)
SHORT = corpus.prose(901, 12)
TINY = corpus.prose(902, 8)


def items(spark, extra=()):
    rows = [(1, " ".join(ITEM)), (2, " ".join(SHORT)), (3, " ".join(TINY)), (4, "one two"), (5, None)]
    return spark.createDataFrame([*rows, *extra], "item_id bigint, text string").repartition(2)


def inside(seed, passage):
    words = corpus.prose(seed, 200)
    return " ".join(words[:90] + list(passage) + words[90:])


def swapped(words, places):
    return [f"zz{i}" if i in places else w for i, w in enumerate(words)]


def found(spark, texts, how=Overlap()):
    docs = corpus.documents(spark, [(i, t) for i, t in enumerate(texts)])
    return {(r.doc_id, r.item_id): r for r in contaminated(docs, items(spark), how).collect()}


def test_passages_are_found_and_clean_documents_left(spark):
    texts = [
        inside(1, ITEM),
        inside(2, ITEM[5:30]),
        inside(3, [w.upper() for w in SHORT]),
        inside(4, swapped(ITEM, {3, 9, 17, 22, 30, 36})),
        inside(5, TINY),
        " ".join(ITEM),
        inside(6, ITEM[:8]),
        inside(7, corpus.prose(55, 40)),
        inside(8, swapped(ITEM, set(range(0, 40, 2)))),
        inside(9, sorted(ITEM)),
        "",
        " ".join(ITEM[:4]),
    ]
    got = found(spark, texts)
    assert set(got) == {(0, 1), (1, 1), (2, 2), (3, 1), (4, 3), (5, 1)}
    assert (got[0, 1].agree, got[0, 1].of, got[0, 1].doc_start - got[0, 1].item_start) == (20, 20, 90)
    assert got[1, 1].item_start >= 5 and got[1, 1].doc_start - got[1, 1].item_start == 85
    assert (got[2, 2].agree, got[2, 2].of) == (12, 12)
    assert 15 <= got[3, 1].agree < 20


def brute(texts, item, how):
    """Every window of the item against every place of every text."""
    out, n = set(), min(how.window, len(item))
    number = {}
    own = np.array([number.setdefault(w, len(number)) for w in item])
    for i, text in enumerate(texts):
        words = np.array([number.get(w, -1) for w in text.lower().split()])
        same = words[:, None] == own
        for shift in range(n - len(own), len(words) - n + 1):
            line = np.cumsum(np.append(0, np.diagonal(same, -shift)))
            if len(line) > n and ((line[n:] - line[:-n]) * 100 >= how.percent * n).any():
                out.add(i)
                break
    return out


@pytest.mark.parametrize("seed", range(2))
def test_equals_every_window_compared(spark, seed):
    """Substitutions that are spread out leave each window some mask that fits."""
    texts = []
    for k in range(12):
        places = {(7 * j + k + seed) % 40 for j in range(k % 6)}
        texts.append(inside(1000 + k, swapped(ITEM, places)))
    got = found(spark, texts)
    assert {d for d, i in got if i == 1} == brute(texts, ITEM, Overlap())


def test_long_items_and_shared_passages(spark):
    """A passage in a third of all documents; an item of thousands of words."""
    long = corpus.prose(77, 3000)
    docs = [(i, inside(i, ITEM) if i % 3 == 0 else corpus.text(i, 60)) for i in range(60)]
    docs.append((100, inside(100, long[1500:1540])))
    table = items(spark, [(9, " ".join(long))])
    got = {(r.doc_id, r.item_id) for r in contaminated(corpus.documents(spark, docs), table).collect()}
    assert got == {(i, 1) for i in range(0, 60, 3)} | {(100, 9)}


def test_odd_rows(spark):
    table = items(spark, [(6, corpus.text(5, 60)), (6, corpus.text(5, 60)), (None, corpus.text(8, 50))])
    got = contaminated(corpus.odd(spark), table)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(-9, 6), (5, 6), (6, 6)]
    kept = drop_contaminated(corpus.odd(spark), table)
    assert kept.columns == corpus.odd(spark).columns and kept.count() == len(corpus.ODD) - 4


def test_empty_tables(spark):
    assert contaminated(corpus.empty(spark), items(spark)).count() == 0
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert contaminated(corpus.odd(spark), none).count() == 0
    assert drop_contaminated(corpus.odd(spark), none).count() == len(corpus.ODD)


def test_a_small_filter_loses_nothing(spark):
    texts = [inside(1, ITEM), inside(7, corpus.prose(55, 40))]
    assert set(found(spark, texts, Overlap(filter_bits=15))) == {(0, 1)}


def test_columns_of_any_name_stay(spark):
    item = corpus.text(400, 30)
    docs = spark.createDataFrame(
        [(1, f"a b {item} c", 7, 8, 9), (2, corpus.text(401, 30), 7, 8, 9)],
        "doc_id bigint, text string, gone int, item_id int, hash int",
    )
    items = spark.createDataFrame([(5, item)], "item_id bigint, text string")
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def test_periodic_texts_take_time_in_proportion(spark):
    """Every shift of a repeated word is a hit; each carries no more than the item's length."""
    items = spark.createDataFrame([(1, "la " * 60)], "item_id bigint, text string")
    docs = corpus.documents(spark, [(1, "la " * 40_000), (2, "la " * 30 + "x"), (3, "la x " * 40)])
    got = {r.doc_id: (r.agree, r.of) for r in contaminated(docs, items).collect()}
    assert got == {1: (20, 20), 2: (20, 20)}
