import corpus
import pytest
from pyspark.sql import functions as F

from farelake.llm.queries import QUERIES
from farelake.llm.repeats import Windows, remove_repeats

SF_DIR = "/root/testdata/sf0.001"


def fold(rows, n=20):
    """Windows count where they start in a smaller id, or before in the same row."""
    first = {}
    split = [(key, (text or "").encode().split()) for key, text in rows]
    for key, words in split:
        for i in range(len(words) - n + 1):
            window = tuple(words[i : i + n])
            first[window] = min(first.get(window, key), key)
    out = []
    for key, words in split:
        covered, seen = [False] * len(words), set()
        for i in range(len(words) - n + 1):
            window = tuple(words[i : i + n])
            if window in seen or first[window] < key:
                covered[i : i + n] = [True] * n
            seen.add(window)
        kept = b" ".join(w for w, c in zip(words, covered, strict=True) if not c).decode()
        out.append((key, len(words), sum(covered), kept))
    return sorted(out)


PASSAGE = corpus.prose(50, 60)


def rows():
    out = [(i, corpus.text(i, 100)) for i in range(10)]
    out += [(20 + i, " ".join(corpus.prose(i + 30, 40) + PASSAGE + corpus.prose(i + 60, 40))) for i in range(30)]
    out += [(60, corpus.text(3, 100)), (61, corpus.text(3, 100).replace(" ", "\n ")), (62, corpus.text(3, 100).upper())]
    out += [(63, "word " * 50), (64, "a b " * 30), (65, "word " * 19), (66, ""), (67, None)]
    out += [(68, " ".join(PASSAGE[:20])), (69, " ".join(PASSAGE[:19])), (-5, " ".join(PASSAGE[30:55]))]
    out += [(70, " ".join(PASSAGE + PASSAGE[10:50]))]
    return out


@pytest.mark.parametrize("how", [Windows(), Windows(bits=16), Windows(spread=1), Windows(words=5, spread=3)])
def test_equals_a_plain_fold(spark, how):
    got = remove_repeats(corpus.documents(spark, rows()), how)
    assert sorted(map(tuple, got.collect())) == fold(rows(), how.words)


def test_rows_of_one_id_are_judged_apart(spark):
    p, q = " ".join(PASSAGE), corpus.text(90, 60)
    many = [(3, p), (7, q), (7, p), (8, q), (8, q + " " + p), (8, corpus.text(91, 30) + " " + q), (9, q), (9, q)]
    many += [(20, corpus.text(92, 40)), (20, corpus.text(92, 40) + " " + corpus.text(93, 40)), (20, corpus.text(93, 40) * 2)]
    got = remove_repeats(corpus.documents(spark, many))
    assert sorted(map(tuple, got.collect())) == fold(many)


def test_query_equals_a_plain_fold(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    expected = spark.createDataFrame(
        fold(map(tuple, docs.collect())), "doc_id bigint, n_words bigint, n_removed bigint, text string"
    ).withColumn("kept_sha256", F.sha2("text", 256)).drop("text")
    got = QUERIES["op9_repeats"](spark, SF_DIR)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_odd_rows(spark):
    got = remove_repeats(corpus.odd(spark))
    by = sorted(((r.doc_id, r.n_words, r.n_removed) for r in got.collect()), key=repr)
    # -9 comes first; both rows of 5 come after it, and so does the copy without an id.
    assert by == sorted(
        [(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 3, 0), (5, 60, 60), (5, 60, 60), (6, 60, 60),
         (None, 60, 60), (None, 50, 0), (8, 30_000, 0), (-9, 60, 0)],
        key=repr,
    )


def test_empty_table(spark):
    assert remove_repeats(corpus.empty(spark)).count() == 0


def test_rejects_windows_without_room():
    with pytest.raises(ValueError):
        Windows(words=8, spread=8)
