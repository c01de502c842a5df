import hashlib
from collections import Counter, defaultdict

import corpus
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from farelake.llm.alignment import Vocabularies, align_tokens
from farelake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plain(rows):
    """Token by token, from the files themselves; A's offsets are its own, B's come from its pieces."""
    how = Vocabularies()
    a_model = Tokenizer.from_file(how.a)
    a_model.encode_special_tokens = True
    b_model = SentencePieceProcessor(model_file=how.b)
    per_doc, count = [], Counter()
    for key, text in rows:
        wanted = f" {text or ''}".encode()
        spans_a, spans_b = [], []
        if text:
            found = a_model.encode(f" {text}", add_special_tokens=False)
            place = 0
            for i in found.ids:
                # A's decoder gives text; single bytes of a character only come out in its entry.
                entry = a_model.id_to_token(i)
                spans_a.append((i, place, place + len(entry)))  # a character of an entry is a byte
                place += len(entry)
            assert place == len(wanted)
            place = 0
            for i in b_model.encode(text):
                piece = b_model.id_to_piece(i)
                raw = bytes.fromhex(piece[3:5]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()
                if wanted[place : place + len(raw)] != raw:
                    place = -1
                    break
                spans_b.append((i, place, place + len(raw)))
                place += len(raw)
            if place != len(wanted):
                spans_a, spans_b = [], []
        links = [
            (a, b) for a, s, e in spans_a for b, t, f in spans_b if s < f and t < e
        ]
        ends = sorted({e for *_, e in spans_a} & {e for *_, e in spans_b})
        groups, start = [], 0
        for end in ends:
            groups.append(
                "|".join(",".join(str(i) for i, s, e in x if start <= s and e <= end) for x in (spans_a, spans_b))
            )
            start = end
        count.update(set(links))
        per_doc.append((key, spans_a, spans_b, groups, links))
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    return [
        (
            key, len(a), len(b), len(groups), len(links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            sum(count[p] == highest[p[0]] for p in links), sum(count[p] for p in links),
        )
        for key, a, b, groups, links in per_doc
    ]


def same(got, rows):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(rows), key=repr)


TEXTS = [
    "", None, " ", "a", "  two  spaces ", "tab\tand\nline\r\n", "<|endoftext|> <s> </s> <unk> <0x41>",
    "naïve café Ωmega 東京 🙂🙂", "▁ is no space", "nul\0inside", "über" * 40, "don't we'll 1234567 3.14",
    "é   　 ﻿", " ", "x" * 300, "Ġ Ċ are letters", "퟿￿",
]


def test_equals_a_plain_version(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "another text"), (3, "a"), (None, "a b")]
    same(align_tokens(corpus.documents(spark, rows)), rows)


def test_texts_that_do_not_join_have_no_tokens(spark):
    got = {r.doc_id: r for r in align_tokens(corpus.documents(spark, [(1, "▁ mark"), (2, "no mark")])).collect()}
    assert tuple(got[1])[1:] == (0, 0, 0, 0, "", 0, 0)
    assert got[2].n_a and got[2].count_sum == got[2].n_links


@pytest.mark.parametrize("name", ["op13_alignment"])
def test_query_equals_a_plain_version(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    # The plain version compares all tokens of a text with all; long texts are held in another test.
    short = docs.where("length(text) < 4000")
    same(align_tokens(short), [tuple(r) for r in short.collect()])
    got = QUERIES[name](spark, SF_DIR)
    assert got.count() == docs.count() and dict(got.dtypes)["doc_id"] == "bigint"


def test_odd_rows(spark):
    got = align_tokens(corpus.odd(spark))
    rows = corpus.ODD
    assert got.count() == len(rows)
    by = defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append(r)
    assert by[1][0].n_a == by[2][0].n_a == 0 and by[1][0].groups_sha256 == ""
    assert by[5][0] == by[5][1]
    assert by[8][0].n_links == by[8][0].n_a + by[8][0].n_b - by[8][0].n_groups
    # Five rows hold the text of 60 words: each of its pairs is counted five times or more.
    assert by[-9][0].count_sum >= 4 * by[-9][0].n_links


def test_broken_utf8_has_no_tokens(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(x'61ff62' AS string) AS text")
    assert tuple(align_tokens(docs).first())[1:] == (0, 0, 0, 0, "", 0, 0)


def test_ids_keep_their_type(spark):
    docs = spark.createDataFrame([("x", "a b c", 1)], "name string, body string, n_a int")
    got = align_tokens(docs, key="name", text="body")
    assert got.first().doc_id == "x" and dict(got.dtypes)["doc_id"] == "string"


def test_empty_table(spark):
    assert align_tokens(corpus.empty(spark)).collect() == []
