from collections import Counter, defaultdict

import corpus
import numpy as np
import pytest
from pyspark.sql import functions as F

from farelake.llm import mixture
from farelake.llm.mixture import Mix
from farelake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def expected_targets(sizes, weights, most):
    """Shares in small steps: whoever is full stops, the others go on."""
    out, left = [0.0] * len(sizes), float(sum(sizes))
    while left > 1e-9:
        open_ = [i for i in range(len(sizes)) if out[i] < most * sizes[i] - 1e-9]
        step = min(
            left / sum(weights[i] for i in open_),
            min((most * sizes[i] - out[i]) / weights[i] for i in open_),
        )
        for i in open_:
            out[i] += step * weights[i]
        left -= step * sum(weights[i] for i in open_)
    return out


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 1000, 5, 0, 70, 3], [1], [0, 7], [3] * 9])
def test_targets(sizes):
    weights = mixture.cycling_weights(sizes)
    got = mixture.targets(sizes, weights, 3.0)
    assert got == pytest.approx(expected_targets(sizes, weights, 3.0))
    assert sum(got) == pytest.approx(sum(sizes))
    assert all(t <= 3 * s + 1e-9 for t, s in zip(got, sizes, strict=True))


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutations(n):
    x = np.arange(n, dtype=np.uint64)
    seen = set()
    for key in range(3):
        got = mixture._permuted(x, np.full(n, n, np.uint64), np.full(n, key, np.uint64))
        assert sorted(got.tolist()) == list(range(n))
        seen.add(tuple(got.tolist()))
    assert n < 64 or len(seen) == 3


@pytest.mark.parametrize("n", [1, 2, 5, 64, 999, 10**12])
def test_permutations_backwards(n):
    x = np.unique(np.linspace(0, n - 1, 300).astype(np.uint64))
    all_, key = np.full(len(x), n, np.uint64), np.full(len(x), 7, np.uint64)
    there = mixture._permuted(x, all_, key)
    assert (there < n).all() and (mixture._permuted(there, all_, key, back=True) == x).all()


def settled(shards):
    drawn = np.array([shards.drawn(i).sum(0) for i in range(shards.runs)])
    before, held = mixture._before(drawn), drawn.sum(0)
    return np.concatenate([shards.settled(i, before[i], held) for i in range(shards.runs)])


@pytest.mark.parametrize("runs", [1, 4, 4096])
def test_shards_add_up(monkeypatch, runs):
    monkeypatch.setattr(mixture, "CHUNKS", runs)
    slots = (1000, 0, 37, 5000, 1)
    shards = mixture.Shards(slots, 64, 1)
    counts = settled(shards)
    assert counts.sum(0).tolist() == list(slots) and (counts >= 0).all()
    assert set(counts.sum(1)) <= {63, 64} and len(set(map(tuple, counts))) > 10
    assert len(counts) == shards.number == 95
    # Sources are spread: no shard is far from its share.
    assert np.abs(counts[:, 3] / counts.sum(1) - 5000 / 6038).max() < 0.25


def test_counts_do_not_depend_on_the_runs(monkeypatch):
    found = []
    for runs in (1, 3, 100):
        monkeypatch.setattr(mixture, "CHUNKS", runs)
        found.append(settled(mixture.Shards((300, 700, 55), 16, 3)).tolist())
    assert found[0] == found[1] == found[2]


def test_products_beyond_64_bits():
    part, over, whole = np.array([[10**13, 5]]), np.array([10**8, 3]), np.array([2 * 10**13, 7])
    assert mixture._share(part, over, whole).tolist() == [[5 * 10**7, 2]]


def test_a_plan_for_a_hundred_terabytes(spark):
    """10^12 blocks of a source: what the driver does takes no longer than for a few."""
    sizes = [10**12 * 256, 3 * 10**11 * 256 + 5, 17]
    sized = spark.createDataFrame(list(zip(["a", "b", None], sizes)), "source string, size bigint")
    plan = mixture.plan_mix(sized, Mix(), mixture.cycling_weights)
    assert plan.sizes == tuple(sizes) and all(s > 0 for s in plan.slots)
    shards = mixture.Shards(plan.slots, 1024, 1)
    assert shards.runs <= 4096 and shards.number == -(-sum(plan.slots) // 1024)
    for (slots, last), size, target in zip(zip(plan.slots, plan.last), sizes, plan.targets):
        assert 0 < last <= 256 and abs(slots * 256 - target) <= 2 * 256 * (1 + 3 * (size % 256 > 0))


def rows():
    out = [(i, corpus.text(i, 20 + i % 90), None, ("a", "b", None, "hot", "hot")[i % 5], 1) for i in range(200)]
    return out + [(300, corpus.text(300, 5000), None, "hot", 1), (301, corpus.text(301, 3), None, "tiny", 1)]


@pytest.mark.parametrize("how", [Mix(), Mix(block_words=64, shard_blocks=16), Mix(block_words=7, shard_blocks=50)])
def test_sources_come_to_their_targets(spark, how):
    mixed = mixture.mix_sources(corpus.documents(spark, rows()), how)
    text = {r[0]: r[1].split() for r in rows()}
    source = {r[0]: r[3] for r in rows()}
    size = Counter()
    for key, words in text.items():
        size[source[key]] += len(words)
    names = sorted(filter(None, size)) + [None]
    wanted = dict(zip(names, mixture.targets([size[n] for n in names], [1, 2, 3, 1, 2], 3.0), strict=True))

    taken, by_doc, runs = Counter(), Counter(), defaultdict(list)
    for r in mixed.pieces.collect():
        assert r.source == source[r.doc_id]
        assert r.text.split() == text[r.doc_id][r.doc_from : r.doc_from + r.words]
        taken[r.source] += r.words
        by_doc[r.doc_id] += r.words
        runs[r.shard, r.slot].append((r.at, r.words, r.text))
    for name in names:
        assert taken[name] == round(wanted[name])
    assert all(by_doc[k] <= 3 * len(words) for k, words in text.items())
    for own in runs.values():
        own.sort()
        assert own[0][0] == 0 and sum(n for _, n, _ in own) <= how.block_words
        assert all(a + n == b for (a, n, _), (b, _, _) in zip(own, own[1:], strict=False))

    blocks = mixture.mixed_blocks(mixed).collect()
    assert {(b.shard, b.slot): b.text for b in blocks} == {
        k: " ".join(t for _, _, t in own) for k, own in runs.items()
    }
    assert all(len(b.text.split()) == b.n_words and set(b.doc_ids) <= set(text) for b in blocks)


def test_reruns_agree_whatever_the_partitions(spark):
    docs = corpus.documents(spark, rows())
    first = mixture.mixed_blocks(mixture.mix_sources(docs)).collect()
    again = mixture.mixed_blocks(mixture.mix_sources(docs.repartition(7, F.rand()))).collect()
    assert sorted(first) == sorted(again)


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = QUERIES["op8_mixture"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        name = docs[r.doc_id].source
        assert r["size"] == len(docs[r.doc_id].text.split()) and 0 <= r.taken <= 3 * r["size"]
        size[name] += r["size"]
        taken[name] += r.taken
        target[name] = r.target
    names = sorted(size)
    assert [target[n] for n in names] == pytest.approx(
        expected_targets([size[n] for n in names], mixture.cycling_weights(names), 3.0)
    )
    assert all(taken[n] == round(target[n]) for n in names)
    assert all(r.source_size == size[docs[r.doc_id].source] for r in got)


def test_odd_rows(spark):
    mixed = mixture.mix_sources(corpus.odd(spark))
    got = mixture.taken_by_document(mixed).collect()
    assert sorted((r["size"] for r in got)) == sorted(len((r[1] or "").split()) for r in corpus.ODD)
    assert sum(r.n_words for r in mixture.mixed_blocks(mixed).collect()) == sum(
        round(t) for t in mixed.plan.targets
    )


def test_rows_of_one_id_have_counts_of_their_own(spark):
    rows = [(7, corpus.text(1, 100)), (7, corpus.text(2, 100)), (8, corpus.text(3, 100)), (8, corpus.text(3, 100)), (9, "")]
    docs = corpus.documents(spark, [(*r, "en", s, 1) for r, s in zip(rows, ["a", "b", "a", "a", "b"], strict=True)])
    mixed = mixture.mix_sources(docs, Mix(block_words=16, shard_blocks=4), with_text=False)
    got = mixture.taken_by_document(mixed).collect()
    assert sum(r.taken for r in got) == sum(round(t) for t in mixed.plan.targets) == 400
    assert all(r.taken <= 3 * r["size"] for r in got) and len(got) == 5
    with_text = mixture.mix_sources(docs, Mix(block_words=16, shard_blocks=4))
    words = {k: body.split() for k, body in rows if body}
    texts = [corpus.prose(i, 100) for i in (1, 2, 3)]
    total = 0
    for r in with_text.pieces.collect():
        assert r.text.split() in [t[r.doc_from : r.doc_from + r.words] for t in texts]
        total += r.words
    assert total == 400 and words


def test_ids_keep_their_type(spark):
    docs = spark.createDataFrame([("x", "a b c", "s"), (None, "d e", "s"), ("y", "f", None)], "doc_id string, text string, source string")
    mixed = mixture.mix_sources(docs, Mix(block_words=2, shard_blocks=2), with_text=False)
    got = {r.doc_id: r.taken for r in mixture.taken_by_document(mixed).collect()}
    assert set(got) == {"x", None, "y"} and sum(got.values()) == sum(round(t) for t in mixed.plan.targets)


def test_empty_table(spark):
    mixed = mixture.mix_sources(corpus.empty(spark))
    assert mixture.mixed_blocks(mixed).count() == 0
    assert mixture.taken_by_document(mixed).count() == 0
