import zlib

import corpus
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from farelake.llm import quality
from farelake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_query_separates_held_out_texts(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = QUERIES["op6_quality"](spark, SF_DIR).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    good, bad = ([r.score for r in held if labels[r.doc_id] == q] for q in (1, 0))
    assert len(good) > 40 and len(bad) > 5
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_bad_labels_are_never_used(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    all_, good = (quality.fit_from_labels(docs, t) for t in (labels, labels.where("quality = 1")))
    assert np.array_equal(all_.weights, good.weights) and all_.prior == good.prior
    held = labels.where(~quality.held_out("doc_id", 5))
    assert np.array_equal(quality.fit_from_labels(docs, held).weights, all_.weights)


def test_the_step_goes_up_only_the_negative_part_once_its_risk_is_negative():
    rng = np.random.default_rng(0)
    x, p = rng.normal(size=(50, 4)), rng.normal(size=(20, 4))

    def risks(w, prior):
        unlabelled = np.log1p(np.exp(x @ w)).mean()
        positive = np.log1p(np.exp(p @ w)).mean()
        return prior * np.log1p(np.exp(-(p @ w))).mean(), unlabelled - prior * positive

    for prior, sign in ((0.2, 1), (0.99, -1)):
        w = rng.normal(size=4) if sign > 0 else 3 * p.mean(0) - 3 * x.mean(0) + 2
        kept, rest = risks(w, prior)
        assert (rest > 0) == (sign > 0)
        gradient = np.zeros(4)
        for i in range(4):
            e = np.eye(4)[i] * 1e-6
            above, below = risks(w + e, prior), risks(w - e, prior)
            parts = [(a - b) / 2e-6 for a, b in zip(above, below, strict=True)]
            gradient[i] = parts[0] + parts[1] if sign > 0 else -parts[1]
        gradient[:-1] += 1e-4 * w[:-1]
        step = w.copy()
        quality._descend(x, p, step, np.zeros(4), prior, 0.1)
        assert (w - step) / 0.1 == pytest.approx(gradient, abs=1e-4)


def test_features_of_odd_texts():
    texts = [None, "", "  ", "Some words. Some more!", "AAA AAA AAA", "| # |", "é" * 10, "x " * 30_000]
    rows = quality.text_features(pa.array(texts))
    assert rows.shape == (8, quality.DIMENSIONS) and np.isfinite(rows).all()
    assert not rows[:3].any() and rows[3:].any(1).all()
    alone = np.vstack([quality.text_features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(rows, alone)


def test_odd_rows(spark):
    docs = corpus.odd(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (5, 1, 0), (5, 0, 0), (6, 1, 0), (None, 1, 0), (4, None, 0), (8, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    model = quality.fit_from_labels(docs, labels)
    got = quality.score_quality(docs, model)
    assert sorted(got.columns) == sorted(docs.columns) and got.count() == len(corpus.ODD)
    assert all(0 <= r.score <= 1 for r in got.collect())


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = quality.fit_from_labels(corpus.odd(spark), none)
    assert {r.score for r in quality.score_quality(corpus.odd(spark), model).collect()} == {0.5}
    model = quality.fit_from_labels(corpus.empty(spark), none)
    assert quality.score_quality(corpus.empty(spark), model).count() == 0
    only = spark.createDataFrame([(4, 1)], "doc_id bigint, quality int")
    assert 0 < quality.fit_from_labels(corpus.odd(spark).where("doc_id = 4"), only).prior <= 1


def test_query_agrees_with_a_plain_fit(spark):
    """Non-negative PU risk over all rows at once, in one process, with the share of good texts that the model found."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    texts = [r.text for r in docs.collect()]
    ids = [r.doc_id for r in docs.collect()]
    model = quality.fit_from_labels(docs, labels)
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and zlib.crc32(str(r.doc_id).encode()) % 5}
    raw = quality.text_features(pa.array(texts)).astype(np.float16).astype(np.float64)
    x = ((raw - raw.mean(0)) / np.sqrt(np.maximum(raw.var(0), 1e-6))).clip(-8, 8)
    x = np.hstack([x, np.ones((len(x), 1))])
    sure = np.array([i in good for i in ids])
    p, u, prior = x[sure], x[~sure], model.prior

    def risk(w):
        positive, negative = np.logaddexp(0, -(p @ w)).mean(), np.logaddexp(0, p @ w).mean()
        rest = np.logaddexp(0, u @ w).mean() - prior * negative
        return prior * positive + max(0.0, rest), rest

    w = np.zeros(x.shape[1])
    for step in range(2000):
        at_p, at_u = 1 / (1 + np.exp(-(p @ w))), 1 / (1 + np.exp(-(u @ w)))
        rest = u.T @ at_u / len(u) - prior * (p.T @ at_p) / len(p)
        gradient = prior * (p.T @ (at_p - 1)) / len(p) + rest if risk(w)[1] >= 0 else -rest
        gradient[:-1] += 1e-4 * w[:-1]
        w -= 0.02 * gradient
    own = np.append(model.weights, model.bias)
    assert risk(own)[0] < risk(np.zeros_like(w))[0] / 2 and abs(risk(own)[0] - risk(w)[0]) < 0.1
    plain = 1 / (1 + np.exp(-(x @ w))) >= 0.3
    got = {r.doc_id: r.predicted == 1 for r in QUERIES["op6_quality"](spark, SF_DIR).collect()}
    assert np.mean([got[i] == q for i, q in zip(ids, plain, strict=True)]) > 0.95


def test_the_driver_gets_the_drawn_rows_only(spark, monkeypatch):
    """Of all trusted rows, those of the smallest hashes, copies included, and few others are sorted."""
    rng = np.random.default_rng(6)
    cells = [x.astype(np.float16).tobytes() for x in rng.random((3000, quality.DIMENSIONS))]
    cells += cells[:40] * 3
    rows = [(c, i % 5 != 0) for i, c in enumerate(cells)]
    vectors = spark.createDataFrame(rows, "features binary, trusted boolean").repartition(12)
    frame, sorted_rows, taken = type(vectors), [], []
    limit, fit = frame.limit, quality._rounds
    monkeypatch.setattr(frame, "limit", lambda df, n: sorted_rows.append(df.count()) or limit(df, n))
    monkeypatch.setattr(quality, "_rounds", lambda u, p, *a: taken.append(p) or fit(u, p, *a))
    quality.fit_quality(vectors, F.col("trusted"), max_positives=500, rounds=1)
    monkeypatch.undo()
    assert max(sorted_rows) < 600
    plain = vectors.where("trusted").orderBy(F.xxhash64("features")).limit(500).collect()
    got = sorted(x.astype(np.float16).tobytes() for x in taken[-1])
    assert got == sorted(r.features for r in plain)
