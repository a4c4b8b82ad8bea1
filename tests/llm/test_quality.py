"""The quality classifier: the fit against a plain solver, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roster.llm.quality import BITS, dual_descent, fit, fit_quality, keep_quality, score_quality, text_features
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.01"


def features(text):
    return text_features(np.frombuffer(text.encode(), np.uint8))


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def model(corpus):
    return fit_quality(*corpus, "quality", F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


def test_held_out_accuracy(corpus, model):
    docs, labels = corpus
    scored = score_quality(docs, model).join(labels, "doc_id").collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 50 and all(0 <= r.score <= 1 for r in scored)
    assert np.mean([(r.score >= 0.3) == r.quality for r in held]) > 0.93
    assert np.mean([r.score >= 0.3 for r in held if r.quality == 1]) > 0.97


def test_the_sample_is_bounded_and_held_out_labels_are_not_used(corpus):
    docs, labels = corpus
    may_learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    flipped = labels.withColumn("quality", F.when(may_learn, F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = (fit_quality(docs, x, "quality", may_learn, sample=30) for x in (labels, flipped))
    assert np.array_equal(a.weights, b.weights) and a.intercept == b.intercept


def test_dual_descent_reaches_the_optimum():
    """The primal objective is no worse than that of many subgradient steps."""
    pick = np.random.default_rng(2)
    rows = [np.sort(pick.choice(12, 5, replace=False)).astype(np.int32) for _ in range(40)]
    vectors = [pick.normal(size=5).astype(np.float32) for _ in rows]
    labels = np.array([int(v.sum() + 0.3 * pick.normal() > 0) for v in vectors])
    weights, intercept = dual_descent(rows, vectors, labels, cost=1.0, rounds=500, size=12)
    dense = np.zeros((40, 13))
    for row, indices, vector in zip(dense, rows, vectors):
        row[indices], row[12] = vector, 1
    signs = np.where(labels == 1, 1, -1)
    costs = np.where(labels == 1, 40 / (2 * labels.sum()), 40 / (2 * (1 - labels).sum()))

    def objective(w):
        return 0.5 * w @ w + costs @ np.maximum(0, 1 - signs * (dense @ w))

    best, w = np.inf, np.zeros(13)
    for step in range(1, 20_000):
        out = signs * (dense @ w) < 1
        w -= (w - (costs * signs * out) @ dense) / step
        best = min(best, objective(w))
    assert objective(np.append(weights, intercept)) <= best * 1.001


def test_ratios_of_counts():
    model = fit([features("good good"), features("good day"), features("bad")], np.array([1, 1, 0]))
    both, only = features("good")[0], [f for f in features("bad") if f not in features("good day good")][0]
    assert model.ratios[both] == pytest.approx(np.log((3 / 3) / (1 / 2)))
    assert model.ratios[only] == pytest.approx(np.log((1 / 3) / (2 / 2)))
    assert len(model.ratios) == 1 << BITS


def test_odd_rows(odd, none, model):
    scores = score_quality(odd, model).collect()
    assert sorted((str(r.doc_id) for r in scores)) == sorted(str(i) for i, _ in ODD)
    assert all(0 <= r.score <= 1 for r in scores)
    assert len({r.score for r in scores if r.doc_id in (1, 2)}) == 1
    kept = keep_quality(odd, model, 0.0)
    assert kept.columns == odd.columns and kept.count() == len(ODD)
    assert keep_quality(odd, model, 1.1).count() == 0
    assert score_quality(none, model).collect() == [] and keep_quality(none, model, 0.3).collect() == []


def test_labels_of_one_class_or_none(spark, odd):
    labels = spark.createDataFrame([(4, 1), (5, None), (None, 0), (4, 1)], "doc_id long, quality int")
    assert {r.score for r in score_quality(odd, fit_quality(odd, labels, "quality", F.lit(True))).collect()} == {1.0}
    labels = spark.createDataFrame([(4, 0)], "doc_id long, quality int")
    assert {r.score for r in score_quality(odd, fit_quality(odd, labels, "quality", F.lit(True))).collect()} == {0.0}
    assert fit_quality(odd, labels.limit(0), "quality", F.lit(True)).constant == 1.0
