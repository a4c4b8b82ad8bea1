"""Quality classifier: n-gram indicators scaled by naive Bayes log-count ratios, then a linear SVM.

A text is the set of its hashed byte n-grams. Each indicator is multiplied by the logarithm of how
much more often its n-gram appears under label 1 than under label 0, the vector is brought to unit
length, and a hinge-loss model is fitted by dual coordinate descent. A logistic curve fitted to
out-of-fold margins turns a margin into a probability of label 1.

Defined results: NULL and empty texts have no n-gram, so their margin is the intercept; rows with a
NULL label are not learned from; a document labelled twice counts twice; equal texts score alike.
With no label at all every score is 1, with labels of one class only every score is that class.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roster.llm.batches import hashed_grams, slices, text_bytes

BITS = 18
ORDERS = (2, 3, 4)
SAMPLE_PER_CLASS = 2000


@dataclass(frozen=True)
class QualityModel:
    """``ratios`` scale the indicators, ``weights`` are the fitted ones times those ratios."""

    ratios: np.ndarray
    weights: np.ndarray
    intercept: float
    slope: float
    offset: float
    constant: float | None = None

    def score(self, features: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        margin = self.intercept
        if len(features):
            scale = self.ratios[features]
            norm = float(np.sqrt(np.dot(scale, scale)))
            if norm:
                margin += float(self.weights[features].sum(dtype=np.float64)) / norm
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -60, 60))))


def text_features(data: np.ndarray) -> np.ndarray:
    """The distinct hashed n-grams of one text, ascending."""
    grams = [hashed_grams(data, order, BITS) for order in ORDERS]
    return np.unique(np.concatenate(grams)).astype(np.int32)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, sample: int = SAMPLE_PER_CLASS) -> QualityModel:
    """Fit on at most ``sample`` documents of each class, those whose hashed id is smallest.

    The ids are chosen from the label table, so only chosen texts are turned into features. At most
    ``2 * sample`` sets of n-grams reach the driver.
    """
    known = labels.where(may_learn & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = [
        known.where(F.col(label) == value)
        .select("doc_id", F.lit(value).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        for value in (0, 1)
    ]
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    found = rows.select("doc_id", "text", "label").mapInArrow(_featured, "doc_id long, label int, features binary").collect()
    found.sort(key=lambda row: (row.doc_id, row.label, row.features))
    return fit([np.frombuffer(row.features, np.int32) for row in found], np.array([row.label for row in found]))


def _featured(batches):
    for part in slices(batches, "text"):
        data, offsets = text_bytes(part.column("text"))
        features = [text_features(data[a:b]).tobytes() for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id").cast(pa.int64()), part.column("label").cast(pa.int32()), pa.array(features, pa.binary())],
            ["doc_id", "label", "features"],
        )


def fit(features: list[np.ndarray], labels: np.ndarray) -> QualityModel:
    """The model of sets of n-grams and their labels 0 or 1."""
    none = np.zeros(0, np.float32)
    if len(set(labels.tolist())) < 2:
        return QualityModel(none, none, 0.0, 0.0, 0.0, float(labels[0]) if len(labels) else 1.0)
    ratios = _log_count_ratios(features, labels)
    vectors = [_scaled(f, ratios) for f in features]
    folds = np.arange(len(labels)) % 3
    margins = np.zeros(len(labels))
    for fold in range(3):
        inside = np.flatnonzero(folds != fold)
        if len(set(labels[inside].tolist())) < 2:
            inside = np.arange(len(labels))
        part = _log_count_ratios([features[i] for i in inside], labels[inside])
        weights, intercept = dual_descent([features[i] for i in inside], [_scaled(features[i], part) for i in inside], labels[inside])
        for i in np.flatnonzero(folds == fold):
            margins[i] = intercept + float(np.dot(weights[features[i]], _scaled(features[i], part)))
    slope, offset = _logistic(margins, labels)
    weights, intercept = dual_descent(features, vectors, labels)
    return QualityModel(ratios, (weights * ratios).astype(np.float32), intercept, slope, offset)


def _log_count_ratios(features: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = [np.ones(1 << BITS), np.ones(1 << BITS)]
    for indices, label in zip(features, labels):
        counts[label][indices] += 1
    totals = [1 + int((labels == value).sum()) for value in (0, 1)]
    return np.log((counts[1] / totals[1]) / (counts[0] / totals[0])).astype(np.float32)


def _scaled(indices: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    values = ratios[indices]
    norm = float(np.sqrt(np.dot(values, values)))
    return values / norm if norm else values


def dual_descent(features, vectors, labels, cost: float = 4.0, rounds: int = 12, size: int = 1 << BITS) -> tuple[np.ndarray, float]:
    """Hinge loss with an intercept as a constant feature; rarer labels cost more, so both weigh the same."""
    signs = np.where(labels == 1, 1.0, -1.0)
    share = {s: max(1, int((signs == s).sum())) for s in (1.0, -1.0)}
    limits = [cost * len(labels) / (2 * share[s]) for s in signs]
    diagonal = [float(np.dot(v, v)) + 1.0 for v in vectors]
    duals = np.zeros(len(labels))
    weights, intercept = np.zeros(size), 0.0
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(labels)):
            sign = signs[i]
            gradient = sign * (float(np.dot(weights[features[i]], vectors[i])) + intercept) - 1
            new = min(max(duals[i] - gradient / diagonal[i], 0.0), limits[i])
            step = (new - duals[i]) * sign
            if step:
                duals[i] = new
                weights[features[i]] += step * vectors[i]
                intercept += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, intercept


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1, by Newton steps with smoothed targets."""
    ones, zeros = int((labels == 1).sum()), int((labels == 0).sum())
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    theta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -60, 60)))
        slope = x.T @ (p - target) + 1e-6 * theta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        theta -= step / max(1.0, float(np.abs(step).max()) / 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id`` and ``score`` of every row, over its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for part, scores in _scores(batches, shared.value):
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(scores)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double")


def keep_quality(docs: DataFrame, model: QualityModel, threshold: float) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches):
        for part, scores in _scores(batches, shared.value):
            yield part.filter(pa.array(scores >= threshold))

    return docs.mapInArrow(kept, docs.schema)


def _scores(batches, model: QualityModel):
    for part in slices(batches, "text"):
        data, offsets = text_bytes(part.column("text"))
        yield part, np.array([model.score(text_features(data[a:b])) for a, b in zip(offsets, offsets[1:])], float)
