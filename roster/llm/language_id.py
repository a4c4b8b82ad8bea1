"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1. For each bit of the code a linear classifier over hashed
character n-grams learns on which side a text lies. A text gets the language whose codeword has the
least hinge loss against the classifiers' outputs, where bits that separate the training texts better
weigh more. If the runner-up is nearly as close, the prediction is flagged as ambiguous.

Defined results: NULL texts and texts without a letter are ``und`` with score 0; rows with a NULL
language are not learned from; with no language to learn every text is ``und``, with one language
every text with a letter is that language. Ties go to the alphabetically first language.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roster.llm.batches import hashed_grams, slices
from roster.llm.quality import dual_descent

BITS = 16
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE, SAMPLE = 1000, 8000
EXHAUSTIVE_UP_TO = 6
UNDETERMINED = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # n-grams x bits
    intercepts: np.ndarray
    trust: np.ndarray  # weight of each bit in the decoding

    def predict(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        letters = only_letters(text)
        if not letters or not self.languages:
            return UNDETERMINED, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        features = text_features(letters)
        outputs = self.weights[features].sum(axis=0, dtype=np.float64) / np.sqrt(len(features)) + self.intercepts
        losses = np.maximum(0, 1 - self.code * outputs) @ self.trust / self.trust.sum()
        order = np.argsort(losses, kind="stable")
        likely = np.exp(-4 * (losses - losses[order[0]]))
        return self.languages[order[0]], float(1 / likely.sum()), bool(losses[order[1]] - losses[order[0]] < margin)


def only_letters(text: str | None) -> str:
    """Lower case, with everything between letters as one blank; empty if there is no letter."""
    if not text:
        return ""
    letters = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {letters} " if any(map(str.isalpha, letters)) else ""


def text_features(letters: str) -> np.ndarray:
    data = np.frombuffer(letters.encode("utf-8", "replace"), np.uint8)
    return np.unique(np.concatenate([hashed_grams(data, order, BITS) for order in ORDERS])).astype(np.int32)


def codewords(languages: int) -> np.ndarray:
    """All splits of the languages if they are few; else random splits, the set with the largest least distance of 200."""
    if languages <= EXHAUSTIVE_UP_TO:
        splits = np.arange(1, 1 << (languages - 1))
        return np.where((splits[None, :] >> np.arange(languages)[:, None]) & 1, -1, 1).astype(np.int8)
    bits, random, best, furthest = int(np.ceil(15 * np.log2(languages))), np.random.default_rng(11), None, -1
    for _ in range(200):
        code = random.choice(np.array([-1, 1], np.int8), (languages, bits))
        agree = (code.astype(np.float32) @ code.T.astype(np.float32)).astype(int)
        least = (bits - agree[~np.eye(languages, dtype=bool)].max()) // 2
        if least > furthest and (np.abs(code.sum(axis=0)) < languages).all():
            best, furthest = code, least
    return best


def fit_languages(
    docs: DataFrame, may_learn: Column, sample: int = SAMPLE_PER_LANGUAGE, total: int = SAMPLE
) -> LanguageModel:
    """Fit on at most ``sample`` texts of each language, and ``total`` of all, but for one text of each language.

    Texts with the smallest hashes of their ids are taken, the same number of each language, so that more languages
    mean fewer texts of each. They are chosen by narrow columns in one pass for all languages; then only
    their sets of n-grams reach the driver, and of equal rows one.
    """
    known = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages = sorted(row.lang for row in known.select("lang").distinct().collect())
    if len(languages) < 2:
        none = np.zeros((0, 0))
        return LanguageModel(languages, none, none, none, none)
    most = max(1, min(sample, total // len(languages)))
    marked = known.where(F.col("doc_id").isNotNull()).select("doc_id", "lang", F.xxhash64("text").alias("mark"))
    # Equal rows share a rank; Spark applies the limit in each task before the shuffle.
    rank = F.dense_rank().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "mark"))
    chosen = marked.withColumn("rank", rank).where(F.col("rank") <= most).select("doc_id", "lang", "mark").distinct()
    rows = known.select("doc_id", "text", "lang", F.xxhash64("text").alias("mark")).join(F.broadcast(chosen), ["doc_id", "lang", "mark"])
    found = rows.mapInArrow(_featured, "doc_id long, lang string, mark long, features binary").dropDuplicates(["doc_id", "lang", "mark"]).collect()
    found.sort(key=lambda row: (row.doc_id, row.lang, row.features))
    place = {language: i for i, language in enumerate(languages)}
    return fit(languages, [np.frombuffer(row.features, np.int32) for row in found], np.array([place[row.lang] for row in found]))


def _featured(batches):
    for part in slices(batches, "text"):
        ids, langs, marks, features = [], [], [], []
        for doc_id, text, lang, mark in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "lang", "mark"))):
            if letters := only_letters(text):
                ids.append(doc_id), langs.append(lang), marks.append(mark), features.append(text_features(letters).tobytes())
        columns = [pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(marks, pa.int64()), pa.array(features, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "mark", "features"])


def fit(languages: list[str], features: list[np.ndarray], classes: np.ndarray) -> LanguageModel:
    code = codewords(len(languages))
    vectors = [np.full(len(f), 1 / np.sqrt(len(f)), np.float32) for f in features]
    weights, intercepts, trust = [], [], []
    for bit in range(code.shape[1]):
        sides = (code[classes, bit] > 0).astype(int)
        if len(set(sides.tolist())) < 2:  # a language of which no text has letters
            fitted, intercept, wrong = np.zeros(1 << BITS), float(np.sign(sides.mean() - 0.5)) if len(sides) else 0.0, 0.5
        else:
            fitted, intercept = dual_descent(features, vectors, sides, cost=1.0, rounds=8, size=1 << BITS)
            margins = np.array([intercept + float(fitted[f].sum()) * v[0] for f, v in zip(features, vectors)])
            wrong = (float(((margins > 0) != sides).sum()) + 1) / (len(sides) + 2)
        weights.append(fitted), intercepts.append(intercept)
        trust.append(max(0.05, 0.5 * np.log((1 - min(wrong, 0.49)) / min(wrong, 0.49))))
    return LanguageModel(languages, code, np.stack(weights, axis=1).astype(np.float32), np.array(intercepts), np.array(trust))


def identify(docs: DataFrame, model: LanguageModel, margin: float = 0.1) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``ambiguous`` of every row, over its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches):
        for part in slices(batches, "text"):
            found = [shared.value.predict(text, margin) for text in part.column("text").to_pylist()]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*found), (pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *columns], ["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select("doc_id", "text").mapInArrow(predicted, "doc_id long, lang_pred string, score double, ambiguous boolean")
