"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of each whole text (shares of character classes, word lengths, repetition, entropy, ...) are
standardised on the training rows; random Fourier features approximate a Gaussian kernel over them.
Every partition sums its own normal equations (X'X, X'y), whose size depends on the number of features
alone; the sums are added and solved for ridge weights. Training scores are then summed in bins, and
pool-adjacent-violators over the bins gives the isotonic map from score to probability.

Edge cases: NULL and empty texts have all-zero statistics and get a score like others; texts of any length are
read whole; a label is taken only where it is not NULL (several for one id: the largest); without training rows
every score is 0.5; rows with equal statistics get equal scores, so repeated rows and ties do; an empty table gives
an empty result. Other columns of docs and labels are not read and may have any name.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import release, small_batches, staged, table
from flowloom.llm.learning import crc_mod, matrix, summed, unique_labels

FEATURES, WIDTH, RIDGE, BINS, SEED = 256, 4.0, 1.0, 400, 11
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER, _DIGIT, _SPACE = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91], _DIGIT[48:58] = True, True
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_END = np.zeros(256, bool)
_END[[33, 46, 63]] = True
_COMMA = np.zeros(256, bool)
_COMMA[[44, 58, 59]] = True
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
STATISTICS = 20


def statistics(text: str | None) -> np.ndarray:
    """The document's statistics; all zero without a word."""
    data = (text or "").encode()
    words = _WORD.findall(data)
    if not words:
        return np.zeros(STATISTICS)
    n = len(data)
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = lambda m: hist[m].sum() / n
    p = hist[hist > 0] / n
    letters, upper = share(_LETTERS), share(_UPPER)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    counts = Counter(words)
    distinct, whole = len(counts), len(words)
    other = 1 - letters - share(_DIGIT) - share(_SPACE) - share(_END) - share(_COMMA)
    top = max(counts.values()) / whole
    return np.array([
        np.log1p(n), np.log1p(whole), lengths.mean(), lengths.std(), letters, upper / max(letters, 1e-9), share(_DIGIT), share(_SPACE), share(_END), share(_COMMA),
        other, -(p * np.log2(p)).sum(), distinct / whole, distinct / whole**0.5, same / whole, len(set(lines)) / len(lines), np.log1p(whole / len(lines)), top,
        float((lengths == 1).mean()), hist[124] / whole,
    ])


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x array<double>), one row for each row of df."""

    def work(batches):
        release()
        for b in batches:
            x = [statistics(t.as_py()) for t in b["text"]]
            flat = pa.array(np.concatenate(x) if x else np.empty(0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * STATISTICS), flat)
            yield pa.RecordBatch.from_arrays([b["doc_id"], lists], ["doc_id", "x"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, "doc_id long, x array<double>")


class Model:
    """Standardisation, random features, ridge weights and the isotonic steps: a few thousand numbers."""

    def __init__(self, mean, scale, features=FEATURES, width=WIDTH, seed=SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.asarray(mean), np.asarray(scale)
        self.w = rng.normal(size=(len(self.mean), features)) / width
        self.b = rng.uniform(0, 2 * np.pi, features)
        self.weights = self.steps = None

    def transform(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        f = np.cos(z @ self.w + self.b) * (2 / len(self.b)) ** 0.5
        return np.hstack([np.ones((len(x), 1)), z, f])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.transform(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        edges, values = self.steps
        return np.clip(np.interp(self.raw(x), edges, values), 0, 1)


def isotonic(weights: np.ndarray, means: np.ndarray) -> np.ndarray:
    """Non-decreasing fit to the means under the weights (pool adjacent violators)."""
    pools: list[list[float]] = []
    for w, m in zip(weights, means):
        pools.append([w, m, 1])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            w2, m2, n2 = pools.pop()
            w1, m1, n1 = pools.pop()
            pools.append([w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), n1 + n2])
    return np.repeat([p[1] for p in pools], [int(p[2]) for p in pools])


def fit(train: DataFrame, width: int = STATISTICS, features: int = FEATURES, ridge: float = RIDGE) -> Model:
    """Fit on all rows of train (x array<double>, label 0/1); two passes of sums and one for calibration."""
    s = summed(train, width, 2 * width + 1, lambda x, y: np.concatenate([x.sum(0), (x * x).sum(0), [len(x)]]))
    n = s[-1]
    mean = s[:width] / max(n, 1)
    spread = np.sqrt(np.maximum(s[width:-1] / max(n, 1) - mean**2, 0))
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0), features)
    if not n:
        return model
    m = 1 + width + features

    def equations(x, y):
        f = model.transform(x)
        return np.concatenate([(f.T @ f).ravel(), f.T @ y])

    e = summed(train, width, m * m + m, equations)
    penalty = np.full(m, ridge)
    penalty[0] = 1e-6
    weights = np.linalg.solve(e[:-m].reshape(m, m) + np.diag(penalty), e[-m:])
    low, high = -0.5, 1.5

    def binned(x, y):
        at = np.clip(((model.transform(x) @ weights - low) / (high - low) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)])

    c = summed(train, width, 2 * BINS, binned)
    held = c[:BINS] > 0
    centres = (low + (np.arange(BINS) + 0.5) * (high - low) / BINS)[held]
    model.weights, model.steps = weights, (centres, isotonic(c[:BINS][held], c[BINS:][held] / c[:BINS][held]))
    return model


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out=None, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs; rows that held_out (a Column over doc_id) marks teach nothing."""
    small_batches(docs.sparkSession)
    held = F.lit(False) if held_out is None else held_out
    x = staged(document_statistics(docs, id_col, text_col), "statistics")
    model = fit(x.filter(~held).join(unique_labels(labels, label, "doc_id"), "doc_id").select("x", "label"))

    def work(batches):
        for b in batches:
            s = model.score(matrix(b["x"], STATISTICS)) if len(b) else np.empty(0)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return x.select("doc_id", held.alias("held_out"), "x").mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", crc_mod(F.col("doc_id"), 3) == 1)
