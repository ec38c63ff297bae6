"""Quality classifier: random Fourier features, ridge scores, isotonic scale.

1. Every text becomes ``N_STATS`` document statistics (character classes, word
   and line repetition, lengths); they are staged once, a few bytes a row.
2. Statistics are standardised and mapped to ``N_FOURIER`` cosine features,
   whose inner products approximate a Gaussian kernel.
3. Each partition sums its normal equations over the labelled rows of the fit
   fold; the sums are added by Spark and one small ridge system is solved.
4. On the calibration fold, ridge scores are counted in ``N_BINS`` bins; the
   pool-adjacent-violators rule makes them a rising step function, which is
   interpolated between its steps.

All labelled rows of the two folds are used; nothing is sampled.  Defined
results: null and empty texts have all-zero statistics and get a score like any
other text; a row without a label teaches nothing; several labels of a document
count as their mean; without any usable label every score is 0.5 (kept);
repeated rows get equal scores; extra columns are kept out.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .token_cache import blocks

N_FOURIER, N_BINS, RIDGE, SEED = 256, 512, 1e-3, 5
LOW, HIGH = -0.5, 1.5  # range of ridge scores told apart by the calibration
_CLASS = np.zeros(256, np.int64)
for _name, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r",
                                b"\n", b".,;:?'\"-()", b"!", b"|", b"#$%&*+/<=>@[\\]^_`{}~", bytes(range(128, 256)))):
    _CLASS[list(_chars)] = _name + 1
N_CLASSES = int(_CLASS.max()) + 1
N_STATS = N_CLASSES + 11


def stats(text: str | None) -> list[float]:
    """Statistics of one whole text; all zero without any character."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * N_STATS
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = np.bincount(_CLASS, weights=by_byte, minlength=N_CLASSES) / len(raw)
    words, lines = raw.split(), raw.split(b"\n")
    n = max(1, len(words))
    distinct = len(set(words))
    again = sum(map(bytes.__eq__, words, words[1:]))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    ends = sum(w[-1] in b".,;:!?" for w in words)
    marked = sum(w[-1] in b"!#$%&*|~" for w in words)
    return [*shares.tolist(), np.log1p(len(raw)), np.log1p(len(words)), distinct / n, distinct / n ** 0.5, again / n,
            float(sizes.mean()), float(sizes.std()), ends / n, marked / n, np.log1p(len(lines)),
            len(set(lines)) / len(lines)]


def with_stats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, stats) of every row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([stats(t) for _, some in blocks(b.column(1)) for t in some], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), found], names=["key", "stats"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        work, f"key {kind}, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)


def _sums(df: DataFrame, fn) -> np.ndarray:
    """Sum of ``fn(batch)`` (a flat array) over all rows, added by Spark."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("OMP_NUM_THREADS", "1")
        total = None
        for b in batches:
            if b.num_rows:
                got = fn(b)
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)],
                                             names=["at", "value"])

    rows = df.mapInArrow(work, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(rows))
    for r in rows:
        out[r["at"]] = r["value"]
    return out


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    calibrated: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        f = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([f, np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.raw):
            return np.full(len(x), 0.5)
        return np.interp(self.ridge(x), self.raw, self.calibrated)


def isotonic(weight: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Rising least-squares fit of weighted values (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for w, v in zip(weight.tolist(), value.tolist()):
        blocks.append([w, v, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, v2, n2 = blocks.pop()
            w1, v1, n1 = blocks[-1]
            blocks[-1] = [w1 + w2, (w1 * v1 + w2 * v2) / (w1 + w2), n1 + n2]
    return np.concatenate([np.full(int(n), v) for _, v, n in blocks]) if blocks else np.zeros(0)


def held_out(key: str = "doc_id", parts: int = 3, left_out: int = 1) -> Column:
    return fold(key, parts) == left_out


def fold(key: str, parts: int = 3) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts, F.lit(0))


def fit(found: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
        fit_fold: int = 0, calibration_fold: int = 2) -> QualityModel:
    """Learn from ``found`` (key, stats) and labels of the two folds."""
    def moments(b: pa.RecordBatch) -> np.ndarray:
        x = _matrix(b.column(0))
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])

    got = _sums(found.select("stats"), moments)
    n = max(1.0, got[0]) if len(got) else 1.0
    sums = got[1:].reshape(2, -1) if len(got) else np.zeros((2, N_STATS))
    mean = sums[0] / n
    scale = np.sqrt(np.maximum(sums[1] / n - mean ** 2, 0))
    rng = np.random.default_rng(SEED)
    model = QualityModel(mean, np.where(scale > 1e-9, scale, 1.0),
                         rng.normal(size=(N_STATS, N_FOURIER)) / np.sqrt(N_STATS),
                         rng.uniform(0, 2 * np.pi, N_FOURIER), np.zeros(N_FOURIER + 1), np.zeros(0), np.zeros(0))
    taught = (labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("y")).filter("y is not null")
              .groupBy("key").agg(F.avg("y").alias("y")))
    rows = found.join(taught, "key").select("stats", "y", fold("key").alias("fold")).filter(
        F.col("fold").isin(fit_fold, calibration_fold))
    rows = stage(rows, "taught")

    def normal(b: pa.RecordBatch) -> np.ndarray:
        z, y = model.features(_matrix(b.column(0))), b.column(1).to_numpy()
        return np.concatenate([[len(y)], (z.T @ z).ravel(), z.T @ y])

    m = N_FOURIER + 1
    got = _sums(rows.filter(F.col("fold") == fit_fold).select("stats", "y"), normal)
    if not len(got):
        return model
    penalty = np.eye(m) * RIDGE * got[0]
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(got[1:1 + m * m].reshape(m, m) + penalty, got[1 + m * m:])

    def counts(b: pa.RecordBatch) -> np.ndarray:
        raw, y = model.ridge(_matrix(b.column(0))), b.column(1).to_numpy()
        at = np.clip(((raw - LOW) / (HIGH - LOW) * N_BINS).astype(int), 0, N_BINS - 1)
        return np.concatenate([np.bincount(at, minlength=N_BINS), np.bincount(at, y, N_BINS),
                               np.bincount(at, raw, N_BINS)])

    got = _sums(rows.filter(F.col("fold") == calibration_fold).select("stats", "y"), counts)
    if not len(got):  # too few labels for a second fold: plain ridge scores
        model.raw, model.calibrated = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        return model
    weight, y, raw = got.reshape(3, N_BINS)
    used = weight > 0
    model.raw = np.sort(raw[used] / weight[used])
    model.calibrated = np.clip(isotonic(weight[used], y[used] / weight[used]), 0, 1)
    return model


def score_stats(found: DataFrame, model: QualityModel) -> DataFrame:
    """(key, score) from staged statistics."""
    kind = found.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_matrix(b.column(1))))],
                                             names=["key", "score"])

    return found.mapInArrow(work, f"key {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every document."""
    found = stage(with_stats(docs, key, text), "stats")
    scored = score_stats(found, fit(found, labels, key))
    return scored.select(F.col("key").alias(key), held_out("key").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def scorer(model: QualityModel):
    """A column function: score of a text column under a learnt model."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.array([stats(t) for t in texts])))

    return score
