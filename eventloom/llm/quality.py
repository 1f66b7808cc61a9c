"""Document quality: random Fourier features, ridge regression, isotonic calibration.

A document is described by statistics of its whole text. Random Fourier features
(Rahimi and Recht) turn these into coordinates whose inner products approximate
a Gaussian kernel. The ridge weights solve the normal equations, whose matrix
and right side are sums over rows: each partition sums its rows, the sums are
added on executors, and the driver solves one system of fixed size. Isotonic
regression over a histogram of scores makes probabilities of them; it is fitted on a fifth
of the rows, chosen by their statistics, that the ridge weights are not fitted on.

All labelled rows of the training fold take part; there is no sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import fold, small_batches, sum_over_partitions
from eventloom.staging import stage

#: Bins of the score histogram that the calibration is fitted on.
BINS = 2048
_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_PUNCTUATION = np.array([c for c in range(33, 127) if not chr(c).isalnum()])
_SENTENCE = np.frombuffer(b".,;:?-'\"()", dtype=np.uint8)
_SYMBOLS = np.array([c for c in _PUNCTUATION if c not in _SENTENCE])
N_STATISTICS = 22


def statistics(text: str) -> np.ndarray:
    """Statistics of one text; all are finite, also for an empty one."""
    raw = text.encode("utf-8", "replace")
    n = len(raw)
    out = np.zeros(N_STATISTICS)
    if not n:
        return out
    bytes_ = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    words, lines = raw.split(), raw.split(b"\n")
    n_words, n_lines = len(words), len(lines)
    upper, lower = bytes_[_UPPER].sum(), bytes_[_LOWER].sum()
    share = bytes_[bytes_ > 0] / n
    unique_lines = set(lines)
    out[:12] = (
        np.log1p(n),
        np.log1p(n_words),
        np.log1p(n / n_lines),
        upper / (upper + lower + 1),
        bytes_[_DIGIT].sum() / n,
        bytes_[_SENTENCE].sum() / n,
        bytes_[_SYMBOLS].sum() / n,
        bytes_[33] / n,
        (bytes_[9:14].sum() + bytes_[32]) / n,
        bytes_[128:].sum() / n,
        -(share * np.log2(share)).sum(),
        bytes_[:32].sum() / n,
    )
    out[12] = len(unique_lines) / n_lines
    out[13] = 1 - sum(map(len, unique_lines)) / max(1, sum(map(len, lines)))
    if n_words:
        unique = set(words)
        sizes = np.fromiter(map(len, words), np.int64, n_words)
        out[14:] = (
            len(unique) / n_words,
            len(unique) / np.sqrt(n_words) / 10,
            sum(map(bytes.__eq__, words, words[1:])) / n_words,
            sizes.mean() / 10,
            sizes.std() / 10,
            np.log1p(sizes.max()),
            bytes_[46] / n_words,
            bytes_[124] / n_words,
        )
    return out


def with_statistics(docs: DataFrame, text_col: str = "text", into: str = "statistics") -> DataFrame:
    """``docs`` with the array of statistics of each whole text; null is as empty."""

    @F.pandas_udf("array<double>")
    def described(column: pd.Series) -> pd.Series:
        return pd.Series([statistics(t or "") for t in column])

    return small_batches(docs).withColumn(into, described(docs[text_col]))


@dataclass(frozen=True)
class QualityModel:
    """Fitted weights; ``knots`` and ``values`` are the calibration."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, statistics_: np.ndarray) -> np.ndarray:
        return fourier(statistics_, self.mean, self.scale, self.frequencies, self.phases)

    def raw(self, statistics_: np.ndarray) -> np.ndarray:
        return self.features(statistics_) @ self.weights

    def score(self, statistics_: np.ndarray) -> np.ndarray:
        # products of matrices depend on the rows beside a row in the last bits
        return np.interp(np.round(self.raw(statistics_), 9), self.knots, self.values).round(9)


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, frequencies: np.ndarray, phases: np.ndarray) -> np.ndarray:
    """A constant, then cosines of random projections of the standardized statistics."""
    z = np.clip((x - mean) / scale, -6, 6)
    cosines = np.sqrt(2 / len(phases)) * np.cos(z @ frequencies + phases)
    return np.hstack([np.ones((len(z), 1)), cosines])


def matrix(column: pa.Array) -> np.ndarray:
    """A column of arrays of statistics as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def isotonic(bins: np.ndarray, positives: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Nondecreasing rates of consecutive bins: violators are pooled (one pass)."""
    pools: list[list[float]] = []
    for p, t in zip(positives, totals, strict=True):
        pools.append([p, t, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.concatenate([[p / t] * k for p, t, k in pools]) if len(bins) else np.array([])


def fit_quality(labelled: DataFrame, n_features: int = 192, bandwidth: float = 4.0, ridge: float = 1e-3, seed: int = 7, label_col: str = "quality") -> QualityModel:
    """Fit on rows with ``statistics`` and a 0/1 label; rows with a null label are left out.

    Without labelled rows each score is 0.5. The table is read three times, so
    hand over a staged one.
    """
    rows = labelled.select("statistics", F.col(label_col).cast("double").alias("y")).where("y is not null")
    # equal texts are on one side
    aside = F.pmod(F.xxhash64("statistics"), F.lit(5)) == 0
    calibrating = rows.where(aside)
    if calibrating.select("y").distinct().limit(2).count() == 2 and rows.where(~aside).select("y").distinct().limit(2).count() == 2:
        rows = rows.where(~aside)
    else:
        calibrating = rows
    d = N_STATISTICS

    def moments(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(2 * d + 1)
        for batch in batches:
            x = matrix(batch.column("statistics"))
            total += np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
        return total

    sums = sum_over_partitions(rows, moments)
    n = 0 if sums is None else int(sums[0])
    random = np.random.default_rng(seed)
    frequencies = random.normal(0, 1 / bandwidth, (d, n_features))
    phases = random.uniform(0, 2 * np.pi, n_features)
    if not n:
        return QualityModel(np.zeros(d), np.ones(d), frequencies, phases, np.zeros(n_features + 1), np.array([0.0]), np.array([0.5]))
    mean = sums[1 : d + 1] / n
    scale = np.sqrt(np.maximum(sums[d + 1 :] / n - mean * mean, 0))
    scale = np.where(scale > 1e-9, scale, 1.0)
    k = n_features + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        gram, right = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            z = fourier(matrix(batch.column("statistics")), mean, scale, frequencies, phases)
            gram += z.T @ z
            right += z.T @ batch.column("y").to_numpy()
        return np.concatenate([gram.ravel(), right])

    both = sum_over_partitions(rows, equations)
    gram, right = both[: k * k].reshape(k, k), both[k * k :]
    weights = np.linalg.solve(gram / n + ridge * np.diag([1e-6] + [1.0] * n_features), right / n)
    edges = np.linspace(-0.5, 1.5, BINS + 1)

    def histogram(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        counts = np.zeros((2, BINS))
        for batch in batches:
            score = fourier(matrix(batch.column("statistics")), mean, scale, frequencies, phases) @ weights
            at = np.clip(np.searchsorted(edges, score, "right") - 1, 0, BINS - 1)
            y = batch.column("y").to_numpy()
            counts += [np.bincount(at, y, BINS), np.bincount(at, minlength=BINS)]
        return counts.ravel()

    positives, totals = sum_over_partitions(calibrating, histogram).reshape(2, BINS)
    seen = totals > 0
    knots = ((edges[:-1] + edges[1:]) / 2)[seen]
    return QualityModel(mean, scale, frequencies, phases, weights, knots, isotonic(knots, positives[seen], totals[seen]))


def with_score(described: DataFrame, model: QualityModel, into: str = "score") -> DataFrame:
    """``described`` (with ``statistics``) with the calibrated probability of label 1."""

    @F.pandas_udf("double")
    def scored(column: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(column.to_numpy())) if len(column) else [], dtype="float64")

    return described.withColumn(into, scored("statistics"))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> DataFrame:
    """Statistics and label of the labelled rows whose fold is not 0, staged.

    A label row without id or label takes no part; of several labels of one id
    each counts. The join carries the texts of labelled rows only as statistics.
    """
    wanted = labels.select(F.col(id_col).alias("labelled_id"), F.col(label_col).alias(label_col)).where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    described = with_statistics(docs.select(F.col(id_col).alias("labelled_id"), F.col("text").alias("text")).where(fold(id_col, 5) != 0)).drop("text")
    return stage(stage(described, "quality-statistics").join(wanted, "labelled_id").select("statistics", label_col), "quality-labelled")


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` and ``predicted``.

    Learned from the rows of fold 1 to 4 (see :func:`eventloom.llm.common.fold`)
    that ``labels`` has; a score depends on the text alone, so repeated texts
    score alike, and a null text scores as an empty one.
    """
    model = fit_quality(training_rows(docs, labels))
    kept = [c for c in docs.columns if c not in ("score", "predicted", "statistics")]
    scored = with_score(with_statistics(docs.select(*kept)), model).drop("statistics")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
