"""Language identification: sparse multinomial logistic regression on character n-grams.

A text is the TF-IDF vector of its hashed character n-grams (one to three
lower-cased characters, runs of other characters than letters as one space).
The weights are trained with follow-the-regularized-leader-proximal updates with
L1 and L2 penalties (McMahan et al., "Ad click prediction: a view from the
trenches"), so most are zero. A temperature fitted on rows left out of the
training scales the probabilities.

Document frequencies count all rows of the training fold. The weights are
trained on a sample of about ``per_language`` rows of each language, a
documented bound, in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import fold, sampled, small_batches, sum_over_partitions
from eventloom.staging import stage

BUCKETS = 1 << 15
#: Characters that are hashed at once.
PIECE = 1 << 20
UNDETERMINED = "und"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - 15)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


class _Map:
    """Code points to themselves if letters, else to a space; by table for the first plane."""

    table: np.ndarray | None = None

    @classmethod
    def apply(cls, points: np.ndarray) -> np.ndarray:
        if cls.table is None:
            cls.table = np.array([c if not 0xD800 <= c <= 0xDFFF and chr(c).isalpha() else 32 for c in range(0x10000)], dtype=np.uint64)
        return np.where(points < 0x10000, cls.table[np.minimum(points, 0xFFFF)], points.astype(np.uint64))


def ngram_counts(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur in the text, which is read in pieces."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    padded = f" {text.lower()} " if text else ""
    before = np.zeros(0, dtype=np.uint64)
    for at in range(0, len(padded), PIECE):
        c = _Map.apply(np.frombuffer(padded[at : at + PIECE].encode("utf-32-le", "replace"), dtype=np.uint32))
        follows = np.concatenate([before[-1:] if len(before) else np.ones(1, dtype=np.uint64), c[:-1]])
        both = np.concatenate([before, c[(c != 32) | (follows != 32)]])
        gram = both
        for n in (1, 2, 3):
            if n > 1:
                gram = gram[:-1] * np.uint64(0x100000001B3) + both[n - 1 :]
            new = gram[max(0, len(before) - n + 1) :]
            counts += np.bincount(((new + np.uint64(n)) * _ODD >> _SHIFT).astype(np.int64), minlength=BUCKETS)
        before = both[-2:]
    return counts


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return tfidf(ngram_counts(text), self.idf)

    def probabilities(self, text: str) -> np.ndarray:
        at, x = self.vector(text)
        return softmax(x @ self.weights[at] / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        p = self.probabilities(text)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def tfidf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(counts)
    x = np.log1p(counts[at]) * idf[at]
    norm = np.sqrt(x @ x)
    return at, x / norm if norm else x


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_languages: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = 4, seed: int = 3) -> np.ndarray:
    """Weights of a multinomial model: rows are (indexes, values, language)."""
    z, n = np.zeros((BUCKETS, n_languages)), np.zeros((BUCKETS, n_languages))

    def weights(z, n):
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((beta + np.sqrt(n)) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i]
            w = weights(z[at], n[at])
            error = softmax(x @ w)
            error[y] -= 1
            g = np.outer(x, error)
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    return weights(z, n)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on a grid of powers."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.2), np.log(5), 120))
    losses = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def fit_language(docs: DataFrame, per_language: int = 800, seed: int = 11) -> LanguageModel:
    """Fit on the rows of ``docs`` (id, ``text``, ``lang``) with a language and a letter.

    ``per_language`` bounds the expected rows of a language in the sample for
    the weights, drawn by id and text, so that texts that share an id, or have none, are
    drawn one by one; the document frequencies are those of all rows.
    """
    rows = small_batches(docs).select("doc_id", "text", "lang").where("lang is not null and text is not null and text <> ''")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(BUCKETS + 1)
        for batch in batches:
            for text in batch.column("text"):
                total[:-1] += ngram_counts(text.as_py()) > 0
                total[-1] += 1
        return total

    df = sum_over_partitions(rows.select("text"), frequencies)
    if df is None or not df[-1]:
        return LanguageModel([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), 1.0)
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    per = stage(rows.groupBy("lang").count().select("lang", F.least(F.lit(1.0), per_language / F.col("count")).alias("fraction")), "languages")
    drawn = rows.join(per, "lang").where(sampled(["doc_id", "text"], F.col("fraction"), seed)).select("doc_id", "text", "lang")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [tfidf(ngram_counts(t.as_py()), idf) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").cast(pa.string()),
                    "lang": batch.column("lang"),
                    "at": pa.array([a.astype("<i4").tobytes() for a, _ in found], pa.binary()),
                    "x": pa.array([x.astype("<f4").tobytes() for _, x in found], pa.binary()),
                }
            )

    def train(_: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values(["doc_id", "lang"], na_position="first")
        languages = sorted(set(sample.lang))
        rows = [(np.frombuffer(a, "<i4"), np.frombuffer(x, "<f4").astype(float), languages.index(lang)) for a, x, lang in zip(sample["at"], sample["x"], sample.lang, strict=True)]
        left_out = np.random.default_rng(seed).random(len(rows)) < 0.2
        weights = train_ftrl([r for r, out in zip(rows, left_out, strict=True) if not out], len(languages))
        check = [r for r, out in zip(rows, left_out, strict=True) if out]
        logits = np.array([x @ weights[at] for at, x, _ in check]).reshape(len(check), len(languages))
        temperature = fit_temperature(logits, np.array([y for *_, y in check], dtype=int))
        return pd.DataFrame({"languages": [languages], "weights": [weights.tobytes()], "temperature": [temperature]})

    sample = drawn.mapInArrow(vectors, "doc_id string, lang string, at binary, x binary")
    fitted = sample.groupBy(F.lit(0).alias("all")).applyInPandas(train, "languages array<string>, weights binary, temperature double").collect()
    if not fitted:
        return LanguageModel([], idf, np.zeros((BUCKETS, 0)), 1.0)
    languages = list(fitted[0].languages)
    return LanguageModel(languages, idf, np.frombuffer(fitted[0].weights).reshape(BUCKETS, len(languages)), fitted[0].temperature)


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the probability of that language.

    ``und`` and 0 where the text is null or has no letter, or where the model
    has learned no language.
    """
    sent = small_batches(docs).sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(column: pd.Series) -> pd.DataFrame:
        fitted = sent.value
        return pd.DataFrame([fitted.predict(t) for t in column], columns=["lang_pred", "score"]).astype({"lang_pred": "object", "score": "float64"})

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*kept, predicted(docs[text_col]).alias("_language")).select(*kept, "_language.lang_pred", "_language.score")


def identify_languages(docs: DataFrame, per_language: int = 800) -> DataFrame:
    """All rows and columns of ``docs`` with the predicted language.

    Learns from the rows whose fold (CRC-32 of the id, modulo 3) is not 1 and
    whose ``lang`` is not null. Equal texts get equal predictions; an empty
    table gives no rows.
    """
    model = fit_language(docs.where(fold("doc_id", 3) != 1), per_language)
    return with_language(docs, model)
