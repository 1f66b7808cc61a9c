"""Toxicity: a small convolutional text classifier, trained in numpy.

A word is the sum of two hashed embeddings, filters of several widths run over
the words, each filter is max-pooled over the whole text, and a logistic layer
reads the maxima (after Kim, "Convolutional neural networks for sentence
classification"). One coordinate of an embedding starts as the smoothed log odds
of its bucket, so that the maxima find telling words from the first epoch on.

All labelled rows take part. They are dealt out to trainers by a hash of the id; in each
epoch every trainer goes once over its rows, starting from the same network, and
the changes are averaged (iterative parameter mixing: McDonald, Hall and Mann,
"Distributed training strategies for the structured perceptron"; a row of the
embeddings over the trainers that changed it). The odds count the rows of all trainers.
A quarter of the rows, chosen by their words, is not trained on and sets a threshold for
each language, and scores are shifted so that each threshold is at 0.5. The
language of a text is what the model of :mod:`eventloom.llm.langid` says of the
text itself, never a column.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import chunks, fold, maybe_in, sampled, small_batches, sum_over_partitions, texts
from eventloom.llm.langid import LanguageModel, fit_language
from eventloom.staging import stage, stage_buckets

BITS = 16
BUCKETS = 1 << BITS
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 10
#: Words that go through the network at once.
PIECE = 1 << 15
#: Bytes of text for one trainer; up to :data:`FEW_TRAINERS` trainers come for less text each.
TRAINER_BYTES, FEW_BYTES, FEW_TRAINERS = 32 << 20, 4 << 20, 16
#: Rows of the embeddings whose changes are averaged at once.
SLICE = 512
#: The filter, and the word within it, of each row of all kernels.
_FILTER = np.concatenate([np.tile(np.arange(FILTERS) + k * FILTERS, w) for k, w in enumerate(WIDTHS)])
_WORD = np.concatenate([np.repeat(np.arange(w), FILTERS) for w in WIDTHS])
_FIRST = np.flatnonzero(_WORD == 0)

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def word_hashes(text: str) -> np.ndarray:
    """CRC-32 of the lower-cased (A-Z) words of the text: runs of letters and digits."""
    words = text.encode("utf-8", "replace").translate(_TO_WORDS).split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def buckets(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two buckets of each hash, from disjoint bits after mixing."""
    mixed = hashes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64), (mixed >> np.uint64(64 - 2 * BITS) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class Network:
    """Parameters; ``kernels[k]`` has shape (width, DIM, FILTERS)."""

    first: np.ndarray
    second: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    output: np.ndarray
    intercept: float

    def embed(self, hashes: np.ndarray) -> np.ndarray:
        a, b = buckets(hashes)
        return self.first[a] + self.second[b]

    def convolve(self, words: np.ndarray) -> list[np.ndarray]:
        """One matrix (word, filter) for each width; words beyond the end are zero."""
        out = []
        for kernel, bias in zip(self.kernels, self.biases, strict=True):
            width = len(kernel)
            product = words @ kernel.transpose(1, 0, 2).reshape(DIM, -1)
            result = product[:, :FILTERS] + bias
            for j in range(1, width):
                result[:-j] += product[j:, j * FILTERS : (j + 1) * FILTERS]
            out.append(result)
        return out

    def pooled(self, documents: list[np.ndarray]) -> np.ndarray:
        """Maxima of all filters, rectified, for each document (arrays of hashes)."""
        gap = max(WIDTHS) - 1
        result = np.zeros((len(documents), len(WIDTHS) * FILTERS), dtype=np.float32)
        pieces = [(i, d[at : at + PIECE + gap], min(PIECE, len(d) - at)) for i, d in enumerate(documents) for at in range(0, len(d), PIECE)]
        for part in chunks([len(p) for _, p, _ in pieces], PIECE):
            own = pieces[part]
            lengths = np.array([len(p) + gap for _, p, _ in own])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            words = np.zeros((lengths.sum(), DIM), dtype=np.float32)
            at = np.concatenate([s + np.arange(len(p)) for s, (_, p, _) in zip(starts, own, strict=True)])
            words[at] = self.embed(np.concatenate([p for _, p, _ in own]))
            bounds = np.stack([starts, starts + [n for *_, n in own]], axis=1).ravel()
            maxima = [np.maximum.reduceat(r, bounds)[::2] for r in self.convolve(words)]
            np.maximum.at(result, [i for i, *_ in own], np.hstack(maxima))
        return result

    def logits(self, documents: list[np.ndarray]) -> np.ndarray:
        return self.pooled(documents) @ self.output + self.intercept


def bucket_counts(documents: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """In how many documents a bucket occurs: table, label, bucket."""
    seen = np.zeros((2, 2, BUCKETS))
    for d, label in zip(documents, y, strict=True):
        for table, b in enumerate(buckets(np.unique(d))):
            seen[table, int(label)][np.unique(b)] += 1
    return seen


def new_network(seen: np.ndarray, totals: np.ndarray, random: np.random.Generator) -> tuple[Network, dict]:
    """A network before training, and the sums of squared gradients of its parameters."""
    totals = totals + 1.0
    odds = np.clip(np.log((seen[:, 1] + 0.5) / totals[1]) - np.log((seen[:, 0] + 0.5) / totals[0]), -3, 3)
    odds[seen.sum(1) < 2] = 0
    tables = [random.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32) for _ in range(2)]
    for table, start in zip(tables, odds, strict=True):
        table[:, 0] = start / 2
    kernels = [random.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for kernel in kernels:
        kernel[:, 0, :] = np.abs(kernel[:, 0, :]) + 0.3 / len(kernel)
    network = Network(*tables, kernels, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], random.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)
    squares = {"first": np.full(BUCKETS, 1e-2, np.float32), "second": np.full(BUCKETS, 1e-2, np.float32), "kernels": [np.full_like(k, 1e-2) for k in kernels], "biases": [np.full_like(b, 1e-2) for b in network.biases], "output": np.full_like(network.output, 1e-2), "intercept": 1e-2}
    return network, squares


def train_epoch(network: Network, squares: dict, documents: list[np.ndarray], y: np.ndarray, order: np.ndarray, rate: float, decay: float) -> None:
    """Adagrad on the logistic loss, one document at a time; changes ``network`` and ``squares``."""
    # one row for each word of each filter, one bias for each filter
    rows, row_squares = _as_rows(network.kernels), _as_rows(squares["kernels"])
    biases, bias_squares = np.concatenate(network.biases), np.concatenate(squares["biases"])
    argmax = np.zeros(len(biases), np.int64)
    for i in order:
        hashes = documents[i]
        if not len(hashes):
            continue
        a, b = buckets(hashes)
        words = network.first[a]
        words += network.second[b]
        # a column for each word; the first row of a filter gathers its others
        products = rows @ words.T
        start = 0
        for k, width in enumerate(WIDTHS):
            result = products[start : start + FILTERS]
            for j in range(1, width):
                result[:, :-j] += products[start + j * FILTERS : start + (j + 1) * FILTERS, j:]
            argmax[k * FILTERS : (k + 1) * FILTERS] = result.argmax(1)
            start += width * FILTERS
        maxima = products[_FIRST, argmax] + biases
        active = np.maximum(maxima, 0)
        error = 1 / (1 + np.exp(-float(active @ network.output + network.intercept))) - y[i]
        back = error * network.output * (maxima > 0)
        g = error * active + decay * network.output
        squares["output"] += g * g
        network.output -= rate * g / np.sqrt(squares["output"])
        squares["intercept"] += error * error
        network.intercept -= rate * error / squares["intercept"] ** 0.5
        own, at = back[_FILTER], argmax[_FILTER] + _WORD
        inside = np.flatnonzero((at < len(words)) & (own != 0))
        at, own = at[inside], own[inside, None]
        to_words = own * rows[inside]
        gradients = decay * rows
        gradients[inside] += words[at] * own
        if len(at):
            steps = (to_words * to_words).sum(1) / np.float32(DIM)
            for table, name, where in ((network.first, "first", a[at]), (network.second, "second", b[at])):
                np.add.at(squares[name], where, steps)
                np.add.at(table, where, -rate * to_words / np.sqrt(squares[name][where])[:, None])
        bias_squares += back * back
        biases -= rate * back / np.sqrt(bias_squares)
        row_squares += gradients * gradients
        rows -= rate * gradients / np.sqrt(row_squares)
    for flat, kernels in ((rows, network.kernels), (row_squares, squares["kernels"])):
        start = 0
        for kernel in kernels:
            kernel[:] = flat[start : start + len(kernel) * FILTERS].reshape(-1, FILTERS, DIM).transpose(0, 2, 1)
            start += len(kernel) * FILTERS
    for flat, parts in ((biases, network.biases), (bias_squares, squares["biases"])):
        for k, part in enumerate(parts):
            part[:] = flat[k * FILTERS : (k + 1) * FILTERS]


def _as_rows(kernels: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([kernel.transpose(0, 2, 1).reshape(-1, DIM) for kernel in kernels])


def train_network(documents: list[np.ndarray], y: np.ndarray, epochs: int = 6, rate: float = 0.05, decay: float = 1e-4, seed: int = 5) -> Network:
    """A network trained by one trainer."""
    random = np.random.default_rng(seed)
    network, squares = new_network(bucket_counts(documents, y), np.array([(y == 0).sum(), (y == 1).sum()]), random)
    for _ in range(epochs):
        train_epoch(network, squares, documents, y, random.permutation(len(documents)), rate, decay)
    return network


def flattened(network: Network, squares: dict) -> tuple[np.ndarray, np.ndarray]:
    """The rows of both embeddings, each with its sum of squares, and all other parameters with theirs."""
    tables = np.vstack([np.column_stack([network.first, squares["first"]]), np.column_stack([network.second, squares["second"]])])
    parts = [*network.kernels, *network.biases, network.output, network.intercept, *squares["kernels"], *squares["biases"], squares["output"], squares["intercept"]]
    return tables, np.concatenate([np.ravel(x) for x in parts]).astype(np.float64)


def restored(tables: np.ndarray, rest: np.ndarray) -> tuple[Network, dict]:
    """A network and its sums of squares, as copies, from what :func:`flattened` gives."""
    shapes = 2 * [*((w, DIM, FILTERS) for w in WIDTHS), *((FILTERS,) for _ in WIDTHS), (len(WIDTHS) * FILTERS,), ()]
    parts = [x.reshape(shape).astype(np.float32) if shape else float(x[0]) for x, shape in zip(np.split(rest, np.cumsum([int(np.prod(s)) for s in shapes])[:-1]), shapes, strict=True)]
    n, half = len(WIDTHS), len(shapes) // 2
    network = Network(tables[:BUCKETS, :DIM].copy(), tables[BUCKETS:, :DIM].copy(), parts[:n], parts[n : 2 * n], parts[2 * n], parts[2 * n + 1])
    squares = {"first": tables[:BUCKETS, DIM].copy(), "second": tables[BUCKETS:, DIM].copy(), "kernels": parts[half : half + n], "biases": parts[half + n : half + 2 * n], "output": parts[half + 2 * n], "intercept": parts[half + 2 * n + 1]}
    return network, squares


def ordered(sample: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray, pd.DataFrame]:
    """Word hashes, labels and rows of a trainer, in an order that does not depend on how they came."""
    sample = sample.assign(words=[np.asarray(w, np.int32).tobytes() for w in sample.words]).sort_values(["doc_id", "label", "words"])
    return [np.frombuffer(w, np.uint32) for w in sample.words], sample.label.to_numpy(), sample


def averaged_epoch(rows: DataFrame, tables: np.ndarray, rest: np.ndarray, epoch: int, rate: float, decay: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The parameters (see :func:`flattened`) after each trainer went over its rows."""
    sent = rows.sparkSession.sparkContext.broadcast((tables, rest))

    def trained(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        before, rest_before = sent.value
        network, squares = restored(before, rest_before)
        documents, y, _ = ordered(sample)
        train_epoch(network, squares, documents, y, np.random.default_rng([seed, epoch, int(key[0])]).permutation(len(documents)), rate, decay)
        after, rest_after = flattened(network, squares)
        changed = np.flatnonzero((after != before).any(1))
        parts = [p for p in np.split(changed, np.flatnonzero(np.diff(changed // SLICE)) + 1) if len(p)]
        found = [(int(p[0]) // SLICE, (p % SLICE).astype("<i4").tobytes(), (after[p] - before[p]).astype("<f4").tobytes()) for p in parts]
        found.append((-1, b"", (rest_after - rest_before).astype("<f8").tobytes()))
        return pd.DataFrame(found, columns=["slice", "places", "change"]).assign(trainer=int(key[0]), rows=len(documents))

    def averaged(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        # sums do not depend on the order in which changes come
        parts = parts.sort_values("trainer")
        if key[0] < 0:
            change = np.average([np.frombuffer(c, "<f8") for c in parts.change], axis=0, weights=parts.rows)
            return pd.DataFrame({"slice": [-1], "change": [change.astype("<f8").tobytes()]})
        total, times = np.zeros((SLICE, DIM + 1)), np.zeros((SLICE, 1))
        for places, change in zip(parts.places, parts.change, strict=True):
            at = np.frombuffer(places, "<i4")
            total[at] += np.frombuffer(change, "<f4").reshape(-1, DIM + 1)
            times[at] += 1
        return pd.DataFrame({"slice": [int(key[0])], "change": [(total / np.maximum(times, 1)).astype("<f4").tobytes()]})

    changes = rows.groupBy("trainer").applyInPandas(trained, "slice int, places binary, change binary, trainer int, rows long")
    tables, rest = tables.copy(), rest.copy()
    for part in changes.groupBy("slice").applyInPandas(averaged, "slice int, change binary").collect():
        if part.slice < 0:
            rest += np.frombuffer(part.change, "<f8")
        else:
            tables[part.slice * SLICE : (part.slice + 1) * SLICE] += np.frombuffer(part.change, "<f4").reshape(SLICE, DIM + 1)
    sent.unpersist()
    return tables, rest


def train_by_trainers(rows: DataFrame, epochs: int = 6, rate: float = 0.05, decay: float = 1e-4, seed: int = 5) -> Network:
    """A network trained on all ``rows`` (``trainer``, ``doc_id``, ``label``, ``words``), laid out by ``trainer``.

    An epoch sends the network to the trainers; what comes back through the
    driver is one averaged change of each parameter.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(4 * BUCKETS + 2)
        for batch in batches:
            documents = [w.values.to_numpy().view(np.uint32) for w in batch.column("words")]
            y = batch.column("label").to_numpy()
            total += np.concatenate([bucket_counts(documents, y).ravel(), [(y == 0).sum(), (y == 1).sum()]])
        return total

    counts = sum_over_partitions(rows.select("label", "words"), counted)
    tables, rest = flattened(*new_network(counts[:-2].reshape(2, 2, BUCKETS), counts[-2:], np.random.default_rng(seed)))
    for epoch in range(epochs):
        tables, rest = averaged_epoch(rows, tables, rest, epoch, rate, decay, seed)
    return restored(tables, rest)[0]


def threshold(logits: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    """The cut of least weighted error, in the middle of the gap around it."""
    order = np.argsort(logits, kind="stable")
    s, gain = logits[order], np.where(y[order] == 1, weights[order], -weights[order])
    cost = np.concatenate([[0.0], np.cumsum(gain)])
    cost[1:-1][s[1:] == s[:-1]] = np.inf  # equal scores stay together
    best = np.flatnonzero(cost <= cost.min() + 1e-9)
    lows = np.concatenate([[s[0] - 2], s])
    highs = np.concatenate([s, [s[-1] + 2]])
    widest = best[int(np.argmax((highs - lows)[best]))]
    return float((lows[widest] + highs[widest]) / 2)


@dataclass
class ToxicityModel:
    """A network, the model that tells languages, and the threshold of each language (``cut`` for all others)."""

    network: Network | None
    languages: LanguageModel
    cuts: dict[str, float]
    cut: float = 0.0
    #: Labelled rows of each side: "trained" and "left out".
    rows: dict[str, int] = field(default_factory=dict)

    def score(self, column: list[str]) -> np.ndarray:
        if self.network is None:
            return np.zeros(len(column))
        cuts = np.array([self.cuts.get(self.languages.predict(t)[0], self.cut) if self.cuts else self.cut for t in column])
        margin = self.network.logits([word_hashes(t) for t in column]) - cuts
        # products of matrices depend on the rows beside a row in the last bits
        return (1 / (1 + np.exp(-np.clip(margin, -30, 30)))).round(5)


def thinned(sample: DataFrame, most_words: int, seed: int) -> DataFrame:
    """About ``most_words`` words of the sample, all if it has fewer: rows stay whole or go.

    :func:`fit_toxicity` takes all rows and does not call this.
    """
    words = (sample.agg(F.sum(F.length("words"))).first()[0] or 0) // 4
    return sample.where(sampled(["doc_id", "words"], most_words / words, seed)) if words > most_words else sample


def fit_toxicity(docs: DataFrame, labels: DataFrame, languages: LanguageModel, label_col: str = "toxic", left_out: float = 0.25, least: int = 15, seed: int = 13) -> ToxicityModel:
    """Fit on documents (``doc_id``, ``text``) with a 0/1 label.

    All labelled rows are trained on or, a share of ``left_out``, set the
    thresholds; where one side would lack a class, all rows do both and there is one
    threshold. Thresholds are found over logits in steps of 0.001. A language with fewer
    than ``least`` left-out rows of either class takes the threshold of all.
    Labels without id or value take no part.
    """
    known = labels.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType), F.col(label_col).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    if known.select("label").distinct().count() < 2:
        return ToxicityModel(None, languages, {})
    known = stage(known, "toxicity-labels")
    found = maybe_in(docs.select("doc_id", "text"), known, "doc_id").where("maybe and doc_id is not null")
    size = found.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    trainers = max(1, -(-size // TRAINER_BYTES), min(FEW_TRAINERS, -(-size // FEW_BYTES)))
    # texts become words before they meet their labels, and both meet at the trainer
    to = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % trainers).cast("int").alias("trainer")
    own_id = F.col("doc_id").cast("string").alias("doc_id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = texts(batch.column("text"))
            words = [word_hashes(t).astype("<u4") for t in column]
            # equal texts are on one side
            aside = [(zlib.crc32(w.tobytes()) * 0x9E3779B97F4A7C15 + seed) % 2**64 < left_out * 2**64 for w in words]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, words)]), pa.int32()), pa.array(np.concatenate(words).view(np.int32) if words else [], pa.int32()))
            # languages matter for the thresholds only
            told = [languages.predict(t)[0] if a else None for t, a in zip(column, aside, strict=True)]
            yield pa.RecordBatch.from_pydict({"trainer": batch.column("trainer"), "doc_id": batch.column("doc_id"), "words": lists, "language": pa.array(told, pa.string()), "aside": pa.array(aside, pa.bool_())})

    def labelled(_: tuple, words: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        return words.merge(own[["doc_id", "label"]], on="doc_id")

    schema = "trainer int, doc_id string, words array<int>, language string, aside boolean"
    words = small_batches(found).select(to, own_id, "text").mapInArrow(hashed, schema)
    met = words.groupBy("trainer").cogroup(known.select(to, own_id, "label").groupBy("trainer")).applyInPandas(labelled, f"{schema}, label int")
    rows = stage_buckets(met, "toxicity-words", trainers, "trainer", dealt=True)
    per = {(r.aside, r.label): r["count"] for r in rows.groupBy("aside", "label").count().collect()}
    if not per:
        return ToxicityModel(None, languages, {})
    split = len(per) == 4
    network = train_by_trainers(rows.where("not aside") if split else rows)
    check = rows.where("aside") if split else rows
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def checked(_: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        documents, y, sample = ordered(sample)
        return pd.DataFrame({"language": sample.language.to_numpy(), "label": y, "logit": sent.value.logits(documents).astype(float).round(3)})

    logits = check.groupBy("trainer").applyInPandas(checked, "language string, label int, logit double")
    # rows grow no more with the table than there are steps of logits
    steps = stage(logits.groupBy("language", "label", "logit").agg(F.count(F.lit(1)).alias("rows")), "toxicity-logits")

    def cut(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values(["logit", "label"])
        n, y = found["rows"].to_numpy(), found.label.to_numpy()
        return pd.DataFrame({"language": [key[0]], "cut": [threshold(found.logit.to_numpy(), y, n.astype(float))], "least": [int(min(n[y == 1].sum(), n[y == 0].sum()))]})

    schema = "language string, cut double, least long"
    everything = steps.groupBy("label", "logit").agg(F.sum("rows").alias("rows")).groupBy(F.lit("").alias("language")).applyInPandas(cut, schema).first().cut
    cuts = {r.language: r.cut for r in sorted(steps.groupBy("language").applyInPandas(cut, schema).where(F.col("least") >= least).collect())} if split else {}
    used = {"trained": sum(n for (a, _), n in per.items() if not (split and a)), "left out": sum(n for (a, _), n in per.items() if a or not split)}
    return ToxicityModel(network, languages, cuts, everything, used)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` and ``predicted`` (score of 0.5 or more).

    Learned from the rows of fold 1 to 4 that ``labels`` has. The model of languages
    learns from the texts and the ``lang`` of those folds; a table without that column
    has one threshold. A null text scores as an empty one, equal texts score
    alike; without labels of both classes all scores are 0.
    """
    learned = labels.where(fold("doc_id", 5) != 0)
    seen = docs.where(fold("doc_id", 5) != 0)
    languages = fit_language(seen) if "lang" in docs.columns else LanguageModel([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), 1.0)
    model = fit_toxicity(docs.select("doc_id", "text"), learned, languages)
    sent = small_batches(docs).sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(column: pd.Series) -> pd.Series:
        return pd.Series(sent.value.score([t or "" for t in column]), dtype="float64")

    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    result = docs.select(*kept, scored(docs["text"]).alias("score"))
    return result.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
