"""Nearest neighbours with randomly rotated one-bit codes and error bounds.

A vector o minus the mean is a length r times a unit vector u. After a random
rotation only the signs of u are kept: the code x, a corner of the hypercube
scaled to length one (Gao and Long, "RaBitQ"). With <x, u> stored beside the
code, <x, q> / <x, u> is an unbiased estimate of <u, q> for a unit query q, and
its error is below epsilon * sqrt((1 - <x, u>^2) / (<x, u>^2 (bits - 1))) with a
probability that falls exponentially in epsilon^2. Vectors are padded to
``bits`` coordinates before the rotation; more bits give tighter bounds. A query's
coordinates are rounded to four bits, so that its inner product with a code is a sum of
popcounts of the code and four bit planes, word by word; the codes are never unpacked.

The index has one row for each vector. Queries pass over it in blocks of a fixed
number; each task estimates distances from its codes alone, bounds them from
below, and computes exact distances only where the bound is below the k-th
smallest exact distance it has seen. Its k best of each query go on, and the k
best of all tasks are the result. Every vector is indexed and every code is
looked at; the mean is a hint that affects speed, not results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import sum_over_partitions
from eventloom.staging import stage

#: Queries in one pass over the index; with their codes they take bits * 12 bytes each.
QUERIES_PER_PASS = 8192
#: Queries that are compared at once, to bound the matrix of estimates.
QUERIES_AT_ONCE = 128
#: Vectors that are compared at once.
VECTORS_AT_ONCE = 8192
#: Codes whose popcounts are summed at once, so that the sums stay in the cache.
CODES_AT_ONCE = 1024
#: Bits of a coordinate of a query.
QUERY_BITS = 4
EPSILON = 2.4


def usable(embedding: str = "embedding"):
    """True for vectors that are not null, not zero, and have finite components only."""
    v = F.col(embedding)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def rotation(bits: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
    return q * np.sign(np.diag(r))


class Coder:
    """Codes of vectors of ``dim`` components around ``mean``."""

    def __init__(self, mean: np.ndarray, bits: int, seed: int):
        self.mean, self.dim = mean, len(mean)
        self.bits = 64 * math.ceil(max(bits, self.dim) / 64)
        # the rows that meet the padding are not needed
        self.turn = rotation(self.bits, seed)[: self.dim]

    def turned(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths of the centred vectors, and their rotated directions."""
        centred = vectors - self.mean
        lengths = np.sqrt((centred * centred).sum(1))
        return lengths, (centred / np.where(lengths > 0, lengths, 1)[:, None]) @ self.turn

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed sign bits, lengths, and the inner products of code and direction."""
        lengths, turned = self.turned(vectors)
        return np.packbits(turned > 0, axis=1), lengths, np.abs(turned).sum(1) / math.sqrt(self.bits)

    def quantize(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rotated directions in :data:`QUERY_BITS` bits: bit planes as words (query, plane, word), least value, step and sum of levels."""
        least = queries.min(axis=1)
        step = np.maximum((queries.max(axis=1) - least) / ((1 << QUERY_BITS) - 1), 1e-12)
        levels = np.rint((queries - least[:, None]) / step[:, None]).astype(np.uint8)
        planes = [np.packbits(levels >> p & 1, axis=1).view(np.uint64) for p in range(QUERY_BITS)]
        return np.stack(planes, axis=1), least, step, levels.sum(axis=1, dtype=np.int64)

    def inner(self, packed: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of codes and quantized queries (query, vector) from AND and popcounts, and the spread of the rounding."""
        planes, least, step, total = self.quantize(queries)
        words = np.ascontiguousarray(packed).view(np.uint64)
        shared = np.empty((len(queries), len(words)), np.uint16)
        for at in range(0, len(words), CODES_AT_ONCE):
            some = words[at : at + CODES_AT_ONCE]
            sums = np.zeros((len(queries), len(some)), np.uint16)
            for p in range(QUERY_BITS):
                for w in range(words.shape[1]):
                    sums += np.bitwise_count(planes[:, p, w, None] & some[None, :, w]).astype(np.uint16) << np.uint16(p)
            shared[:, at : at + CODES_AT_ONCE] = sums
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64).astype(np.float32)
        value = (2 * step[:, None]).astype(np.float32) * shared + (2 * least[:, None]).astype(np.float32) * ones
        value -= (self.bits * least + step * total).astype(np.float32)[:, None]
        return value / np.float32(math.sqrt(self.bits)), step / math.sqrt(12)

    def bounds(self, packed: np.ndarray, lengths: np.ndarray, fit: np.ndarray, query_lengths: np.ndarray, queries: np.ndarray, epsilon: float) -> np.ndarray:
        """Lower bounds of the squared distances, one row for each query."""
        inner, rounding = self.inner(packed, queries)
        safe = np.maximum(fit, 1e-6)
        # of the code, and of the rounded query
        variance = np.maximum(1 - safe * safe, 0) / max(1, self.bits - 1) + rounding[:, None] ** 2
        inner = np.minimum((inner + epsilon * np.sqrt(variance)) / safe, 1.0)
        return query_lengths[:, None] ** 2 + lengths**2 - 2 * query_lengths[:, None] * lengths * inner


def build_index(vectors: DataFrame, bits: int = 256, seed: int = 29, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, Coder | None]:
    """One staged row per usable vector: id, vector, packed code, length, fit.

    All vectors must have as many components as most have; others, like unusable
    ones, raise no error and are left out. The mean is that of all vectors.
    """
    rows = vectors.where(usable(vector_col)).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where("vec_id is not null")
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not sizes:
        return stage(rows.select("vec_id", "vector", F.lit(b"").alias("code"), F.lit(0.0).alias("length"), F.lit(0.0).alias("fit")), "one-bit-index"), None
    dim = sizes[0].dim
    rows = rows.where(F.size("vector") == dim)

    def moments(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(dim + 1)
        for batch in batches:
            x = matrix(batch.column("vector"), dim)
            total += np.concatenate([x.sum(0), [len(x)]])
        return total

    sums = sum_over_partitions(rows.select("vector"), moments)
    coder = Coder(sums[:-1] / sums[-1], bits, seed)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, length, fit = coder.encode(matrix(batch.column("vector"), dim))
            columns = [batch.column("vec_id"), batch.column("vector"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(length), pa.array(fit)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "code", "length", "fit"])

    return stage(rows.mapInArrow(encoded, "vec_id long, vector array<double>, code binary, length double, fit double"), "one-bit-index"), coder


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Best:
    """The k smallest (distance, id) of each query, by exact distances."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.distance = np.full((n, k), np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, query: int, distances: np.ndarray, ids: np.ndarray) -> None:
        d, i = np.concatenate([self.distance[query], distances]), np.concatenate([self.id[query], ids])
        order = np.lexsort((i, d))[: self.k]
        self.distance[query], self.id[query] = d[order], i[order]


def search_block(coder: Coder, query_ids: np.ndarray, queries: np.ndarray, batches: Iterator[pa.RecordBatch], k: int, epsilon: float) -> Best:
    """The k nearest of the vectors in ``batches`` for each query, other than itself."""
    lengths, turned = coder.turned(queries)
    best = Best(len(queries), k)
    for batch in batches:
        for at in range(0, batch.num_rows, VECTORS_AT_ONCE):
            part = batch.slice(at, VECTORS_AT_ONCE)
            ids = part.column("vec_id").to_numpy()
            vectors = matrix(part.column("vector"), coder.dim)
            packed = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
            for start in range(0, len(queries), QUERIES_AT_ONCE):
                some = slice(start, start + QUERIES_AT_ONCE)
                bounds = coder.bounds(packed, part.column("length").to_numpy(), part.column("fit").to_numpy(), lengths[some], turned[some], epsilon)
                for row, query in enumerate(range(start, start + len(bounds))):
                    low = bounds[row]
                    if not np.isfinite(best.distance[query, -1]) and len(low) > 4 * k:
                        # exact distances of the most promising give a first limit
                        refine(best, query, queries[query], query_ids[query], vectors, ids, np.argpartition(low, 2 * k)[: 2 * k])
                        seen = set(best.id[query])
                        near = np.flatnonzero(low <= best.distance[query, -1] ** 2 * (1 + 1e-9))
                        near = near[[ids[i] not in seen for i in near]] if len(near) else near
                    else:
                        near = np.flatnonzero(low <= best.distance[query, -1] ** 2 * (1 + 1e-9))
                    refine(best, query, queries[query], query_ids[query], vectors, ids, near)
    return best


def refine(best: Best, query: int, vector: np.ndarray, own: int, vectors: np.ndarray, ids: np.ndarray, near: np.ndarray) -> None:
    near = near[ids[near] != own]
    if len(near):
        best.add(query, np.sqrt(((vectors[near] - vector) ** 2).sum(1)), ids[near])


def nearest(queries: DataFrame, index: DataFrame, coder: Coder | None, k: int = 10, epsilon: float = EPSILON, per_pass: int = QUERIES_PER_PASS) -> DataFrame:
    """The ``k`` nearest index rows of each query row, other than itself.

    ``queries`` are rows of the index. Columns: ``query_id``, ``rank`` (from 1),
    ``vec_id``, ``score`` (Euclidean distance of the vectors in double
    precision); ties go to the smaller id. Ids are unique.

    Queries are numbered and read in passes of ``per_pass``, so one pass sends a
    bounded block to the executors; what a pass finds is staged.
    """
    schema = "query_id long, vec_id long, score double"
    spark = index.sparkSession
    if coder is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = queries.count()
    passes = max(1, math.ceil(n / per_pass))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(passes))
    staged = stage(queries.select("vec_id", "vector", block.alias("pass")), "queries", "pass") if passes > 1 else queries
    found = []
    for number in range(passes):
        chosen = (staged.where(F.col("pass") == number) if passes > 1 else staged).select("vec_id", "vector").toArrow()
        if not chosen.num_rows:
            continue
        ids = chosen.column("vec_id").to_numpy()
        order = np.argsort(ids)
        sent = spark.sparkContext.broadcast((coder, ids[order], matrix(chosen.column("vector").combine_chunks(), coder.dim)[order]))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own, query_ids, vectors = sent.value
            best = search_block(own, query_ids, vectors, batches, k, epsilon)
            hit = np.isfinite(best.distance)
            rows = [np.repeat(query_ids, k)[hit.ravel()], best.id[hit], best.distance[hit]]
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["query_id", "vec_id", "score"])

        found.append(stage(index.mapInArrow(search, schema), "neighbours"))
        sent.unpersist()
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return every.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
