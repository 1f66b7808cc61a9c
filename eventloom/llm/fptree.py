"""Ranked lexical search: a document FP-tree with branch-and-bound per item.

A document's terms that some item asks for, ordered by falling document frequency, are
its path. Documents that share frequent terms share the upper part of their
paths, so a task's documents form a tree (Han, Pei and Yin, "Mining frequent
patterns without candidate generation"), here over sorted rows: a node is the
stretch of documents with the same first terms. A node knows the largest count of
each term and the smallest length measure m below it. As a term's share of the
score grows with its count and falls with m, these bound the score of every
document below for every item.

The tree is searched depth first, the child with the largest bounds first. A
node is searched for those items only whose bound exceeds (or equals, with a
smaller id below) their 50th best score so far; the items of a block go down
together, each with its own threshold, and leave where their bound falls below
it. Bounds and scores are integers, computed exactly.

Steps: items are taken in blocks of about :data:`BLOCK_TERMS` terms, which is what a
task holds of them. For each block, one pass over the documents gives their
restricted term vectors (counts by term); these are staged. Document frequencies
and totals are aggregated from them over all rows. A sixteenth of the vectors is
searched first: the 50th best score there is a valid threshold for each item, so
that of all others a task returns what may belong to the best only. The best of
all tasks are merged per item.

Rows with equal vectors and m score alike, so of these a tree keeps the smallest
``top`` ids, which are all that can be among the best. Trees are built of at most
:data:`TREE_TERMS` vector entries at a time, so memory does not grow with a task's input.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import small_batches, texts
from eventloom.llm.winnow import words_of
from eventloom.staging import stage

#: Entries of vectors in one tree.
TREE_TERMS = 2_000_000
#: Distinct (item, term) pairs that a task holds.
BLOCK_TERMS = 200_000
#: A stretch of so many documents is not divided any more.
LEAF = 32
#: One in so many vectors is searched for the first thresholds.
FIRST = 16

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NO_ID = np.iinfo(np.int64).max


def terms_of(text: str) -> list[str]:
    """The terms of a text: runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased."""
    return _TERM.findall(text.translate(_LOWER))


def share(weights: np.ndarray, counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What terms add to a score: the weight times ``(10^9 * tf) div (1000 * tf + 20 * m)``."""
    return weights * np.where(counts > 0, (1_000_000_000 * counts) // np.maximum(1000 * counts + 20 * m, 1), 0)


@dataclass
class Asked:
    """Items of a block: ids, weights of the terms (by number, most frequent first), and which item has which term."""

    ids: list
    weights: np.ndarray  # by term
    holds: np.ndarray  # (term, item) of 0 and 1
    total_terms: int
    documents: int


class Node:
    """A stretch of sorted documents that share the first ``depth`` terms."""

    __slots__ = ("children", "counts", "first_id", "high", "low", "m", "terms")

    def __init__(self, low, high, terms, counts, m, first_id, children):
        self.low, self.high, self.terms, self.counts, self.m, self.first_id, self.children = low, high, terms, counts, m, first_id, children


class Tree:
    """The FP-tree of some documents, given as paths (term numbers, rising) with counts."""

    def __init__(self, rows: list[tuple[tuple, tuple, int, int]], top: int):
        """``rows`` has (path, counts, m, id); rows that are alike but for the id keep the smallest ``top`` ids."""
        rows.sort()
        kept, run = [], 0
        for i, row in enumerate(rows):
            run = run + 1 if i and row[:3] == rows[i - 1][:3] else 1
            if run <= top:
                kept.append(row)
        self.paths = [r[0] for r in kept]
        self.counts = [r[1] for r in kept]
        self.m = np.array([r[2] for r in kept], np.int64)
        self.ids = np.array([r[3] for r in kept], np.int64)
        self.root = self._grow() if kept else None

    def _leaf(self, low: int, high: int) -> Node:
        lengths = [len(self.paths[i]) for i in range(low, high)]
        terms = np.fromiter((t for i in range(low, high) for t in self.paths[i]), np.int64, sum(lengths))
        counts = np.fromiter((c for i in range(low, high) for c in self.counts[i]), np.int64, sum(lengths))
        own, at = np.unique(terms, return_inverse=True)
        most = np.zeros(len(own), np.int64)
        np.maximum.at(most, at, counts)
        return Node(low, high, own, most, int(self.m[low:high].min()), int(self.ids[low:high].min()), ())

    @staticmethod
    def _over(children: list[Node]) -> Node:
        """The node above: largest counts and smallest m of those below."""
        if len(children) == 1:
            return children[0]
        terms = np.concatenate([c.terms for c in children])
        own, at = np.unique(terms, return_inverse=True)
        most = np.zeros(len(own), np.int64)
        np.maximum.at(most, at, np.concatenate([c.counts for c in children]))
        return Node(children[0].low, children[-1].high, own, most, min(c.m for c in children), min(c.first_id for c in children), tuple(children))

    def _parts(self, low: int, high: int, depth: int) -> tuple[list[tuple[int, int]], int]:
        """The stretches below a node, and how deep they are; terms that all share are passed over."""
        first, last = self.paths[low], self.paths[high - 1]
        while depth < len(first) and depth < len(last) and first[depth] == last[depth]:
            depth += 1
        if depth >= len(last):
            # the same path throughout: divided by number
            return [(i, min(high, i + LEAF)) for i in range(low, high, LEAF)], -1
        parts, begin = [], low
        for i in range(low + 1, high):
            if self.paths[i][depth : depth + 1] != self.paths[i - 1][depth : depth + 1]:
                parts.append((begin, i))
                begin = i
        return [*parts, (begin, high)], depth

    def _grow(self) -> Node:
        """All nodes, from the leaves up; small neighbours share a leaf."""
        done: dict[tuple[int, int], Node] = {}
        stack = [(0, len(self.paths), 0, None)]
        while stack:
            low, high, depth, parts = stack.pop()
            if parts is not None:
                done[low, high] = self._over([done.pop(p) for p in parts])
                continue
            if high - low <= LEAF or depth < 0:
                done[low, high] = self._leaf(low, high)
                continue
            parts, below = self._parts(low, high, depth)
            merged: list[tuple[int, int, int]] = []
            for begin, end in parts:
                # siblings that are small together are one leaf
                if merged and end - merged[-1][0] <= LEAF:
                    merged[-1] = (merged[-1][0], end, 0)
                else:
                    merged.append((begin, end, below))
            stack.append((low, high, depth, [(b, e) for b, e, _ in merged]))
            stack += [(b, e, d, None) for b, e, d in merged]
        return done[0, len(self.paths)]


class Best:
    """The best ``top`` documents of each item so far, and thresholds."""

    def __init__(self, items: int, top: int, floors: np.ndarray):
        self.top, self.heaps = top, [[] for _ in range(items)]
        # a document needs more than ``score``, or the same and an id below ``id``
        self.score, self.id = np.maximum(floors - 1, 0), np.full(items, -1, np.int64)

    def wants(self, items: np.ndarray, bounds: np.ndarray, first_id: np.ndarray) -> np.ndarray:
        return (bounds > self.score[items]) | ((bounds == self.score[items]) & (first_id < self.id[items]))

    def add(self, item: int, score: int, doc: int) -> None:
        heap = self.heaps[item]
        if len(heap) < self.top:
            heapq.heappush(heap, (score, -doc))
        elif (score, -doc) > heap[0]:
            heapq.heapreplace(heap, (score, -doc))
        if len(heap) == self.top:
            least, minus = heap[0]
            if least >= self.score[item]:
                self.score[item], self.id[item] = least, -minus


def search_tree(tree: Tree, asked: Asked, best: Best) -> None:
    """Depth-first branch-and-bound of all items of a block."""
    if tree.root is None:
        return
    # sums up to 2^53 are exact in doubles
    exact = float(asked.weights.sum()) * 1_000_000 < 2**53
    holds = asked.holds.astype(np.float64 if exact else np.int64)

    def bounds(terms: np.ndarray, shares: np.ndarray, items: np.ndarray) -> np.ndarray:
        part = holds[terms] if len(items) == holds.shape[1] else holds[np.ix_(terms, items)]
        return (shares.astype(part.dtype) @ part).astype(np.int64)

    everyone = np.arange(holds.shape[1])
    stack = [(tree.root, everyone, bounds(tree.root.terms, share(asked.weights[tree.root.terms], tree.root.counts, np.int64(tree.root.m))[None], everyone)[0])]
    while stack:
        node, items, limit = stack.pop()
        wanted = best.wants(items, limit, np.int64(node.first_id))
        items = items[wanted]
        if not len(items):
            continue
        if not node.children:
            _score_leaf(tree, node, items, asked, best, bounds)
            continue
        below = []
        for child in node.children:
            limits = bounds(child.terms, share(asked.weights[child.terms], child.counts, np.int64(child.m))[None], items)[0]
            below.append((float(limits.max(initial=0)), child, limits))
        # the last one pushed is searched first
        below.sort(key=lambda c: c[0])
        stack += [(child, items, limits) for _, child, limits in below]


def _score_leaf(tree: Tree, node: Node, items: np.ndarray, asked: Asked, best: Best, bounds) -> None:
    for low in range(node.low, node.high, LEAF):
        high = min(node.high, low + LEAF)
        counts = np.zeros((high - low, len(node.terms)), np.int64)
        for i in range(low, high):
            counts[i - low, np.searchsorted(node.terms, tree.paths[i])] = tree.counts[i]
        scores = bounds(node.terms, share(asked.weights[node.terms][None], counts, tree.m[low:high, None]), items)
        ids = tree.ids[low:high]
        good = best.wants(np.broadcast_to(items, scores.shape), scores, np.broadcast_to(ids[:, None], scores.shape))
        # in falling order of scores, most of the rest fails the threshold at once
        rows, columns = np.nonzero(good & (scores > 0))
        for at in np.argsort(-scores[rows, columns], kind="stable").tolist():
            best.add(int(items[columns[at]]), int(scores[rows[at], columns[at]]), int(ids[rows[at]]))


def _vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``doc_id``, ``n`` (all terms) and ``terms``, ``counts`` (of the vocabulary, by number) of the rows with a term; staged."""
    number = {t: i for i, t in enumerate(vocabulary)}

    def restricted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in texts(batch.column("text")):
                found = terms_of(text)
                held = Counter(filter(number.__contains__, found))
                sizes.append(len(found))
                terms.append([number[t] for t in held])
                counts.append(list(held.values()))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n": pa.array(sizes, pa.int64()), "terms": pa.array(terms, pa.list_(pa.int32())), "counts": pa.array(counts, pa.list_(pa.int64()))})

    kept = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(restricted, "doc_id long, n long, terms array<int>, counts array<long>")
    return stage(kept.where("n > 0"), "term-vectors")


def _search(vectors: DataFrame, asked: Asked, order: np.ndarray, top: int, floors: np.ndarray) -> DataFrame:
    """(item number, score, doc_id) of what each task found best."""
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(asked.ids), top, floors)
        rows, held = [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "n", "terms", "counts"))
            for doc, n, terms, counts in zip(*columns, strict=True):
                if not terms:
                    continue
                path = sorted(zip(place[terms].tolist(), counts, strict=True))
                m = 100 - 50 + (50 * n * asked.documents) // asked.total_terms
                rows.append((tuple(t for t, _ in path), tuple(c for _, c in path), m, NO_ID if doc is None else doc))
                held += len(terms)
                if held >= TREE_TERMS:
                    search_tree(Tree(rows, top), asked, best)
                    rows, held = [], 0
        search_tree(Tree(rows, top), asked, best)
        found = [(i, s, -d) for i, heap in enumerate(best.heaps) for s, d in heap]
        yield pa.RecordBatch.from_pydict({"item": pa.array([f[0] for f in found], pa.int32()), "score": pa.array([f[1] for f in found], pa.int64()), "doc_id": pa.array([None if f[2] == NO_ID else f[2] for f in found], pa.int64())})

    return vectors.select("doc_id", "n", "terms", "counts").mapInArrow(searched, "item int, score long, doc_id long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 50, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``top`` best documents of each item: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    ``docs`` has ``doc_id`` (integer) and ``text``, ``items`` has ``item_id`` and ``text``; other
    columns are not read. Only scores above 0 count; equal scores by ascending id, a null id last.
    Each row of ``docs`` is a document, so a repeated row is found as often. Rows of
    ``items`` that share an id are one item with the terms of all of them; a null
    item id, and an item without terms, has no result. A null or empty text has no terms.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    wanted = items.where("item_id is not null").select("item_id", F.explode(words_of(F.col("text"))).alias("term")).distinct()
    pairs = wanted.count()
    blocks = max(1, -(-pairs // block_terms))
    wanted = stage(wanted.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")), "item-terms")
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    results = []
    for block in range(blocks):
        # about ``block_terms`` rows
        listed = wanted.where(F.col("block") == block).select("item_id", "term").collect()
        if listed:
            results.append(_search_block(docs, [(r.item_id, r.term) for r in listed], top))
    if not results:
        return spark.createDataFrame([], schema)
    # the numbers of a block's items are turned into ids again
    ranked = None
    for found, ids in results:
        names = spark.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)]))
        named = found.join(names, "item").select("item_id", "rank", "doc_id", "score")
        ranked = named if ranked is None else ranked.unionByName(named)
    return ranked


def _search_block(docs: DataFrame, listed: list[tuple], top: int) -> tuple[DataFrame, list]:
    vocabulary = sorted({t for _, t in listed})
    ids = sorted({i for i, _ in listed})
    vectors = _vectors(docs, vocabulary)
    totals = vectors.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    number = {t: i for i, t in enumerate(vocabulary)}
    frequency = np.zeros(len(vocabulary), np.int64)
    # one row for each term of the block at most
    for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[r.term] = r["count"]
    n = totals.documents
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)
    order = np.argsort(-frequency, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    column = {i: c for c, i in enumerate(ids)}
    holds = np.zeros((len(vocabulary), len(ids)), np.int8)
    for i, t in listed:
        holds[place[number[t]], column[i]] = 1
    asked = Asked(ids, weights[order], holds, max(1, totals.terms), n)
    first = vectors.where(F.pmod(F.xxhash64("doc_id", "n", "terms", "counts"), F.lit(FIRST)) == 0)
    # few tasks, so that each sees enough to raise its thresholds
    tasks = max(1, n // FIRST // 20_000)
    leading = _ranked(_search(first.repartition(tasks), asked, order, top, np.zeros(len(ids), np.int64)), top)
    floors = np.zeros(len(ids), np.int64)
    for r in leading.where(F.col("rank") == top).select("item", "score").collect():
        floors[r.item] = r.score
    found = stage(_search(vectors, asked, order, top, floors), "found")
    return stage(_ranked(found, top).select("item", "rank", "doc_id", "score"), "ranked"), ids
