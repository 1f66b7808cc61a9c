"""Runs: maximal periodic stretches of words, by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``max(least, 2 * q)``
words long, that no neighbouring word extends. The method follows Kociumaka,
Radoszewski, Rytter and Waleń, "Internal pattern matching queries in a text and
applications": every run contains a dyadic block (of ``2^k`` words, at a multiple
of its size; half of it for the smallest blocks), and that block occurs again one
period later, within a neighbouring window of ``2^(k+1)`` starts. So

1. prefix doubling gives names to the stretches of ``2^k`` words and, in the end,
   the suffix array, in which the occurrences of a block are an interval;
2. a wavelet matrix over the suffix array answers range successor queries, the
   next occurrence of a block at or after a place;
3. occurrences that are close together form a progression, whose difference is the
   block's period; it is enumerated at once, up to where its own run ends, and
   gives the candidate periods;
4. a candidate is extended to both sides by comparing names of stretches, and
   the smallest period of each stretch found is kept.

Documents are independent, so they stay in the tasks that read them: no shuffle. A
task handles a batch of documents of about :data:`BATCH_WORDS` words as one text,
in which equal words of different documents have different names; a longer
document is a batch of its own and takes about 150 bytes a word.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventloom.llm.common import chunks, small_batches, texts
from eventloom.staging import stage

#: Words of short documents that are searched together.
BATCH_WORDS = 200_000
#: Candidates that are extended at once.
BLOCK = 1 << 18
#: The smallest dyadic block has 2^SMALLEST words.
SMALLEST = 2


class Names:
    """Names of all stretches of ``2^k`` words, and the suffix array.

    ``level[k][i]`` is the place in the suffix array where the suffixes that share
    ``2^k`` words with suffix i begin; a stretch that its document cuts off is unlike all others.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        n = len(words)
        order = np.argsort(words, kind="stable")
        rank = self._starts(words[order], np.arange(n), np.empty(n, np.int64), order)
        self.level = [self._closed(rank)]
        sa, size = order, 1
        crowded = self._crowded(rank, n)
        while len(crowded):
            then = crowded + size
            second = np.where(then < ends[crowded], rank[np.minimum(then, n - 1)] + 1, 0)
            key = rank[crowded] * (n + 1) + second
            by_key = np.argsort(key, kind="stable")
            crowded, key = crowded[by_key], key[by_key]
            # a class keeps its stretch of the suffix array; its members are put in order there
            at = rank[crowded]
            place = at + np.arange(len(at)) - self._first(at)
            sa[place] = crowded
            rank = self._starts(key, place, rank.copy(), crowded)
            self.level.append(self._closed(rank))
            size *= 2
            crowded = crowded[self._many(rank[crowded])]
        self.sa = sa

    @staticmethod
    def _first(values: np.ndarray) -> np.ndarray:
        """For each place of a grouped array the place where its group begins."""
        begins = np.concatenate(([True], values[1:] != values[:-1])) if len(values) else np.zeros(0, bool)
        return np.maximum.accumulate(np.where(begins, np.arange(len(values)), 0))

    def _starts(self, keys: np.ndarray, place: np.ndarray, rank: np.ndarray, members: np.ndarray) -> np.ndarray:
        rank[members] = place[self._first(keys)]
        return rank

    @staticmethod
    def _many(ranks: np.ndarray) -> np.ndarray:
        """Which members of an array sorted by rank share theirs."""
        same = np.concatenate(([False], ranks[1:] == ranks[:-1], [False]))
        return same[1:] | same[:-1]

    def _crowded(self, rank: np.ndarray, n: int) -> np.ndarray:
        counts = np.bincount(rank, minlength=n)
        return np.flatnonzero(counts[rank] > 1)

    @staticmethod
    def _closed(rank: np.ndarray) -> np.ndarray:
        return np.append(rank, -1).astype(np.int32)

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree from a and b (a < b, in one document) on."""
        a, b = a.copy(), b.copy()
        start, last = a.copy(), len(self.sa)
        for k in range(len(self.level) - 1, -1, -1):
            name = self.level[k]
            step = (name[a] == name[np.minimum(b, last)]) << k
            a += step
            b += step
        return a - start

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree before a and b."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        for k in range(len(self.level) - 1, -1, -1):
            name, size = self.level[k], 1 << k
            step = ((a >= size) & (name[np.maximum(a - size, 0)] == name[np.maximum(b - size, 0)])) << k
            a -= step
            b -= step
        return start - a

    def interval(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with the stretch of ``2^k`` words at each place."""
        low = self.level[k][at].astype(np.int64)
        return low, np.searchsorted(self.level[k][self.sa], low, "right")


class WaveletMatrix:
    """Range successor queries over an array of small non-negative numbers."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        for b in range(self.bits - 1, -1, -1):
            bit = (values >> b) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate((values[bit == 0], values[bit == 1]))

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest number of at least ``least`` at places ``low`` to ``high - 1``; -1 without one."""
        width = high - low
        below = np.where(least >> self.bits > 0, width, 0)
        l, h = low.copy(), high.copy()
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            ones, zeros = self.ones[level], self.zeros[level]
            l1, h1 = ones[l], ones[h]
            one = (least >> b) & 1 == 1
            below += np.where(one & (least >> self.bits == 0), (h - l) - (h1 - l1), 0)
            l, h = np.where(one, zeros + l1, l - l1), np.where(one, zeros + h1, h - h1)
        found = below < width
        rank, l, h = np.where(found, below, 0), np.where(found, low, 0), np.where(found, high, 0)
        value = np.zeros(len(low), np.int64)
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            ones, zeros = self.ones[level], self.zeros[level]
            l1, h1 = ones[l], ones[h]
            none = (h - l) - (h1 - l1)
            one = rank >= none
            rank = np.where(one, rank - none, rank)
            value |= one.astype(np.int64) << b
            l, h = np.where(one, zeros + l1, l - l1), np.where(one, zeros + h1, h - h1)
        return np.where(found, value, -1)


class Occurrences:
    """The next occurrence of a block that occurs more than once, by range successor over the suffix array.

    Only suffixes whose first block of the smallest size occurs again are kept, under consecutive numbers.
    """

    def __init__(self, names: Names):
        smallest = names.level[min(SMALLEST, len(names.level) - 1)][:-1]
        counts = np.bincount(smallest, minlength=len(smallest))
        again = counts[smallest] > 1
        self.places = np.flatnonzero(again)
        kept = again[names.sa]
        self.before = np.concatenate(([0], np.cumsum(kept)))
        numbers = np.cumsum(again) - 1
        self.matrix = WaveletMatrix(numbers[names.sa[kept]])

    def following(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        if not len(self.places):
            return np.full(len(low), -1)
        number = self.matrix.successor(self.before[low], self.before[high], np.searchsorted(self.places, least))
        return np.where(number >= 0, self.places[number], -1)


def _candidates(names: Names, again: Occurrences, k: int, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of blocks of ``2^k`` words and their occurrences in the neighbouring window."""
    size, n = 1 << k, len(names.sa)
    stride = size // 2 if k == SMALLEST else size
    blocks = again.places[again.places % stride == 0]
    low, high = names.interval(k, blocks)
    alive = high - low > 1
    blocks, low, high = blocks[alive], low[alive], high[alive]
    first = blocks + (1 if k == SMALLEST else 2 * size)
    last = np.minimum(blocks + 4 * size, ends[blocks]) - 1
    while len(blocks):
        one = again.following(low, high, first)
        alive = (one >= 0) & (one <= last)
        blocks, low, high, last, one = blocks[alive], low[alive], high[alive], last[alive], one[alive]
        two = again.following(low, high, one + 1)
        period = two - one
        close = (two >= 0) & (2 * period <= size)
        yield blocks[~close], one[~close] - blocks[~close]
        # the first of a progression leads to its run, which ends it
        a, b = one[close], two[close]
        run_end = b + names.ahead(a, b)
        until = np.minimum(run_end - size, last[close])
        # a block of the same run repeats with the smaller period, which the level of that period finds
        other = (names.behind(a, b) < a - blocks[close]) | (k == SMALLEST)
        lengths = np.where(other, (until - a) // period[close] + 1, 0)
        for part in chunks(lengths.tolist(), BLOCK):
            times = lengths[part]
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            yield np.repeat(blocks[close][part], times), np.repeat((a - blocks[close])[part], times) + step * np.repeat(period[close][part], times)
        first = one + 1
        first[close] = np.maximum(run_end - size, a) + 1


def runs_of(words: np.ndarray, ends: np.ndarray, least: int = 12) -> np.ndarray:
    """All runs of a text of named words, as sorted rows (start, length, period).

    ``ends`` holds for each word the end of its document; words of different
    documents have different names. ``least`` is at least 12, since the smallest blocks are laid out for that.
    """
    if not len(words):
        return np.zeros((0, 3), np.int64)
    names = Names(words, ends)
    if len(names.level) <= SMALLEST:
        # no two stretches of the smallest size are alike
        return np.zeros((0, 3), np.int64)
    again = Occurrences(names)
    found = []
    for k in range(SMALLEST, len(names.level)):
        for at, period in _candidates(names, again, k, ends):
            if not len(at):
                continue
            start = at - names.behind(at, at + period)
            length = at + period + names.ahead(at, at + period) - start
            long = length >= np.maximum(least, 2 * period)
            found.append(np.unique(np.stack((start[long], length[long], period[long]), axis=1), axis=0))
    rows = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)
    # a stretch found with several periods has the smallest one
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[fresh]


def split_words(text: str) -> list[bytes]:
    """Runs of anything but blanks and ``\\t\\n\\v\\f\\r``."""
    return text.encode("utf-8", "replace").split()


def repeat_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document; of about a tenth of them, chosen by id, a tail is made periodic."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


RESULT = T.StructType(
    [
        T.StructField("n_runs", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("period", T.LongType()),
        T.StructField("exponent_milli", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
        T.StructField("runs_sha256", T.StringType()),
        T.StructField("collapsed_sha256", T.StringType()),
    ]
)


def _described(words: list[bytes], runs: np.ndarray) -> dict:
    """The result of one document."""
    row = {"n_runs": len(runs), "start": None, "length": None, "period": None, "exponent_milli": None}
    kept = words
    if len(runs):
        start, length, period = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]))
        row |= {"start": start, "length": length, "period": period, "exponent_milli": 1000 * length // period}
        # +1 where a dropped stretch begins, -1 where it ends
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
        kept = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
    listed = [tuple(r) for r in runs.tolist()]
    row["runs"] = [{"start": s, "length": n, "period": q} for s, n, q in listed]
    row["runs_sha256"] = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in listed).encode()).hexdigest()
    row["collapsed_sha256"] = hashlib.sha256(b" ".join(kept)).hexdigest()
    return row


def search_documents(documents: list[list[bytes]], least: int = 12) -> list[np.ndarray]:
    """The runs of each of several documents, searched as one text."""
    lengths = np.array([len(words) for words in documents], np.int64)
    ends = np.cumsum(lengths)
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(documents)), np.int64, int(lengths.sum()))
    of = np.repeat(np.arange(len(documents)), lengths)
    runs = runs_of(of * max(1, len(number)) + ids, ends[of], least)
    cuts = np.searchsorted(runs[:, 0], ends - lengths)
    result = np.split(runs, cuts[1:]) if len(documents) else []
    return [r - np.array([begin, 0, 0]) for r, begin in zip(result, ends - lengths, strict=True)]


def periodic_runs(docs: DataFrame, least: int = 12, tail: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and the runs of its text; staged.

    Columns: ``n_runs``; ``start``, ``length``, ``period`` and ``exponent_milli``
    (1000 * length / period, rounded down) of the longest run (ties: the smallest
    start, then period; nulls without a run); ``runs``, all of them by start and
    period; ``runs_sha256`` of their lines ``start,length,period``;
    ``collapsed_sha256`` of the words that are left when each run keeps its first
    period only, joined by single spaces. Words are compared as they are, and
    numbered from 0. A text that is null, empty or white space has no runs, and
    digests of nothing. With ``tail``, the documents that :func:`repeat_tail`
    chooses by id are searched with a periodic tail; a null id is not chosen.
    Rows are judged one by one, so repeated ids repeat their results; other
    columns are not read.
    """
    if least < 12:
        raise ValueError("least must be 12 or more")
    kind = docs.schema["doc_id"].dataType

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            words = [split_words(t) for t in texts(batch.column("text"))]
            if tail:
                words = [repeat_tail(w, i) for w, i in zip(words, ids, strict=True)]
            for part in chunks([len(w) for w in words], BATCH_WORDS):
                rows = [_described(w, r) for w, r in zip(words[part], search_documents(words[part], least), strict=True)]
                columns = {"doc_id": batch.column("doc_id").slice(part.start, part.stop - part.start)}
                for f in RESULT:
                    columns[f.name] = pa.array([r[f.name] for r in rows], _arrow(f.dataType))
                yield pa.RecordBatch.from_pydict(columns)

    schema = T.StructType([T.StructField("doc_id", kind), *RESULT])
    return stage(small_batches(docs).select("doc_id", "text").mapInArrow(searched, schema), "runs")


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.LongType):
        return pa.int64()
    if isinstance(kind, T.StringType):
        return pa.string()
    return pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
