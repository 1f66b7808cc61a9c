"""Packing of tokenized documents into windows by the sum-of-squares rule.

Each task packs the documents of its partition in one pass. A document that is
longer than a window gives full windows first; what remains is placed whole.
The *level* of a window is its number of ids, and the level array holds how
many open windows there are at each level. An item goes to the open window, or
to a new one, for which the sum of the squared counts grows least (Csirik,
Johnson, Kenyon, Orlin, Shor and Weber, "On the sum-of-squares algorithm for
bin packing"). The windows still open at the end of a partition fill each
other: pieces of the emptiest are cut to fill the fullest, so a partition
leaves one window that is not full.

There is no shuffle, and a window's id is made of the partition and a counter,
so a task that runs again gives the same rows.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventloom.llm.common import small_batches

#: Open windows that a task holds at most; beyond it they fill each other early.
MAX_OPEN = 8192
#: Words whose ids a worker remembers.
MAX_WORDS = 150_000

_SPACES = re.compile(r"\s\s")
_SPECIAL = "<|endoftext|>"


class ByteTokenizer:
    """Ids of a byte-level BPE vocabulary as little-endian 32-bit bytes.

    The merges run in a compiled library over the rank file of the same
    vocabulary. Where no two white space characters meet, the pre-tokenizer cuts
    before each space and around each line feed, so words are encoded once and
    remembered. A text with the vocabulary's special token goes to the JSON
    tokenizer itself.
    """

    def __init__(self, json_path: str, rank_path: str, pattern: str):
        import tiktoken

        with open(rank_path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        encode = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._json_path, self._json = json_path, None
        pack = {n: struct.Struct(f"<{n}I").pack for n in range(9)}

        def whole(text: str) -> bytes:
            ids = encode(text)
            n = len(ids)
            return pack[n](*ids) if n < 9 else np.array(ids, dtype="<u4").tobytes()

        self.whole = whole

        class Words(dict):
            def __init__(self, before: str):
                super().__init__()
                self.before = before

            def __missing__(self, word: str) -> bytes:
                if len(self) >= MAX_WORDS:
                    self.clear()
                found = self[word] = whole(self.before + word)
                return found

        self._first, self._inner, self._feed = Words(""), Words(" "), whole("\n")

    def __call__(self, text: str) -> bytes:
        if _SPECIAL in text:
            if self._json is None:
                from tokenizers import Tokenizer

                self._json = Tokenizer.from_file(self._json_path)
            return np.array(self._json.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if _SPACES.search(text) or text[:1].isspace() or text[-1:].isspace():
            return self.whole(text)
        first, inner = self._first, self._inner.__getitem__
        lines = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            lines.append(first[head] + b"".join(map(inner, rest)))
        return self._feed.join(lines)


_TOKENIZERS: dict[tuple, ByteTokenizer] = {}


def tokenizer(json_name: str = "byte_bpe_50k.json", rank_name: str = "byte_bpe_50k.tiktoken") -> ByteTokenizer:
    """The tokenizer of an installed vocabulary; one for each Python worker."""
    key = (json_name, rank_name)
    if key not in _TOKENIZERS:
        import public_tokenizers

        _TOKENIZERS[key] = ByteTokenizer(public_tokenizers.path(json_name), public_tokenizers.path(rank_name), public_tokenizers.PATTERN)
    return _TOKENIZERS[key]


class SumOfSquares:
    """Places pieces (document, start, ids, ids of the document) into windows.

    ``count[h]`` is the level array. ``place`` and ``close`` return finished
    windows as lists of pieces.
    """

    def __init__(self, window: int, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(window + 1)]
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """The level to put ``size`` ids on: least growth of the sum of squares, then the fullest."""
        n, w = self.count, self.window
        levels = n[1 : w - size + 1]
        growth = 2 * (n[size + 1 : w + 1] - levels) + 2
        if len(growth):
            growth[-1] = 1 - 2 * levels[-1]  # a full window leaves the array
            growth[levels == 0] = np.iinfo(np.int64).max
            best = len(growth) - 1 - int(np.argmin(growth[::-1]))
            if growth[best] <= 2 * n[size] + 1:
                return best + 1
        return 0

    def place(self, piece: tuple) -> list[list[tuple]]:
        size = len(piece[2]) // 4
        if size == self.window:
            return [[piece]]
        level = self.level_for(size)
        pieces = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
        else:
            self.n_open += 1
        pieces.append(piece)
        level += size
        if level == self.window:
            self.n_open -= 1
            return [pieces]
        self.open[level].append(pieces)
        self.count[level] += 1
        return self.close() if self.n_open > self.max_open else []

    def close(self) -> list[list[tuple]]:
        """All open windows, filled from each other; the last one may be short."""
        left = [(level, pieces) for level in range(self.window, 0, -1) for pieces in self.open[level]]
        self.count[:] = 0
        self.open = [[] for _ in range(self.window + 1)]
        self.n_open = 0
        done, i, j = [], 0, len(left) - 1
        while i <= j:
            level, pieces = left[i]
            while level < self.window and j > i:
                giver = left[j][1]
                doc, start, ids, total = giver.pop()
                room = 4 * (self.window - level)
                pieces.append((doc, start, ids[:room], total))
                level += len(pieces[-1][2]) // 4
                if len(ids) > room:
                    giver.append((doc, start + room // 4, ids[room:], total))
                if not giver:
                    j -= 1
            done.append(pieces)
            i += 1
        return done


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1, json_name: str = "byte_bpe_50k.json", rank_name: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """One row per piece of a document: its place in its window, and its ids.

    Columns: the id, ``start`` (ids of the document before the piece),
    ``length``, ``ids`` (little-endian unsigned 32-bit integers), ``doc_tokens``
    (with the end id), ``sequence_id``, ``offset`` (ids of the window before the
    piece). Windows hold at most ``window`` ids.

    A null or empty text is the end id alone. Rows with a null id and repeated
    rows are packed like others. Other columns are not read, whatever their
    names. An empty table gives no rows.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(json_name, rank_name)
        packer = SumOfSquares(window)
        next_id = TaskContext.get().partitionId() << 33
        out: list[list] = [[] for _ in range(7)]
        size = 0

        def batch() -> pa.RecordBatch:
            nonlocal out, size
            arrays = [pa.array(values, kind) for values, kind in zip(out, kinds, strict=True)]
            out, size = [[] for _ in range(7)], 0
            return pa.RecordBatch.from_arrays(arrays, ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        def put(windows):
            nonlocal next_id, size
            for pieces in windows:
                offset = 0
                for doc, start, ids, total in pieces:
                    n = len(ids) // 4
                    for values, value in zip(out, (doc, start, n, ids, total, next_id, offset), strict=True):
                        values.append(value)
                    offset += n
                    size += len(ids)
                next_id += 1

        kinds = None
        for rows in batches:
            kinds = kinds or [rows.schema.field(0).type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            for doc, text in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                for at in range(0, len(ids), 4 * window):
                    put(packer.place((doc, at // 4, ids[at : at + 4 * window], len(ids) // 4)))
                if size > 4 << 20:
                    yield batch()
        if kinds:
            put(packer.close())
            yield batch()

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc", kind)] + [T.StructField(n, T.BinaryType() if n == "ids" else T.LongType()) for n in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")])
    return small_batches(docs).select(docs[id_col], docs[text_col]).mapInArrow(pack, schema).withColumnRenamed("doc", id_col)
