"""SimHash near-duplicates: pivot distance tables by blocks, verified by the bits.

A document's fingerprint has a bit for each of 64 positions, set if it is set in
over half of the hashes of its four-word shingles. Fingerprints link if they
differ in at most ``radius`` bits.

The pivot table holds, for each fingerprint, its Hamming distances to reference
fingerprints, split by :data:`BLOCKS` blocks of 9 or 10 bits: ``radius`` differing bits
leave at least ``7 - radius`` of the 7 blocks as they are, and in these all
coordinates are equal. A distance over all 64 bits cannot say which pairs to
compare: for fingerprints of unlike texts it spreads by four bits, no more than
the radius, so a coordinate alone keeps six of ten pairs. So

1. equal fingerprints are one class, and one row goes on;
2. each combination of ``7 - radius`` blocks gives a key, a hash of the coordinates
   there (35 keys of 27 bits or more at radius 4); members of a key are compared;
3. within a key a pair is discarded if, for some reference, the coordinate
   differences summed over the blocks exceed the radius (a block's coordinates
   cannot differ by more than its bits do). Survivors are verified by their bits,
   and a spanning forest of the true links goes on;
4. the links merge into components.

A key may have very many members, as the copies of a text with small edits do. Where
a key has more members than a fingerprint has neighbours within ``radius / 2``
bits (2,081 at radius 4), its members are not compared: each lists these
neighbours, and two are within the radius exactly if they have one in common,
so the smallest member of each neighbour is tied to all others. Work is then
proportional to the members, with no pairs, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import small_batches, texts
from eventloom.llm.components import components
from eventloom.llm.minhash import mix
from eventloom.staging import stage

WORDS, SEED, RADIUS = 4, 42, 4
BLOCKS = 7
REFERENCES = 16
#: Where the blocks begin, and their bits as masks
CUTS = [64 * b // BLOCKS for b in range(BLOCKS + 1)]
MASKS = np.array([(1 << high) - (1 << low) for low, high in pairwise(CUTS)], np.uint64)
#: Hashes whose bits are counted at once.
COUNTED = 1 << 16
#: Pairs that are compared at once.
COMPARED = 1 << 18


def fingerprint(text: str, words_per_shingle: int = WORDS) -> int:
    """The fingerprint of a text, unsigned; zero without words."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    size = min(len(words), words_per_shingle)
    n = len(words) - size + 1
    total = np.zeros(64, np.int64)
    for start in range(0, n, COUNTED):
        stop = min(n, start + COUNTED)
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), SEED) for i in range(start, stop)), np.uint64, stop - start)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


@cache
def references(count: int = REFERENCES) -> np.ndarray:
    """The reference fingerprints: the same ones in each task."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """Distances (fingerprint, reference, block) of an array of 64-bit fingerprints."""
    differing = prints[:, None] ^ references()[None]
    return np.bitwise_count(differing[:, :, None] & MASKS).astype(np.int8)


def block_keys(prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Keys (fingerprint, combination) of the blocks that ``radius`` differing bits leave as they are."""
    table = pivot_table(prints)
    # the coordinates of one block as one number: 16 distances of 0 to 10
    digits = np.uint64(64 // BLOCKS + 2) ** np.arange(REFERENCES, dtype=np.uint64)
    codes = (table.astype(np.uint64) * digits[None, :, None]).sum(axis=1, dtype=np.uint64)
    keys = []
    for number, blocks in enumerate(combinations(range(BLOCKS), BLOCKS - radius)):
        h = np.full(len(prints), number + 1, np.uint64)
        for b in blocks:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + codes[:, b])
        keys.append(h)
    return np.stack(keys, axis=1).view(np.int64)


def meeting_points(prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """All fingerprints (fingerprint, neighbour) within half the radius; a pair within the radius has a common one."""
    masks = [0]
    for n in range(1, (radius + 1) // 2 + 1):
        masks += [sum(1 << b for b in bits) for bits in combinations(range(64), n)]
    return prints[:, None] ^ np.array(masks, np.uint64)[None, :]


def true_links(prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints, as places in the array."""
    table = pivot_table(prints)
    parent = list(range(len(prints)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    left, right = np.triu_indices(len(prints), 1)
    for start in range(0, len(left), COMPARED):
        a, b = left[start : start + COMPARED], right[start : start + COMPARED]
        for r in range(REFERENCES):
            # the largest coordinate difference decides
            near = np.abs(table[a, r] - table[b, r]).sum(axis=1) <= radius
            a, b = a[near], b[near]
        near = np.bitwise_count(prints[a] ^ prints[b]) <= radius
        for i, j in zip(a[near].tolist(), b[near].tolist(), strict=True):
            x, y = root(i), root(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((i, j))
    return links


def _printed(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``print`` (64 bits), staged."""
    kind = docs.schema["doc_id"].dataType

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t) for t in texts(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "print": pa.array(prints.view(np.int64))})

    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("print", T.LongType())])
    return stage(small_batches(docs).select("doc_id", "text").mapInArrow(printed, schema), "fingerprints")


def _listed(prints: DataFrame, of, name: str) -> DataFrame:
    """(print, ``name``): each fingerprint with each of the numbers that ``of`` lists for an array of them."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            for start in range(0, len(own), 256):
                part = own[start : start + 256]
                listed = of(part)
                yield pa.RecordBatch.from_pydict({"print": pa.array(np.repeat(part, listed.shape[1]).view(np.int64)), name: pa.array(listed.reshape(-1).view(np.int64))})

    return prints.select("print").mapInArrow(lists, f"print long, {name} long")


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, most: int | None = None) -> DataFrame:
    """Links (a, b) among the distinct fingerprints ``prints`` (column ``print``) that connect all within the radius; staged.

    Keys with more than ``most`` members go through meeting points; by default that
    is where comparing them would take more rows than meeting points do.
    """
    if not 0 < radius < BLOCKS:
        raise ValueError(f"radius must be between 1 and {BLOCKS - 1}")
    if most is None:
        most = meeting_points(np.zeros(1, np.uint64), radius).shape[1]
    keyed = _listed(prints, lambda p: block_keys(p, radius), "key")
    shared = stage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "shared-keys")
    # shared keys grow with the documents, so they are not broadcast at any size
    members = stage(keyed.join(shared.hint("merge"), "key"), "key-members")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for listed in batch.column("prints").to_pylist():
                own = np.array(listed, np.int64)
                found |= {(int(own[i]), int(own[j])) for i, j in true_links(own.view(np.uint64), radius)}
            yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    # lists have ``most`` members at most
    lists = members.where(F.col("members") <= most).groupBy("key").agg(F.sort_array(F.collect_list("print")).alias("prints"))
    links = lists.select("prints").distinct().mapInArrow(compared, "a long, b long")
    crowded = members.where(F.col("members") > most).select("print").distinct()
    points = _listed(crowded, lambda p: meeting_points(p, radius), "point")
    least = stage(points.groupBy("point").agg(F.min("print").alias("a"), F.max("print").alias("last")).where("a < last"), "meeting-points")
    tied = points.join(least, "point").where("a < print").select("a", F.col("print").alias("b"))
    return stage(links.unionByName(tied).distinct(), "print-links")


def simhash_duplicates(docs: DataFrame, radius: int = RADIUS, most: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id that links of at most ``radius`` differing
    bits reach, itself included. A text that is null, empty or white space has the
    fingerprint zero and is linked like any other. An id with several texts is
    linked by each of them; rows with a null id carry links like others, and have the component of
    their fingerprint (null if no row there has an id). Other columns are not read.
    """
    documents = _printed(docs)
    classes = stage(documents.groupBy("print").agg(F.min("doc_id").alias("rep")), "print-classes")
    found = fingerprint_links(classes, radius, most)
    component = components(found).select(F.col("id").alias("print"), "component")
    grouped = classes.join(component, "print", "left").select("print", "rep", F.coalesce("component", "print").alias("component"))
    grouped = stage(grouped, "print-components")
    smallest = grouped.groupBy("component").agg(F.min("rep").alias("least"))
    # one id in several classes ties these together
    ties = documents.where("doc_id is not null").groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low < high").select("doc_id")
    labels = grouped.join(smallest, "component").select("print", F.col("least").alias("component_id"))
    if not ties.isEmpty():
        own = documents.join(ties, "doc_id").join(labels, "print").select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
        again = stage(components(own), "tied-components")
        labels = labels.join(again, labels["component_id"] == again["id"], "left").select("print", F.coalesce("component", "component_id").alias("component_id"))
    labels = stage(labels, "print-labels")
    shown = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return documents.join(labels, "print").select("doc_id", shown.alias("fingerprint"), "component_id")
