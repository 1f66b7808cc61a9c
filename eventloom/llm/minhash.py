"""Near-duplicates: fast similarity sketches, banding, exact verification.

A document is the set of its distinct five-word shingles. Its sketch (Dahlgaard,
Knudsen and Thorup, "Fast similarity sketching") throws the shingles into the
coordinates in rounds; a coordinate keeps the smallest hash of the first round
that reached it, and after as many rounds as coordinates each round aims at one
coordinate, so all are filled. Two sketches agree in a coordinate with the
probability of the Jaccard similarity, and the share of agreeing coordinates is
as concentrated as for independent hashes.

Sketches are cut into bands, and documents that agree in a band are candidates.
With 64 bands of 6 coordinates, a pair of similarity 0.75 is missed with
probability (1 - 0.75^6)^64, about 4 in a million.

Documents with equal sets are one *class*, and classes go on. The pivot p of a
bucket is the member that meets most others over all its buckets; every other
member is compared with it, and the links merge into components. What is left
are pairs x, y of a bucket in two components, where at least one, say x, has no
link to p. Let y lack ``lost`` shingles of p and have ``new`` ones outside p. A
link of x and y needs an intersection of t / (1 + t) times both sizes (t is the
least similarity); as x is short of that with p, x and y must agree in more than
(lost + t * new) / (1 + t) of the differences of y from p. So it is enough to
look up the other, rarest differences of y (a prefix filter) among all
differences of the members without a link to p; if y has no link to p either,
the same holds the other way round, and the rarest differences of both are
enough. Nearly all differences of copies
are their own, so large groups cost time in proportion to their size; still no
candidate is dropped, and each comparison uses the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import small_batches, texts
from eventloom.llm.components import components
from eventloom.staging import stage

WORDS = 5
BANDS, ROWS = 64, 6
#: Hashes that a sketch computes at once.
BLOCK = 1 << 16

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, words_per_shingle: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; of all words if there are fewer."""
    words = text.encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = min(n, words_per_shingle)
    rolled = np.full(n - size + 1, size, dtype=np.uint64)
    for j in range(size):
        rolled = mix(rolled * _A + hashes[j : n - size + 1 + j])
    return np.unique(rolled)


def sketch(shingles: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """The sketch of a nonempty set, ``size`` coordinates of 64 bits."""
    n = len(shingles)
    filled = np.zeros(size, dtype=bool)
    result = np.zeros(size, dtype=np.uint64)
    done, none = 0, np.uint64(0xFFFFFFFFFFFFFFFF)
    wanted = max(1, min(int(size * (np.log(size) + 2) / n) + 1, BLOCK // n))
    while done < size and not filled.all():
        rounds = np.arange(done, min(size, done + wanted), dtype=np.uint64)
        h = mix(shingles[None, :] ^ mix((rounds + np.uint64(1)) * _A)[:, None])
        at = ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        # the round leads, then the hash
        value = (np.arange(len(rounds), dtype=np.uint64) << np.uint64(47))[:, None] | (mix(h) >> np.uint64(17))
        least = np.full(size, none)
        np.minimum.at(least, at.ravel(), value.ravel())
        new = ~filled & (least != none)
        result[new] = least[new] + np.uint64(done * int(_A) & 0xFFFFFFFFFFFFFFFF)
        filled |= new
        done += len(rounds)
    for coordinate in np.flatnonzero(~filled):
        result[coordinate] = mix(shingles ^ mix(np.array([size + coordinate + 1], dtype=np.uint64) * _A)).min()
    return result


def band_hashes(coordinates: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash for each band, different between bands also for equal coordinates."""
    bands = coordinates.reshape(-1, rows)
    h = np.arange(1, len(bands) + 1, dtype=np.uint64) * _B
    for j in range(rows):
        h = mix(h * _A + bands[:, j])
    return h.view(np.int64)


def described(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``key`` (digest of the set) and ``bands``; staged."""
    kind = docs.schema["doc_id"].dataType

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, bands = [], [], []
            for text in texts(batch.column("text")):
                shingles = shingle_set(text)
                sizes.append(len(shingles))
                keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                bands.append(band_hashes(sketch(shingles)) if len(shingles) else None)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_shingles": pa.array(sizes, pa.int64()), "key": pa.array(keys, pa.binary()), "bands": pa.array(bands, pa.list_(pa.int64()))})

    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n_shingles", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    return stage(small_batches(docs).select("doc_id", "text").mapInArrow(sketched, schema), "sketches")


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The shingle sets of the documents with these ids; staged."""
    kind = docs.schema["doc_id"].dataType

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, doc in zip(texts(batch.column("text")), batch.column("doc_id"), strict=True):
                yield pa.RecordBatch.from_pydict({"id": pa.array([doc.as_py()], batch.schema.field("doc_id").type), "shingles": pa.array([shingle_set(text).view(np.int64)], pa.list_(pa.int64()))})

    schema = T.StructType([T.StructField("id", kind), T.StructField("shingles", T.ArrayType(T.LongType()))])
    return stage(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").mapInArrow(shingled, schema), "shingle-sets")


def _true_links(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have ``percent`` of similarity; staged."""
    ids = stage(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct(), "candidates")
    sets = _sets(docs, ids)
    sides = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b")
    common = sides.select("a", "b", F.size("left").alias("n"), F.size("right").alias("m"), F.size(F.array_intersect("left", "right")).alias("common"))
    return stage(common.where(100 * F.col("common") >= percent * (F.col("n") + F.col("m") - F.col("common"))).select("a", "b"), "true-links")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their
    shingle sets; ``component_id`` is the smallest id that links reach, and
    ``kept`` marks the document with that id. A text that is null, empty or
    white space has no shingles and is linked with nothing. Ids should be
    unique: repeated rows give repeated results, and an id with several texts is
    linked by each of them. A row with a null id is kept, with a null component.
    Other columns are not read.
    """
    documents = described(docs)
    # one row of each class goes through the bands; equal sets have equal bands
    least = documents.where("doc_id is not null and key is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = stage(least, "classes")
    banded = classes.select(F.col("rep").alias("id"), "n", F.explode("bands").alias("band"))
    shared = stage(banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared-bands")
    members = stage(banded.join(shared, "band"), "bucket-members")
    met = stage(members.groupBy("id").agg(F.sum("size").alias("met")), "members-met")
    central = members.join(met, "id").groupBy("band").agg(F.min(F.struct(-F.col("met"), "id", "n")).alias("pivot"))
    pivots = stage(central.select("band", F.col("pivot.id").alias("p"), F.col("pivot.n").alias("m")), "pivots")
    pairs = stage(members.join(pivots, "band").where("id <> p").select("p", "m", "id", "n").distinct(), "pairs")
    close = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    links = _true_links(pairs.where(close).select(F.col("p").alias("a"), F.col("id").alias("b")), docs, percent)
    more = _pairs_across(pairs, links, docs, percent)
    component = components(links.unionByName(_true_links(more, docs, percent)))

    ids = classes.select("key", "rep").join(component, F.col("rep") == F.col("id"), "left").select("key", F.coalesce("component", "rep").alias("component"))
    labels = stage(ids, "class-components")
    result = documents.select("doc_id", "n_shingles", "key").join(labels, "key", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return result.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _pairs_across(pairs: DataFrame, links: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of members of one pivot that may still be linked; staged.

    ``pairs`` are all (pivot, member), ``links`` those that hold.
    """
    found = components(links)
    linked = links.select(F.col("a").alias("p"), F.col("b").alias("id"), F.lit(True).alias("linked"))
    placed = pairs.join(found, "id", "left").join(linked, ["p", "id"], "left")
    placed = stage(placed.select("p", "id", "n", F.coalesce("component", "id").alias("component"), F.coalesce("linked", F.lit(False)).alias("linked")), "members")
    mixed = placed.groupBy("p").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("p")
    left = stage(placed.join(mixed, "p"), "members-left")
    sets = _sets(docs, left.select(F.col("id").alias("doc_id")).unionByName(left.select(F.col("p").alias("doc_id"))).distinct())
    sides = left.join(sets, "id").join(sets.select(F.col("id").alias("p"), F.col("shingles").alias("of_pivot")), "p")
    new, lost = F.array_except("shingles", "of_pivot"), F.array_except("of_pivot", "shingles")
    # the differences that may all be other ones than the agreeing
    others = F.size("new") + F.size("lost") - F.floor((100 * F.size("lost") + percent * F.size("new")) / (100 + percent)).cast("int")
    differing = sides.select("p", "id", "n", "component", "linked", new.alias("new"), lost.alias("lost")).select("p", "id", "n", "component", "linked", others.alias("others"), F.explode(F.concat(F.transform("new", lambda s: F.struct(s.alias("shingle"), F.lit(False).alias("lost"))), F.transform("lost", lambda s: F.struct(s.alias("shingle"), F.lit(True).alias("lost"))))).alias("d"))
    differing = stage(differing.select("p", "id", "n", "component", "linked", "others", "d.shingle", "d.lost"), "differences")
    key = ["p", "shingle", "lost"]
    counts = stage(differing.groupBy(key).agg(F.count(F.lit(1)).alias("times"), (F.min("component") < F.max("component")).alias("across")), "difference-counts")
    rarest = Window.partitionBy("p", "id").orderBy("times", "shingle", "lost")
    ranked = differing.join(counts, key).withColumn("rank", F.row_number().over(rarest))
    ranked = stage(ranked.where("across").select(*key, "id", "n", "component", "linked", (F.col("rank") <= F.col("others")).alias("rare")), "shared-differences")
    prefix = ranked.where("rare").drop("rare")
    whole = ranked.where("not linked").select(*key, F.col("id").alias("other"), F.col("n").alias("m"), F.col("component").alias("other_component"), F.col("rare").alias("other_rare"))
    close = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    # of two members without a link each pair comes once
    once = F.col("linked") | (F.col("other_rare") & (F.col("id") < F.col("other")))
    met = prefix.join(whole, key).where((F.col("component") != F.col("other_component")) & close & once)
    return stage(met.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct(), "pairs")
