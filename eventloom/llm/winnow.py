"""Benchmark decontamination by winnowed fingerprints, with DataFrame functions only.

Words are runs of ASCII letters, digits and all other characters beyond ASCII,
lower-cased A-Z. A fingerprint of a text is a k-gram hash that is smallest in
some window of consecutive k-grams (Schleimer, Wilkerson and Aiken,
"Winnowing"). With ``span`` words that must be found, k-grams of ``k`` words and
windows of ``span - k + 1`` of them, any shared run of ``span`` words has a
fingerprint in both texts at the same place. Ties keep all smallest k-grams.

Fingerprints of documents and benchmark items are joined on their hash. Each hit
fixes how the item lies along the document; the words are then compared along
it, and the runs of at least ``span`` equal words are the shared passages, so
hash collisions have no effect. Items shorter than ``span`` words are one window
each: the grams of these lengths are joined in the same way and compared whole.

A hot passage repeats its hash in many documents, not in many items: the join
keeps documents on the probing side, and only hits are shuffled by document. The
places of an item along a document are listed once, then the item's words join the
list, and last the lists meet the document's words, in one row per document: no
row repeats the words, and the work is proportional to the hits. Passages are
kept as stretches, so overlapping ones are counted without listing their words.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.staging import stage

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text; none for a null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, _SEPARATORS), "")


def _windows(n: Column, size: int) -> Column:
    """Starts (from 1) of the windows of ``size`` among ``n`` positions."""
    return F.when(n >= size, F.sequence(F.lit(1), n - (size - 1))).otherwise(F.array().cast("array<int>"))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    The optimizer copies a projected expression to where it is used, also into a
    lambda, which would compute it again for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _grams(words: Column, size: int) -> Column:
    """Hashes of all grams of ``size`` consecutive words."""
    return F.transform(_windows(F.size(words), size), lambda i: F.xxhash64(F.slice(words, i, size)))


def _gram_column(size: int, words: Column) -> Column:
    return _grams(words, size)


def fingerprints(words: Column, span: int, k: int) -> Column:
    """The fingerprints of an array of words: an array of (hash, at), ``at`` from 0."""
    w = span - k + 1

    def kept(grams: Column, least: Column) -> Column:
        # windows that cover gram i start at max(1, i - w + 1) .. i; slices end with the array
        covering = lambda i: F.slice(least, F.greatest(F.lit(1), i + 2 - w), F.least(i + 1, F.lit(w)))
        marked = F.transform(grams, lambda h, i: F.when(F.array_contains(covering(i), h), F.struct(h.alias("hash"), i.alias("at"))))
        return F.filter(marked, lambda p: p.isNotNull())

    def of(grams: Column) -> Column:
        return bind(_minima(grams, w), lambda m: kept(grams, m))

    return bind(words, lambda v: bind(_grams(v, k), of))


def _minima(grams: Column, w: int) -> Column:
    return F.transform(_windows(F.size(grams), w), lambda i: F.array_min(F.slice(grams, i, w)))


def fingerprint_hashes(words: Column, span: int, k: int) -> Column:
    """The distinct hashes of the fingerprints of an array of words."""
    return F.array_distinct(bind(bind(words, lambda v: _grams(v, k)), lambda g: _minima(g, span - k + 1)))


def _key() -> list[Column]:
    """Documents are told apart by id and text: a row of its own for each text of an id, one for repeated rows."""
    return [F.col("doc_id"), F.xxhash64("text").alias("print")]


def _agreeing(doc: Column, item: Column, at: Column, need: Column) -> Column:
    """The stretches (begin, end) of at least ``need`` words where two arrays of words agree; ``at`` is the first word's place."""
    whole = F.array(F.struct(at.alias("begin"), (at + F.size(doc)).alias("end")))

    def runs(same: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(same) - 1)
        starts = F.filter(places, lambda i: F.get(same, i) & ~F.coalesce(F.get(same, F.greatest(i - 1, F.lit(0))) & (i > 0), F.lit(False)))
        ends = F.filter(places, lambda i: F.get(same, i) & ~F.coalesce(F.get(same, i + 1), F.lit(False)))
        return F.filter(F.zip_with(starts, ends, lambda a, b: F.struct((at + a).alias("begin"), (at + b + 1).alias("end"))), lambda r: r["end"] - r["begin"] >= need)

    none = whole.isNull() | (F.size(doc) < need)
    found = F.when(doc == item, whole).otherwise(bind(F.zip_with(doc, item, lambda a, b: a == b), runs))
    return F.when(none, F.array().cast("array<struct<begin:int,end:int>>")).otherwise(found)


def _along(words: Column, item: Column, shift: Column, span: int) -> Column:
    """Where a document agrees with an item whose first word lies at ``shift``."""
    begin = F.greatest(F.lit(0), -shift)
    length = F.greatest(F.lit(0), F.least(F.size(item) - begin, F.size(words) - shift - begin))
    need = F.least(F.lit(span), F.size(item))
    return bind(F.slice(words, shift + begin + 1, length), lambda d: bind(F.slice(item, begin + 1, length), lambda v: _agreeing(d, v, shift + begin, need)))


def _found(docs: DataFrame, items: DataFrame, span: int, k: int) -> DataFrame:
    """(doc_id, print, found): each document with passages, as an array of (item_id, shift, runs); staged."""
    known = items.select("item_id", words_of(F.col("text")).alias("words")).where("item_id is not null and size(words) > 0")
    known = stage(known, "benchmark-words")
    short = [r.n for r in known.where(F.size("words") < span).select(F.size("words").alias("n")).distinct().collect()]
    entries = known.where(F.size("words") >= span).select("item_id", F.lit(0).alias("size"), F.explode(fingerprints(F.col("words"), span, k)).alias("p")).select("item_id", "size", "p.hash", "p.at")
    if short:
        whole = known.where(F.size("words") < span).select("item_id", F.size("words").alias("size"), F.xxhash64("words").alias("hash"), F.lit(0).alias("at"))
        entries = entries.unionByName(whole)
    entries = stage(entries, "benchmark-prints")

    text_words = words_of(F.col("text"))
    texts = docs.where(F.col("text").isNotNull()).select(*_key(), "text")
    # most documents have no hit: their fingerprints are looked up without places
    hashes = texts.select("doc_id", "print", F.explode(fingerprint_hashes(text_words, span, k)).alias("hash"))
    hit = stage(hashes.join(entries.where("size = 0").select("hash").distinct(), "hash").select("doc_id", "print").distinct(), "hit-documents")
    same = _same(texts, hit)
    prints = texts.join(hit, same, "left_semi").select("doc_id", "print", F.lit(0).alias("size"), F.explode(fingerprints(text_words, span, k)).alias("p")).select("doc_id", "print", "size", "p.hash", "p.at")
    for n in sorted(short):
        grams = texts.select("doc_id", "print", F.lit(n).alias("size"), F.posexplode(bind(text_words, partial(_gram_column, n))).alias("at", "hash"))
        prints = prints.unionByName(grams.select("doc_id", "print", "size", "hash", "at"))
    found = prints.alias("d").join(entries.alias("b"), (F.col("d.hash") == F.col("b.hash")) & (F.col("d.size") == F.col("b.size")))
    aligned = found.select("doc_id", "print", "item_id", (F.col("d.at") - F.col("b.at")).alias("shift")).distinct()
    listed = stage(aligned.groupBy("doc_id", "print", "item_id").agg(F.collect_list("shift").alias("shifts")), "alignments")

    worded = listed.join(known.select("item_id", F.col("words").alias("item")), "item_id")
    per_doc = stage(worded.groupBy("doc_id", "print").agg(F.collect_list(F.struct("item_id", "item", "shifts")).alias("lists")), "alignments-by-document")
    # a repeated row gives the same passages once
    once = texts.join(per_doc, _same(texts, per_doc), "left_semi").dropDuplicates(["doc_id", "print"])
    sides = once.join(per_doc.withColumnRenamed("doc_id", "own_id").withColumnRenamed("print", "own_print"), F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("print") == F.col("own_print")))

    def compared(words: Column) -> Column:
        def of_item(entry: Column) -> Column:
            return F.transform(entry["shifts"], lambda x: F.struct(entry["item_id"].alias("item_id"), x.alias("shift"), _along(words, entry["item"], x, span).alias("runs")))

        return F.filter(F.flatten(F.transform("lists", of_item)), lambda f: F.size(f["runs"]) > 0)

    passages = sides.select("doc_id", "print", bind(text_words, compared).alias("found"))
    return stage(passages.where(F.size("found") > 0), "passages")


def _same(left: DataFrame, right: DataFrame) -> Column:
    """The same document on both sides, also with a null id."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["print"] == right["print"])


def shared_passages(docs: DataFrame, items: DataFrame, span: int = 10, k: int = 5) -> DataFrame:
    """One row per (document, item, alignment) with shared passages.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``.
    Columns: ``doc_id``, ``item_id``, ``shift`` (the word of the document along
    the item's first one; may be negative), ``runs`` (the stretches of shared words
    as ``begin`` and ``end``, numbered from 0) and ``hits`` (the places of all
    these words). Items with a null id, and rows without words, have none. A
    document is a text with its id: repeated rows come once, and each of several texts of one id
    has its own passages. Rows that repeat an item id are compared one by one under that id.
    """
    rows = _found(docs, items, span, k).select("doc_id", F.inline("found"))
    hits = F.flatten(F.transform("runs", lambda r: F.sequence(r["begin"], r["end"] - 1)))
    return rows.select("doc_id", "item_id", "shift", "runs", hits.alias("hits"))


def _covered(found: Column) -> Column:
    """How many words lie in some stretch."""
    stretches = F.array_sort(F.flatten(F.transform(found, lambda f: f["runs"])))

    def add(so_far: Column, r: Column) -> Column:
        fresh = F.greatest(F.lit(0), r["end"] - F.greatest(r["begin"], so_far["end"]))
        return F.struct((so_far["n"] + fresh).alias("n"), F.greatest(so_far["end"], r["end"]).alias("end"))

    return F.aggregate(stretches, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")), add, lambda s: s["n"])


def contamination(docs: DataFrame, items: DataFrame, span: int = 10, k: int = 5) -> DataFrame:
    """One row per document: its words, those in shared passages, and the items.

    Columns ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``item_ids`` (sorted
    as text). A null or empty text has no words; a document without hits has
    zeros and an empty array, and so has every document if ``items`` is empty.
    Each row is judged by its own text, whatever other rows share its id, which may be null.
    """
    names = F.sort_array(F.array_distinct(F.transform("found", lambda f: f["item_id"].cast("string"))))
    hit = _found(docs, items, span, k).select("doc_id", "print", _covered(F.col("found")).alias("n_hit"), names.alias("item_ids"))
    hit = stage(hit, "contaminated")
    counted = docs.select(*_key(), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    joined = counted.join(hit, _same(counted, hit), "left").select(counted["doc_id"], "n_words", "n_hit", "item_ids")
    items_of = F.coalesce("item_ids", F.array().cast("array<string>"))
    return joined.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size(items_of).cast("long").alias("n_items"), items_of.alias("item_ids"))
