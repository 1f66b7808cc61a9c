"""A training-data pipeline: five stages over the documents, each written and read again.

Every stage takes null and repeated ids, null, empty and long texts, repeated rows and
empty tables. The classifiers judge a text, so equal texts go or stay together; rows
without text or letters go at the language stage. Groups of near-duplicates and
contaminated documents are found by id and text together, so an id with several texts
loses only those that have to go, and of repeated rows with words one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import langid, minhash, packing, quality, winnow
from eventloom.llm.common import maybe_in
from eventloom.staging import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents whose language is less certain go.
LEAST_CERTAIN = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score_quality(docs, labels, threshold=0.3).where("predicted = 1").select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language can be told."""
    told = langid.identify_languages(docs)
    return told.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_CERTAIN)).select(*COLUMNS)


def told_apart(docs: DataFrame) -> DataFrame:
    """The documents with ``row``, a hash of id and text: ids may repeat or be null, and rows that are alike in both share it."""
    return docs.select(*COLUMNS, F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.coalesce("text", F.lit("")), F.col("text").isNull()).alias("row"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates: that with the smallest id; a null id only where no other is.

    Only texts of rows that have to go, or are repeated, are exchanged: bits tell all others apart.
    """
    rows = told_apart(docs)
    found = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id", "n_shingles")
    found = stage(found, "near-duplicates")
    # a text without words is linked with nothing
    groups = found.where("n_shingles > 0").groupBy("component_id").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("component_id")
    groups = stage(groups, "groups")
    grouped = stage(found.join(groups, "component_id").select("row", "component_id").distinct(), "grouped")
    members = stage(rows.select("row", "doc_id").join(grouped, "row").groupBy("row", "doc_id", "component_id").agg(F.count(F.lit(1)).alias("copies")), "group-members")
    first = stage(members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")).select("component_id", F.col("first.row").alias("first")), "group-firsts")
    judged = members.join(first, "component_id").groupBy("row").agg(F.max(F.col("row") == F.col("first")).alias("stays"), F.sum("copies").alias("copies"))
    # a first row without a copy stays like a row outside of all groups
    judged = stage(judged.where("not stays or copies > 1").select("row", "stays"), "judged")
    told = maybe_in(rows, judged, "row")
    met = stage(told.where("maybe").drop("maybe").join(judged, "row", "left").where("stays is null or stays"), "judged-rows")
    # repeated rows of the same id and text are one document
    once = met.where("stays").dropDuplicates(["row"])
    return told.where("not maybe").select(*COLUMNS).unionByName(met.where("stays is null").select(*COLUMNS)).unionByName(once.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that share no passage with a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = told_apart(docs)
    gone = winnow.shared_passages(rows.select(F.col("row").alias("doc_id"), "text"), items).select(F.col("doc_id").alias("row")).distinct()
    return rows.join(gone, "row", "left_anti").select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into windows of 2048 ids."""
    pieces = packing.pack_documents(docs, window=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("MinHash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The classifiers and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
