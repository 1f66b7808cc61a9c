"""Queries of this package: (spark, sf_dir) to DataFrame, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import fptree, interleave, langid, licences, minhash, onebit, packing, periodic, quality, simhash, toxicity, urlfilter, winnow
from eventloom.llm.common import fold

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def query(f):
    REGISTRY[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_one_bit_neighbours(spark, sf_dir):
    index, coder = onebit.build_index(read(spark, sf_dir, "embeddings"))
    return onebit.nearest(index.where("vec_id % 100 = 0"), index, coder, k=10)


@query
def op2_url_filter(spark, sf_dir):
    return urlfilter.judge_urls(read(spark, sf_dir, "pages"), RULES)


@query
def op3_near_duplicates(spark, sf_dir):
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark, sf_dir):
    found = winnow.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op5_interleaved_shards(spark, sf_dir):
    shards = interleave.interleaved_shards(read(spark, sf_dir, "documents"), n_shards=40)
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_quality(spark, sf_dir):
    scored = quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.3)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op7_toxicity(spark, sf_dir):
    scored = toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op8_language(spark, sf_dir):
    told = langid.identify_languages(read(spark, sf_dir, "documents"))
    return told.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def document_files(documents: DataFrame) -> DataFrame:
    """The documents as files: folders by source and thousands and hundreds of the id.

    Of the documents that mention a licence, those whose id has the remainder 0, 1 or
    2 by four are licence files: of the source, of the thousands or of the hundreds.
    Any other one is a file of its hundreds, named by its id.
    """
    mentions = F.coalesce(F.regexp_like("text", F.lit("(?i)licen[sc]e")), F.lit(False))
    thousands, hundreds = F.expr("doc_id div 1000").cast("string"), F.expr("doc_id div 100 % 10").cast("string")
    level = F.when(mentions, F.pmod("doc_id", F.lit(4)))
    path = F.concat_ws("/", "source", thousands, hundreds, F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    for depth, folder in enumerate((["source"], ["source", thousands], ["source", thousands, hundreds])):
        path = F.when(level == depth, F.concat_ws("/", *folder, F.lit("LICENSE"))).otherwise(path)
    return documents.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")


@query
def op9_licences(spark, sf_dir):
    scanned = licences.scan_licences(document_files(read(spark, sf_dir, "documents")))
    return scanned.withColumnRenamed("file_id", "doc_id")


@query
def op10_packing(spark, sf_dir):
    pieces = packing.pack_documents(read(spark, sf_dir, "documents"), window=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op11_ranked_search(spark, sf_dir):
    return fptree.ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), top=50)


@query
def op12_simhash(spark, sf_dir):
    return simhash.simhash_duplicates(read(spark, sf_dir, "documents"))


@query
def op13_periodic_runs(spark, sf_dir):
    found = periodic.periodic_runs(read(spark, sf_dir, "documents"), tail=True)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
