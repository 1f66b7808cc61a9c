"""Sharding by proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked; the fractional
rank (rank - 1/2) / (rows of the source) spreads each source evenly over the
interval from 0 to 1. All rows are sorted by it and cut into shards of equal
counts, so that every shard has the mixture of the whole, and the rows of a
shard are in mixed order.

Both orders are made by range partitioning: the sorted partitions are written
with their numbers, their counts are summed up, and a rank is the count before
the partition plus the place in it. No partition is larger because of a source
that holds most rows. A written partition keeps its number, so the loss of an
executor changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.staging import stage


def ordered_positions(rows: DataFrame, order: list[str], within: list[str], into: str, partitions: int) -> DataFrame:
    """``rows`` with their position (from 0) in ``order`` among those with equal ``within``.

    ``within`` must be a prefix of ``order``. Rows that are equal in ``order``
    are put in some order.
    """
    sorted_rows = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    parts = stage(sorted_rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    counts = parts.groupBy("_part", *within).agg(F.count(F.lit(1)).alias("_count"))
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition and group: as many as partitions and groups together
    starts = stage(counts.withColumn("_before", F.coalesce(F.sum("_count").over(before), F.lit(0))).drop("_count"), "starts")
    keys = ["_part", *within]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_at")) - 1
    placed = parts.withColumn("_place", place)
    joined = placed.join(starts.select(*[F.col(k).alias(f"_{k}") for k in keys], "_before"), [placed[k].eqNullSafe(F.col(f"_{k}")) for k in keys])
    return joined.withColumn(into, F.col("_before") + F.col("_place")).select(*rows.columns, into)


def interleaved_shards(docs: DataFrame, n_shards: int = 40, seed: int = 17, partitions: int | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``text_crc32``, ``shard``, ``slot``.

    ``size`` is the text's UTF-8 bytes (none for a null) plus 16, ``text_crc32``
    the CRC-32 of these bytes. ``slot`` counts the rows of a shard from 0. Counts
    of shards differ by one at most. Rows without a source are a source of their
    own, rows without an id have one shuffle key, and repeated rows are ranked in
    some order. Other columns are not read.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary")).alias("shuffle_key"),
    )
    rows = stage(rows, "shard-rows")
    ranked = ordered_positions(rows, ["source", "shuffle_key", "doc_id"], ["source"], "rank", n)
    totals = stage(rows.groupBy("source").agg(F.count(F.lit(1)).alias("of_source")).withColumnRenamed("source", "_source"), "source-sizes")
    fraction = (2 * F.col("rank") + 1) / (2 * F.col("of_source"))
    spread = ranked.join(totals, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "source", "size", "text_crc32", fraction.alias("fraction"))
    placed = ordered_positions(stage(spread, "fractions"), ["fraction", "source", "doc_id"], [], "position", n)
    total = rows.count()
    shard = F.expr(f"cast(position * {n_shards}L div {max(1, total)}L as int)")
    first = F.expr(f"(shard * {total}L + {n_shards - 1}L) div {n_shards}L")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("position") - first).select("doc_id", "source", "size", "text_crc32", "shard", "slot")
