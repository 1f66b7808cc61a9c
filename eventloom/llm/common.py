"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.staging import stage

#: Bits that are broadcast to tell rows apart, 16 MB at most.
MOST_BITS = 1 << 27

#: Partial sums are merged in so many groups, so that the driver gets this many rows at most.
MERGE_GROUPS = 16


#: Rows in one batch for a Python worker.
BATCH_ROWS = 500


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that sends texts to Python workers in batches of few rows.

    Texts may be long, and a worker holds a batch as a whole, with its copies.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def fold(column: str, modulus: int) -> Column:
    """The fold of a row: CRC-32 of its id as text, modulo ``modulus``; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(0))


def sampled(columns: str | list[str], fraction: Column | float, seed: int) -> Column:
    """True for about ``fraction`` of the different values, the same ones in each run."""
    names = [columns] if isinstance(columns, str) else columns
    drawn = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in names], F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return drawn < fraction


def maybe_in(rows: DataFrame, wanted: DataFrame, column: str, most_bits: int = MOST_BITS) -> DataFrame:
    """``rows`` with ``maybe``: true for each whose ``column`` has a value that ``wanted`` has, and for few others.

    A value sets one bit, in at least 16 times as many bits as ``wanted`` has rows, up to
    ``most_bits``; more rows make more others true. The bits are all that is broadcast, so texts stay where they are.
    """
    n = wanted.count()
    bits = 1 << 15
    while bits < min(16 * n, most_bits):
        bits *= 2
    # bitmaps are numbered and filled from 1
    place = F.pmod(F.xxhash64(column), F.lit(bits)) + 1
    maps = stage(wanted.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("map")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")), "bitmaps")
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("map", F.bitmap_bucket_number(place)).join(F.broadcast(maps), "map", "left")
    return found.withColumn("maybe", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("map", "bits")


def texts(column: pa.Array) -> list[str]:
    """The column's texts; a null is an empty text."""
    return [t or "" for t in column.to_pylist()]


def chunks(lengths: list[int], most: int) -> Iterator[slice]:
    """Consecutive slices whose lengths sum to about ``most``; a longer item has its own slice."""
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield slice(start, len(lengths))


def sum_over_partitions(df: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray | None:
    """``partial`` of each partition, summed elementwise in two steps.

    Each partition gives one vector of doubles; executors add these up in
    :data:`MERGE_GROUPS` groups, and the driver adds one vector of each group.
    """

    def first(batches):
        vector = np.asarray(partial(batches), dtype=np.float64)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part % MERGE_GROUPS], pa.int32()), "vector": pa.array([vector.tobytes()], pa.binary())})

    def merge(batches):
        total = None
        for batch in batches:
            for blob in batch.column("vector").to_pylist():
                vector = np.frombuffer(blob)
                total = vector.copy() if total is None else total + vector
        if total is not None:
            yield pa.RecordBatch.from_pydict({"vector": pa.array([total.tobytes()], pa.binary())})

    partials = df.mapInArrow(first, "part int, vector binary").repartition(MERGE_GROUPS, "part")
    merged = partials.select("vector").mapInArrow(merge, "vector binary")
    vectors = [np.frombuffer(row.vector) for row in merged.collect()]
    return np.sum(vectors, axis=0) if vectors else None
