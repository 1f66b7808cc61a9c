"""Ordered scans over groups of any size.

A window over a group runs in one task. That is right for ordinary groups and
wrong for a case, state or column that holds a third of all rows, and for a
rank over a whole table. ``ordered_scan`` therefore first looks for large
groups (``find_splits``). When there are none it is a plain window. Otherwise
every large group is cut into consecutive segments, the window runs per
(group, segment), and what a segment must know about the earlier or later ones
(row counts, sums, border rows, last values) is computed from one summary row
per segment and joined back.

The cut positions come from a sample of the sort keys, as for a range
partitioning, but the results do not depend on them: wherever the cuts lie,
every row is scanned and the outcome is the same. A scan over a whole table has
no cuts to join: its segments are the partitions of a range partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from eventloom.spec import col
from eventloom.staging import stage

SEGMENT = "__segment"
CUTS = "__cuts"


@dataclass(frozen=True)
class SplitPolicy:
    """When a group is cut.

    ``rows_per_segment`` is the size one task should get. One row in
    ``sample_every`` is looked at to find cuts. At most ``max_cuts`` cuts are
    kept for a whole table (the segments get larger beyond it), which bounds
    what is collected and broadcast.
    """

    rows_per_segment: int = 2_000_000
    sample_every: int = 65_536
    max_cuts: int = 100_000

    @classmethod
    def of(cls, spark: SparkSession) -> SplitPolicy:
        """The defaults, or what the ``spark.eventloom.*`` settings say."""
        get = spark.conf.get
        return cls(
            int(get("spark.eventloom.rowsPerSegment", str(cls.rows_per_segment))),
            int(get("spark.eventloom.sampleEvery", str(cls.sample_every))),
            int(get("spark.eventloom.maxCuts", str(cls.max_cuts))),
        )


@dataclass(frozen=True)
class Splits:
    """Cuts of the large groups: (keys..., array of sort positions).

    Without keys there is no table of cuts, only their number ``longest``.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: DataFrame | None
    longest: int = 0


def unsplit(keys: Sequence[str], order: Sequence[str]) -> Splits:
    """For tables that are known to be small, such as one row per column."""
    return Splits(tuple(keys), tuple(order), None)


def find_splits(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], policy: SplitPolicy | None = None
) -> Splits:
    """Find the groups that are too large for one task and where to cut them.

    Runs one narrow job over ``keys`` and ``order``. Take the result once per
    log and hand it to every operator that scans the log in the same order. The
    positions must not tie within a group (use ``distinct`` where they may).
    """
    spark = df.sparkSession
    policy = policy or SplitPolicy.of(spark)
    keys, order = tuple(keys), tuple(order)
    sample = df.select(*map(col, dict.fromkeys(keys + order)))
    if policy.sample_every > 1:
        # by the sort position alone (unique within a group): the filter then sinks to the
        # scan, below whatever computes the keys
        sample = sample.where(F.pmod(F.xxhash64(*map(col, order)), F.lit(policy.sample_every)) == 0)
    stride = max(1, policy.rows_per_segment // policy.sample_every)
    if not keys:
        # the rows of a whole table are dealt out by range: only their number matters
        sampled = sample.agg(F.count(F.lit(1)).alias("n")).first()["n"]
        return Splits(keys, order, None, min(policy.max_cuts, sampled // stride))

    def cut_rows(sampled: DataFrame, stride: int) -> list:
        ranks = Window.partitionBy(*map(col, keys)).orderBy(*map(col, order))
        ranked = sampled.withColumn("__rank", F.row_number().over(ranks))
        return ranked.where(F.col("__rank") % stride == 0).drop("__rank").limit(policy.max_cuts + 1).collect()

    rows = cut_rows(sample, stride)
    if len(rows) > policy.max_cuts:
        # wider segments: at most (rows of the sample) / stride cuts
        sample = stage(sample, "split-sample")
        rows = cut_rows(sample, max(stride, -(-sample.count() // policy.max_cuts)))
    if not rows:
        return Splits(keys, order, None)
    position = F.struct(*map(col, order))
    table = spark.createDataFrame(rows, sample.schema)
    cuts = table.groupBy(*map(col, keys)).agg(F.sort_array(F.collect_list(position)).alias(CUTS))
    # staged, so that its size in bytes decides whether it is broadcast
    return Splits(keys, order, stage(cuts, "cuts"), len(rows))


# --- what can be computed in a scan -----------------------------------------


class ScanColumn:
    """One output of a scan: its plain window form, and its three-step form.

    ``summary`` condenses a segment, ``carry`` brings the summaries of the other
    segments to a segment, ``merge`` joins the local value and the carry.
    """

    def over(self, ordered: WindowSpec, group: WindowSpec) -> Column:
        raise NotImplementedError

    def summary(self, position: Column) -> Column:
        raise NotImplementedError

    def carry(self, summary: Column, ordered: WindowSpec, group: WindowSpec) -> Column:
        raise NotImplementedError

    def local(self, ordered: WindowSpec, group: WindowSpec) -> Column:
        return self.over(ordered, group)

    def merge(self, local: Column, carry: Column) -> Column:
        raise NotImplementedError

    def finish(self, value: Column) -> Column:
        return value


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _upto(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


@dataclass(frozen=True)
class RowNumber(ScanColumn):
    """1, 2, ... in order."""

    def over(self, ordered, group):
        return F.row_number().over(ordered).cast("long")

    def summary(self, position):
        return F.count(F.lit(1))

    def carry(self, summary, ordered, group):
        return F.sum(summary).over(_before(ordered))

    def merge(self, local, carry):
        return local + F.coalesce(carry, F.lit(0))


@dataclass(frozen=True)
class RunningSum(ScanColumn):
    """Sum up to the row, or of the rows before it. Nulls count as 0."""

    value: Column
    before: bool = False

    def _zero_based(self, total: Column) -> Column:
        return F.coalesce(total, F.lit(0))

    def over(self, ordered, group):
        frame = _before(ordered) if self.before else _upto(ordered)
        return self._zero_based(F.sum(self.value).over(frame))

    def summary(self, position):
        return self._zero_based(F.sum(self.value))

    def carry(self, summary, ordered, group):
        return F.sum(summary).over(_before(ordered))

    def merge(self, local, carry):
        return local + self._zero_based(carry)


@dataclass(frozen=True)
class Previous(ScanColumn):
    """Value in the row before; null in the first row."""

    value: Column

    def over(self, ordered, group):
        return F.lag(self.value).over(ordered)

    def local(self, ordered, group):
        return F.lag(F.struct(self.value.alias("v"))).over(ordered)

    def summary(self, position):
        return F.max_by(F.struct(self.value.alias("v")), position)

    def carry(self, summary, ordered, group):
        return F.lag(summary).over(ordered)

    def merge(self, local, carry):
        return F.coalesce(local, carry)

    def finish(self, value):
        return value["v"]


@dataclass(frozen=True)
class Following(ScanColumn):
    """Value in the row after; null in the last row."""

    value: Column

    def over(self, ordered, group):
        return F.lead(self.value).over(ordered)

    def local(self, ordered, group):
        return F.lead(F.struct(self.value.alias("v"))).over(ordered)

    def summary(self, position):
        return F.min_by(F.struct(self.value.alias("v")), position)

    def carry(self, summary, ordered, group):
        return F.lead(summary).over(ordered)

    def merge(self, local, carry):
        return F.coalesce(local, carry)

    def finish(self, value):
        return value["v"]


@dataclass(frozen=True)
class FillForward(ScanColumn):
    """The row's value, or the last one before it that is not null."""

    value: Column

    def over(self, ordered, group):
        return F.last(self.value, ignorenulls=True).over(_upto(ordered))

    def summary(self, position):
        return F.max_by(self.value, F.when(self.value.isNotNull(), position))

    def carry(self, summary, ordered, group):
        return F.last(summary, ignorenulls=True).over(_before(ordered))

    def merge(self, local, carry):
        return F.coalesce(local, carry)


@dataclass(frozen=True)
class GroupMin(ScanColumn):
    """Smallest value of the group, in every row of it."""

    value: Column

    def over(self, ordered, group):
        return F.min(self.value).over(group)

    def summary(self, position):
        return F.min(self.value)

    def carry(self, summary, ordered, group):
        return F.min(summary).over(group)

    def merge(self, local, carry):
        return F.coalesce(carry, local)


@dataclass(frozen=True)
class GroupMax(ScanColumn):
    """Largest value of the group (for booleans: any), in every row of it."""

    value: Column

    def over(self, ordered, group):
        return F.max(self.value).over(group)

    def summary(self, position):
        return F.max(self.value)

    def carry(self, summary, ordered, group):
        return F.max(summary).over(group)

    def merge(self, local, carry):
        return F.coalesce(carry, local)


@dataclass(frozen=True)
class GroupSum(ScanColumn):
    """Sum of the group, in every row of it. Nulls count as 0."""

    value: Column

    def over(self, ordered, group):
        return F.coalesce(F.sum(self.value).over(group), F.lit(0))

    def summary(self, position):
        return F.sum(self.value)

    def carry(self, summary, ordered, group):
        return F.sum(summary).over(group)

    def merge(self, local, carry):
        return F.coalesce(carry, local)


# --- the scan ----------------------------------------------------------------


def _segment_of(position: Column, cuts: Column, longest: int) -> Column:
    """How many cuts lie at or before ``position``: a binary search, bit by bit."""
    steps = F.array(*[F.lit(1 << b) for b in range(longest.bit_length() - 1, -1, -1)])

    def descend(found: Column, step: Column) -> Column:
        probe = found + step
        inside = (probe <= F.size(cuts)) & (F.get(cuts, probe - 1) <= position)
        return F.when(inside, probe).otherwise(found)

    return F.aggregate(steps, F.lit(0), descend)


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, ScanColumn],
    splits: Splits | None = None,
) -> DataFrame:
    """Add ``columns`` computed over each group of ``keys`` in ``order``.

    ``keys`` may be empty: the scan then runs over the whole table. ``order``
    must not tie within a group. ``splits`` may have been taken from another
    table with the same keys and a prefix of the same order.
    """
    keys, order = tuple(keys), tuple(order)
    if splits is None:
        splits = find_splits(df, keys, order)
    if splits.keys != keys or splits.order != order[: len(splits.order)]:
        raise ValueError(f"splits of {splits.keys}, {splits.order} do not fit {keys}, {order}")
    kept = df.columns
    if not splits.longest:
        group = Window.partitionBy(*(list(map(col, keys)) or [F.lit(0)]))
        ordered = group.orderBy(*map(col, order))
        return df.select(*map(col, kept), *[c.over(ordered, group).alias(n) for n, c in columns.items()])

    if keys:
        cuts = splits.cuts.select(*[col(k).alias(f"__cut_{i}") for i, k in enumerate(keys)], CUTS)
        same_group = [col(k).eqNullSafe(F.col(f"__cut_{i}")) for i, k in enumerate(keys)]
        position = F.struct(*map(col, splits.order))
        segment = F.when(F.col(CUTS).isNotNull(), _segment_of(position, F.col(CUTS), splits.longest))
        helpers = [f"__cut_{i}" for i in range(len(keys))]
        parted = df.join(cuts, same_group, "left").select("*", segment.alias(SEGMENT)).drop(CUTS, *helpers)
    else:
        # written with the number of its range partition, a row keeps its segment
        ranged = df.repartitionByRange(splits.longest + 1, *map(col, order))
        parted = stage(ranged.withColumn(SEGMENT, F.spark_partition_id()), "segments")

    # one summary row per segment of a large group: at most max_cuts more than there are such groups
    full = F.struct(*map(col, order))
    names = {n: f"__part_{i}" for i, n in enumerate(columns)}
    summary = (
        parted.where(F.col(SEGMENT).isNotNull())
        .groupBy(*map(col, keys), SEGMENT)
        .agg(*[c.summary(full).alias(names[n]) for n, c in columns.items()])
    )
    group = Window.partitionBy(*(list(map(col, keys)) or [F.lit(0)]))
    ordered = group.orderBy(SEGMENT)
    carries = summary.select(
        *[col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
        F.col(SEGMENT).alias("__seg"),
        *[c.carry(F.col(names[n]), ordered, group).alias(f"{names[n]}_carry") for n, c in columns.items()],
    )
    same = [col(k).eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(keys)]
    # staged, so that its size in bytes decides whether it is broadcast
    joined = parted.join(stage(carries, "carries"), [*same, F.col(SEGMENT) == F.col("__seg")], "left")

    group = Window.partitionBy(*map(col, keys), SEGMENT)
    ordered = group.orderBy(*map(col, order))
    local = joined.select("*", *[c.local(ordered, group).alias(names[n]) for n, c in columns.items()])
    return local.select(
        *map(col, kept),
        *[c.finish(c.merge(F.col(names[n]), F.col(f"{names[n]}_carry"))).alias(n) for n, c in columns.items()],
    )


def dense_index(
    df: DataFrame, order: Sequence[str], name: str, start: int = 0, splits: Splits | None = None
) -> DataFrame:
    """Number all rows ``start``, ``start + 1``, ... in ``order`` (which must not tie)."""
    numbered = ordered_scan(df, (), order, {name: RowNumber()}, splits)
    return numbered.withColumn(name, col(name) + F.lit(start - 1))
