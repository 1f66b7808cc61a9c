"""Ordered scans: the segmented form against brute force and the plain form."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators.scan import (
    FillForward,
    Following,
    GroupMax,
    GroupMin,
    GroupSum,
    Previous,
    RowNumber,
    RunningSum,
    SplitPolicy,
    dense_index,
    find_splits,
    ordered_scan,
)

def columns():
    return {
        "rn": RowNumber(),
        "upto": RunningSum(F.col("v")),
        "before": RunningSum(F.col("v"), before=True),
        "prev": Previous(F.col("v")),
        "next": Following(F.col("v")),
        "filled": FillForward(F.col("v")),
        "low": GroupMin(F.col("v")),
        "high": GroupMax(F.col("v")),
        "total": GroupSum(F.col("v")),
    }


def sample_rows(seed=1):
    rng = random.Random(seed)
    rows = []
    for key, size in (("hot", 60), ("warm", 9), ("one", 1), (None, 12), ("nulls", 7)):
        for i in range(size):
            value = None if key == "nulls" or rng.random() < 0.3 else rng.randint(-5, 9)
            # many equal timestamps: the sequence decides
            rows.append((key, rng.randint(0, 4), len(rows), value))
    rng.shuffle(rows)
    return rows


def brute_force(rows):
    out = []
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        values = [r[3] for r in group]
        known = [v for v in values if v is not None]
        total, last = 0, None
        for i, row in enumerate(group):
            before = total
            total += row[3] or 0
            last = row[3] if row[3] is not None else last
            out.append(
                row
                + (
                    i + 1, total, before,
                    values[i - 1] if i else None,
                    values[i + 1] if i + 1 < len(values) else None,
                    last,
                    min(known) if known else None, max(known) if known else None, sum(known),
                )
            )
    return sorted(out, key=lambda r: r[2])


@pytest.mark.parametrize("per_segment", [1, 2, 5, 1000])
def test_scan_equals_brute_force(spark, per_segment):
    rows = sample_rows()
    df = spark.createDataFrame(rows, "k string, t int, s int, v int")
    splits = find_splits(df, ["k"], ["t", "s"], SplitPolicy(per_segment, 1, 10_000))
    assert (splits.cuts is None) == (per_segment == 1000)
    got = [tuple(r) for r in ordered_scan(df, ["k"], ["t", "s"], columns(), splits).orderBy("s").collect()]
    assert got == brute_force(rows)


def test_cuts_are_bounded_and_rows_stay_whole(spark):
    rows = sample_rows(2)
    df = spark.createDataFrame(rows, "k string, t int, s int, v int")
    splits = find_splits(df, ["k"], ["t", "s"], SplitPolicy(1, 1, 6))
    assert splits.longest <= 6
    got = [tuple(r) for r in ordered_scan(df, ["k"], ["t", "s"], columns(), splits).orderBy("s").collect()]
    assert got == brute_force(rows)


def test_cuts_from_another_table_give_the_same_result(spark):
    rows = sample_rows(3)
    df = spark.createDataFrame(rows, "k string, t int, s int, v int")
    splits = find_splits(df.where("t < 2"), ["k"], ["t", "s"], SplitPolicy(3, 1, 1000))
    got = [tuple(r) for r in ordered_scan(df, ["k"], ["t", "s"], columns(), splits).orderBy("s").collect()]
    assert got == brute_force(rows)


def test_dense_index_over_whole_table(spark, split_everything):
    df = spark.range(101).select((F.col("id") * 37 % 101).alias("x"))
    got = dense_index(df, ["x"], "i").orderBy("x").collect()
    assert [(r.x, r.i) for r in got] == [(i, i) for i in range(101)]


def test_unfit_splits_are_refused(spark):
    df = spark.createDataFrame(sample_rows(), "k string, t int, s int, v int")
    splits = find_splits(df, ["k"], ["t"])
    with pytest.raises(ValueError):
        ordered_scan(df, ["k"], ["s"], {"rn": RowNumber()}, splits)


def test_plain_scan_has_one_exchange(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(sample_rows(), "k string, t int, s int, v int").write.parquet(path)
    plan = ordered_scan(spark.read.parquet(path), ["k"], ["t", "s"], columns())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
