"""Distinct counts by sketches."""

import pytest
from pyspark.sql import functions as F

from eventloom.operators import distinct, encode


def test_sketches_merge_and_thresholds_are_exact(spark):
    frame = spark.range(4000).select(
        "id", (F.col("id") % 100).alias("hundred"), (F.col("id") % 101).cast("double").alias("more"), F.lit(None).cast("string").alias("nothing"),
        F.when(F.col("id") % 2 == 0, float("nan")).otherwise(F.lit(-0.0)).alias("zero"),
    )
    names = frame.columns
    whole = distinct.distinct_sketches(frame, names)
    halves = [distinct.distinct_sketches(frame.where(F.col("id") % 2 == i), names) for i in (0, 1)]
    merged = distinct.merge_sketches(*halves)
    shown = [{r["attribute"]: r["distinct_values"] for r in distinct.estimates(t).collect()} for t in (whole, merged)]
    assert shown[0] == shown[1]
    assert abs(shown[0]["id"] - 4000) < distinct.MARGIN * 4000 and shown[0]["nothing"] == 0 and shown[0]["zero"] == 1
    counts = {"id": 4000, "hundred": 100, "more": 101, "nothing": 0, "zero": 1}
    for most in (0, 1, 99, 100, 101, 3999, 4000, 4001):
        assert distinct.many_valued(frame, names, most, merged) == {n: c > most for n, c in counts.items()}
    assert distinct.many_valued(frame, [], 3) == {}
    with pytest.raises(ValueError, match="'more' is numeric"):
        encode.classify_columns(frame.select("more", "hundred"), id_col="id", max_numeric_values=100)
