"""Transforms against pandas and numpy."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventloom.operators import transform


def columns(seed):
    rng = random.Random(seed)
    n = rng.choice([3, 7, 50, 200])
    return pd.DataFrame(
        {
            "i": range(n),
            "smooth": [rng.gauss(0, 100) for _ in range(n)],
            "ties": [float(rng.choice([1, 2, 2, 3, 5, 8])) for _ in range(n)],
            "gaps": [rng.random() if rng.random() < 0.7 else None for _ in range(n)],
            "constant": [1.5] * n,
            "whole": [rng.randint(0, 40) for _ in range(n)],
        }
    )


@pytest.mark.parametrize("bins", [2, 3, 4, 5])
def test_discretize_equals_qcut(spark, bins):
    for seed in (1, 2, 3):
        table = columns(seed * 10 + bins)
        names = [c for c in table.columns if c != "i"]
        df = spark.createDataFrame(table)
        got = transform.discretize_table(df, exclude=["i"], bins=bins).toPandas().sort_values("i").reset_index(drop=True)
        for name in names:
            labels = list(transform.THREE) if bins == 3 else None
            known = table[name]
            expected = None
            if known.nunique() >= bins:
                cut = pd.qcut(known, bins, labels=False if labels is None else labels, duplicates="drop")
                edges = pd.qcut(known, bins, labels=False, duplicates="drop", retbins=True)[1] if labels is None else None
                if labels is None and len(edges) - 1 == bins:
                    texts = transform.interval_labels(list(edges))
                    expected = [texts[int(c)] if not pd.isna(c) else None for c in cut]
                elif labels is not None:
                    expected = [c if isinstance(c, str) else None for c in cut]
            found = [None if pd.isna(v) else v for v in got[name]]
            if expected is None:
                expected = [None if pd.isna(v) else str(v) for v in known]
            assert found == expected, (seed, bins, name)


def test_three_labels_need_three_bins(spark):
    df = spark.createDataFrame([(i, 1.0 if i < 9 else 2.0 + i) for i in range(12)], "i int, v double")
    got = transform.discretize_table(df, exclude=["i"]).orderBy("i").collect()
    assert [r["v"] for r in got] == ["1.0"] * 9 + ["11.0", "12.0", "13.0"]


def test_quantiles_with_segments(spark, split_everything):
    rng = np.random.default_rng(5)
    data = rng.integers(0, 60, 400).astype(float)
    df = spark.createDataFrame([(float(v),) for v in data], "v double")
    levels = [0.0, 0.1, 1 / 3, 0.5, 0.99, 1.0]
    row = transform.quantiles(df, ["v"], levels).first()
    assert row["edges"] == pytest.approx(list(np.quantile(data, levels)), abs=1e-12)
    assert row["distinct_values"] == len(set(data))


def test_standardizer_round_trip(spark):
    table = columns(4)
    scaler = transform.Standardizer.fit(spark.createDataFrame(table), ["smooth", "constant"])
    assert scaler.moments["smooth"] == pytest.approx((np.mean(table.smooth), np.std(table.smooth)))
    assert scaler.moments["constant"] == (1.5, 1.0)
    scaled = scaler.apply(spark.createDataFrame(table))
    back = scaler.invert(scaled).orderBy("i").toPandas()
    assert np.allclose(back["smooth"], table["smooth"])
    assert np.allclose(scaled.toPandas()["constant"], 0)


def test_codes_and_one_hot(spark):
    df = spark.createDataFrame([(0, "b", True), (1, "a", None), (2, None, False), (3, "b", True)], "i int, c string, f boolean")
    codes = transform.category_codes(df, ["c", "f"])
    assert {tuple(r) for r in codes.collect()} == {("c", "a", 0), ("c", "b", 1), ("f", "False", 0), ("f", "True", 1)}
    levels = transform.category_levels(codes, ["c", "f"], 2)
    assert levels == {"c": ["a", "b"], "f": ["False", "True"]}
    with pytest.raises(ValueError, match="'c': 2"):
        transform.category_levels(codes, ["c"], 1)
    ones = transform.sparse_one_hot(df, ["i"], ["c", "f"])
    assert {tuple(r) for r in ones.collect()} == {(0, "c", "b"), (0, "f", "True"), (1, "c", "a"), (2, "f", "False"), (3, "c", "b"), (3, "f", "True")}
    wide = transform.one_hot_columns(df, levels)
    assert wide.columns == ["i", "c", "f", "c_a", "c_b", "f_False", "f_True"]
    back = wide.select("i", transform.from_one_hot(wide, "c", levels["c"]).alias("c")).orderBy("i").collect()
    assert [r["c"] for r in back] == ["b", "a", "a", "b"]  # nothing set: the first value
    coded = transform.label_encode(df, "c", codes, "code").orderBy("i").collect()
    assert [r["code"] for r in coded] == [1, 0, None, 1]


def test_clusters(spark):
    rows = [(i, float(i % 2 * 100 + i / 100), "x" if i % 2 else "y", 1.0 + i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, n double, c string, w double")
    vectors = transform.feature_vectors(df, ["n"], ["c"])
    assert len(vectors.first()["features"]) == 3
    coded = transform.feature_vectors(df, ["n"], ["c"], encoding={"c": "code"})
    assert {r["features"][1] for r in coded.collect()} == {0.0, 1.0}
    hashed = transform.feature_vectors(df, [], ["c"], encoding={"c": "hashed"})
    assert {(len(r["features"]), sum(r["features"])) for r in hashed.collect()} == {(transform.HASHED, 1.0)}
    with pytest.raises(ValueError, match="ordinal"):
        transform.feature_vectors(df, [], ["c"], encoding={"c": "ordinal"})
    model = transform.fit_clusters(vectors, 2, weight="w")
    got = model.transform(vectors).groupBy("c").agg(F.collect_set("cluster").alias("k")).collect()
    assert sorted(len(r["k"]) for r in got) == [1, 1]
    # every row belongs to the nearest center
    for row in model.transform(vectors).collect():
        away = [float(np.linalg.norm(row["features"].toArray() - c)) for c in model.clusterCenters()]
        assert math.isclose(away[row["cluster"]], min(away))


@pytest.mark.parametrize("n", [100, 101])
def test_wide_categories_keep_their_form(spark, n):
    df = spark.range(n).selectExpr("id as i", "concat('v', id) as c", "cast(id % 3 as double) as x")
    levels = transform.category_levels(transform.category_codes(df, ["c"]), ["c"])
    wide = transform.one_hot_columns(df, levels)
    assert len(wide.columns) == 3 + n
    vectors = transform.feature_vectors(df, ["x"], ["c"])
    assert {len(r["features"]) for r in vectors.collect()} == {1 + n}
    assert transform.sparse_one_hot(df, ["i"], ["c"]).count() == n


def test_weighted_scaling_equals_that_of_the_rows(spark):
    rows = [(0.0, 1000), (1.0, 2), (7.5, 2), (None, 50)]
    states = spark.createDataFrame(rows, "x double, visits long")
    log = states.selectExpr("x", "explode(sequence(1, cast(visits as int))) as i")
    weighted = transform.Standardizer.fit(states, ["x"], "visits").moments["x"]
    assert np.allclose(weighted, transform.Standardizer.fit(log, ["x"]).moments["x"])


def test_interval_labels():
    assert transform.interval_labels([0.0, 1.5, 2.25, 10.0]) == ["(-0.001, 1.5]", "(1.5, 2.25]", "(2.25, 10.0]"]
    assert transform.interval_labels([1.0, 1.0002, 1.0004, 1.0005]) == ["(0.9999, 1.0002]", "(1.0002, 1.0004]", "(1.0004, 1.0005]"]
    assert transform.interval_labels([12.3456, 20.0]) == ["(12.345, 20.0]"]
