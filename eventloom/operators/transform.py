"""Feature transforms: scaling, category codes, quantile bins, clusters."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.clean import category_text, drop_columns, nan_to_null, numeric_columns, sentinels_to_null
from eventloom.operators.scan import RowNumber, RunningSum, ordered_scan
from eventloom.spec import col
from eventloom.staging import stage

# --- scaling -------------------------------------------------------------------


@dataclass(frozen=True)
class Standardizer:
    """Mean and population standard deviation per column (0 counts as 1)."""

    moments: Mapping[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, names: Sequence[str], weight: str | None = None) -> Standardizer:
        """``weight`` counts how many rows a row stands for; nulls take no part in a column's moments."""
        if not names:
            return cls({})
        if weight is None:
            aggregates = []
            for i, n in enumerate(names):
                aggregates += [F.avg(col(n)).alias(f"m{i}"), F.stddev_pop(col(n)).alias(f"s{i}")]
            row = df.agg(*aggregates).first()
            return cls({n: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, n in enumerate(names)})

        def mean(x: Column, name: str) -> Column:
            w = F.when(col(name).isNotNull(), col(weight).cast("double"))
            return F.sum(w * x) / F.sum(w)

        # the deviations are taken from the mean, in a second pass, so that nothing cancels
        means = df.agg(*[mean(col(n), n).alias(f"m{i}") for i, n in enumerate(names)]).first()
        centers = [means[f"m{i}"] or 0.0 for i in range(len(names))]
        squares = [mean((col(n) - F.lit(c)) ** 2, n).alias(f"s{i}") for i, (n, c) in enumerate(zip(names, centers))]
        row = df.agg(*squares).first()
        return cls({n: (c, math.sqrt(row[f"s{i}"] or 0.0) or 1.0) for i, (n, c) in enumerate(zip(names, centers))})

    def scaled(self, name: str) -> Column:
        mean, deviation = self.moments[name]
        return (col(name) - F.lit(mean)) / F.lit(deviation)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({n: self.scaled(n) for n in self.moments})

    def invert(self, df: DataFrame) -> DataFrame:
        return df.withColumns({n: col(n) * F.lit(d) + F.lit(m) for n, (m, d) in self.moments.items()})


# --- categories ------------------------------------------------------------------


def category_codes(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """(attribute, value, code): codes 0, 1, ... in the sorted order of the values.

    Nulls get no code. Works for any number of distinct values.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("attribute"), category_text(df, n).alias("value")) for n in names])
    values = stage(df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct(), "category-values")
    coded = ordered_scan(values, ["attribute"], ["value"], {"code": RowNumber()})
    return coded.withColumn("code", F.col("code") - 1)


def label_encode(df: DataFrame, name: str, codes: DataFrame, output: str) -> DataFrame:
    """Add the code of ``name`` (see :func:`category_codes`)."""
    mine = codes.where(F.col("attribute") == name).select(
        F.col("value").alias("__value"), F.col("code").alias(output)
    )
    return df.join(mine, category_text(df, name) == F.col("__value"), "left").drop("__value")


def category_levels(codes: DataFrame, names: Iterable[str], most: int = 10_000) -> dict[str, list[str]]:
    """Sorted values of each of ``names`` (an empty list if it has none).

    They become columns or vector places, so they are collected. An attribute
    with more than ``most`` values is an error that names it: use
    :func:`sparse_one_hot`, codes or hashed indicators for it.
    """
    names = list(names)
    counts = codes.where(F.col("attribute").isin(names)).groupBy("attribute").agg(F.count(F.lit(1)).alias("n"))
    wide = {r["attribute"]: r["n"] for r in counts.where(F.col("n") > most).collect()}
    if wide:
        raise ValueError(f"too many values for indicators: {wide}, at most {most}; choose another encoding for these columns")
    rows = codes.where(F.col("attribute").isin(names)).orderBy("attribute", "code").collect()
    levels: dict[str, list[str]] = {n: [] for n in names}
    for row in rows:
        levels[row["attribute"]].append(row["value"])
    return levels


def sparse_one_hot(df: DataFrame, id_columns: Sequence[str], names: Iterable[str]) -> DataFrame:
    """The ones of a one-hot encoding: (id columns, attribute, value), for any number of values.

    A null has no row; all other indicators of a row are 0.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("attribute"), category_text(df, n).alias("value")) for n in names])
    return df.select(*map(col, id_columns), F.inline(pairs)).where(F.col("value").isNotNull())


def one_hot_columns(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """A 0/1 column ``{column}_{value}`` per value."""
    flags = {
        f"{name}_{value}": F.coalesce((category_text(df, name) == value).cast("double"), F.lit(0.0))
        for name, values in levels.items()
        for value in values
    }
    return df.select("*", *[c.alias(n) for n, c in flags.items()])


def from_one_hot(df: DataFrame, name: str, values: Sequence[str]) -> Column:
    """The value whose 0/1 column is largest; the first one on ties."""
    pairs = [F.struct(col(f"{name}_{v}").alias("x"), F.lit(-i).alias("i"), F.lit(v).alias("v")) for i, v in enumerate(values)]
    return F.greatest(*pairs)["v"] if len(pairs) > 1 else pairs[0]["v"]


# --- quantile bins -----------------------------------------------------------------

# Labels of three bins
THREE = ("low", "medium", "high")


def quantile_levels(bins: int) -> list[float]:
    """Evenly spaced levels, evaluated the way percent-based quantile code does.

    The rounding matters for a value that lies exactly on a cut.
    """
    return [(i * (1.0 / bins) if i < bins else 1.0) * 100.0 / 100.0 for i in range(bins + 1)]


def number_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(attribute, value, n) of numeric columns; missing values are not counted."""
    pairs = F.array(*[F.struct(F.lit(n).alias("attribute"), col(n).cast("double").alias("value")) for n in names])
    known = F.col("value").isNotNull() & ~F.isnan("value")
    return df.select(F.inline(pairs)).where(known).groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("n"))


def quantiles(df: DataFrame, names: Sequence[str], levels: Sequence[float]) -> DataFrame:
    """(attribute, distinct_values, edges): exact quantiles, linear between ranks.

    The values are counted first; ranks are running sums over the counts, so
    that no task needs all values of a column.
    """
    counts = stage(number_counts(df, names), "number-counts")
    ranked = ordered_scan(counts, ["attribute"], ["value"], {"before": RunningSum(F.col("n"), before=True)})
    totals = counts.groupBy("attribute").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct_values"))
    rows = ranked.join(F.broadcast(totals), "attribute")  # one row per column of the table
    found = []
    for i, level in enumerate(levels):
        at = F.lit(level) * (F.col("total") - 1)
        for side, rank in (("lower", F.floor(at)), ("upper", F.ceil(at))):
            here = (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
            found.append(F.max(F.when(here, F.col("value"))).alias(f"{side}{i}"))
    picked = rows.groupBy("attribute", "total", "distinct_values").agg(*found)
    edges = []
    for i, level in enumerate(levels):
        at = F.lit(level) * (F.col("total") - 1)
        weight = at - F.floor(at)
        lower, upper = F.col(f"lower{i}"), F.col(f"upper{i}")
        edges.append(F.when(weight >= 0.5, upper - (upper - lower) * (1 - weight)).otherwise(lower + (upper - lower) * weight))
    return picked.select("attribute", "distinct_values", F.array(*edges).alias("edges"))


def interval_labels(edges: Sequence[float]) -> list[str]:
    """``(a, b]`` texts of the bins between ``edges``, which ascend.

    Edges are shown with the fewest decimals, at least three, that keep them
    apart. The first one is shown one unit of the last decimal lower, as the
    lowest value belongs to the first bin.
    """
    decimals = 3
    while decimals < 17 and len({round(e, decimals) for e in edges}) < len(edges):
        decimals += 1
    shown = [round(edges[0] - 10.0**-decimals, decimals), *(round(e, decimals) for e in edges[1:])]
    return [f"({low}, {high}]" for low, high in zip(shown, shown[1:])]


@dataclass(frozen=True)
class Discretizer:
    """Bin edges per column; columns without bins become text categories."""

    bins: Mapping[str, tuple[tuple[float, ...], tuple[str, ...]]]
    as_text: tuple[str, ...]

    @classmethod
    def fit(cls, df: DataFrame, names: Sequence[str], bins: int = 3, labels: Sequence[str] | None = None) -> Discretizer:
        """Quantile bins. A column with fewer distinct values or fewer distinct edges stays text."""
        labels = labels or (THREE if bins == 3 else None)
        names = list(names)
        if not names:
            return cls({}, ())
        fitted, text = {}, []
        rows = {r["attribute"]: r for r in quantiles(df, names, quantile_levels(bins)).collect()}
        for name in names:
            row = rows.get(name)
            edges = list(dict.fromkeys(row["edges"])) if row else []
            if row is None or row["distinct_values"] < bins or len(edges) - 1 < bins:
                text.append(name)
            else:
                fitted[name] = (tuple(edges), tuple(labels or interval_labels(edges)))
        return cls(fitted, tuple(text))

    def binned(self, name: str) -> Column:
        edges, labels = self.bins[name]
        value = col(name).cast("double")
        result = F.when(value.isNull() | F.isnan(value) | (value < edges[0]) | (value > edges[-1]), None)
        for upper, label in zip(edges[1:], labels):
            result = result.when(value <= upper, label)
        return result

    def apply(self, df: DataFrame) -> DataFrame:
        changed = {n: self.binned(n) for n in self.bins}
        changed |= {n: col(n).cast("string") for n in self.as_text}
        return df.select(*[changed[n].alias(n) if n in changed else col(n) for n in df.columns])


def discretize_table(
    df: DataFrame,
    drop: Iterable[str] = (),
    sentinels: Sequence[str] = (),
    categorical: Iterable[str] = (),
    exclude: Iterable[str] = (),
    bins: int = 3,
) -> DataFrame:
    """Drop columns, turn sentinels into nulls, bin the numeric columns by quantiles.

    ``categorical`` columns become text; ``exclude`` columns stay as they are.
    """
    df = nan_to_null(sentinels_to_null(drop_columns(df, drop), sentinels))
    categorical = list(categorical)
    texts = {n: col(n).cast("string") for n in categorical if n in df.columns}
    numbers = numeric_columns(df, categorical, exclude)
    df = df.select(*[texts[n].alias(n) if n in texts else col(n) for n in df.columns])
    return Discretizer.fit(df, numbers, bins).apply(df)


# --- clusters ------------------------------------------------------------------------


#: How a category may enter a vector.
ENCODINGS = ("indicator", "code", "hashed")
#: Places of hashed indicators.
HASHED = 256


def feature_vectors(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    output: str = "features",
    encoding: Mapping[str, str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One vector per row: scaled numbers, then the categories.

    ``encoding`` gives the role of a category: ``indicator`` (one place per
    value, the default, an error beyond 10,000 values), ``code`` (its place in
    the sorted values) or ``hashed`` (256 places by hash). It never depends on
    the data. ``weight`` counts how many rows a row stands for in the scaling.
    """
    encoding = dict(encoding or {})
    unknown = set(encoding.values()) - set(ENCODINGS)
    if unknown:
        raise ValueError(f"unknown encodings {sorted(unknown)}, use {ENCODINGS}")
    scaler = Standardizer.fit(df, list(numeric), weight)
    parts = [F.array(*[F.coalesce(scaler.scaled(n), F.lit(0.0)) for n in numeric])] if numeric else []
    role = {n: encoding.get(n, "indicator") for n in categorical}
    counted = [n for n in categorical if role[n] != "hashed"]
    codes = stage(category_codes(df, counted), "category-codes", "attribute") if counted else None
    levels = category_levels(codes, [n for n in counted if role[n] == "indicator"]) if counted else {}
    for i, name in enumerate(categorical):
        if role[name] == "indicator":
            parts.append(_indicators(category_text(df, name), levels[name]))
        elif role[name] == "hashed":
            place = F.pmod(F.xxhash64(category_text(df, name)), F.lit(HASHED)).cast("string")
            parts.append(_indicators(F.when(category_text(df, name).isNotNull(), place), [str(p) for p in range(HASHED)]))
        else:
            df = label_encode(df, name, codes, f"__code_{i}")
            parts.append(F.array(F.coalesce(F.col(f"__code_{i}").cast("double"), F.lit(-1.0))))
    vector = array_to_vector(F.concat(*parts)).alias(output)
    return df.select(*[col(n) for n in df.columns if not n.startswith("__code_")], vector)


def _indicators(text: Column, values: Sequence[str]) -> Column:
    """0/1 per value, as an array; a null matches none."""
    if not values:
        return F.array().cast("array<double>")
    return F.transform(F.lit(list(values)), lambda v: F.coalesce((v == text).cast("double"), F.lit(0.0)))


def fit_clusters(vectors: DataFrame, k: int, seed: int = 0, weight: str | None = None) -> KMeansModel:
    """k-means over ``features``; ``weight`` counts how many rows a row stands for."""
    estimator = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster")
    if weight:
        estimator = estimator.setWeightCol(weight)
    return estimator.fit(vectors)
