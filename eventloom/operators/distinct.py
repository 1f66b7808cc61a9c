"""Which columns have many values: mergeable sketches, and exact counts near a threshold only.

A HyperLogLog sketch per column takes some kilobytes whatever the table's size.
Sketches of parts of a table, or of earlier runs, merge into that of the whole. A
threshold test reads the estimate, which is off by more than :data:`MARGIN` about never; only the columns
whose estimate lies that close to the threshold are counted exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.missing import nan_to_null
from eventloom.spec import col

#: A sketch has 2^SIZE registers
SIZE = 12
#: Five standard errors of an estimate, as a share of it
MARGIN = 5 * 1.04 / 2 ** (SIZE / 2)


def _value(df: DataFrame, name: str) -> Column:
    """A value as text; NaN is missing, and 0.0 and -0.0 are one."""
    kind = df.schema[name].dataType.typeName()
    value = nan_to_null(col(name)) + F.lit(0.0).cast(kind) if kind in ("double", "float") else col(name)
    return value.cast("string")


def distinct_sketches(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(attribute, sketch) of the columns, in one pass; nulls and NaN do not count. Write it to merge it with later ones."""
    sketches = df.agg(*[F.hll_sketch_agg(_value(df, n), SIZE).alias(f"s{i}") for i, n in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(n).alias("attribute"), F.col(f"s{i}").alias("sketch")) for i, n in enumerate(names)])
    return sketches.select(F.inline(pairs))


def merge_sketches(*tables: DataFrame) -> DataFrame:
    """(attribute, sketch) over all parts."""
    every = tables[0]
    for table in tables[1:]:
        every = every.unionByName(table)
    return every.groupBy("attribute").agg(F.hll_union_agg("sketch").alias("sketch"))


def estimates(sketches: DataFrame) -> DataFrame:
    """(attribute, distinct_values), rounded."""
    return sketches.select("attribute", F.hll_sketch_estimate("sketch").alias("distinct_values"))


def many_valued(df: DataFrame, names: Sequence[str], most: int, sketches: DataFrame | None = None) -> dict[str, bool]:
    """Whether each column has more than ``most`` different values; ``sketches`` are those of the table, if there are any already."""
    if not names:
        return {}
    sketches = distinct_sketches(df, names) if sketches is None else sketches
    # one row per column
    found = {r["attribute"]: r["distinct_values"] for r in estimates(sketches).collect()}
    near = [n for n in names if abs(found[n] - most) <= 1 + MARGIN * max(found[n], most)]
    result = {n: found[n] > most for n in names}
    if near:
        exact = df.agg(*[F.count_distinct(_value(df, n)).alias(f"n{i}") for i, n in enumerate(near)]).first()
        result |= {n: exact[f"n{i}"] > most for i, n in enumerate(near)}
    return result
