"""Cleaning of event tables."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions import missing as m
from eventloom.functions.time import parse_timestamp
from eventloom.operators.scan import FillForward, GroupMax, GroupMin, Splits, ordered_scan
from eventloom.spec import LogSpec, col


def _present(df: DataFrame, names: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in dict.fromkeys(names) if n in have]


def _replace(df: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    return df.select(*[changes[n].alias(n) if n in changes else col(n) for n in df.columns])


# --- schema -------------------------------------------------------------------


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename what is present; other names of ``mapping`` are ignored."""
    return df.toDF(*[mapping.get(n, n) for n in df.columns])


def strip_column_names(df: DataFrame, prefix: str | None = None, text: str | None = None) -> DataFrame:
    names = [n.removeprefix(prefix) if prefix else n for n in df.columns]
    return df.toDF(*[n.replace(text, "") if text else n for n in names])


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    return df


def select_configured(df: DataFrame, spec: LogSpec, extra: Iterable[str] = ()) -> DataFrame:
    """The configured columns that are present, each once, in the configured order."""
    return df.select(*map(col, _present(df, (*spec.configured, *extra))))


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    names = list(names)
    for name in names:
        if name not in df.columns:
            warnings.warn(f"column {name!r} to drop is not in the table", stacklevel=2)
    return df.select(*[col(n) for n in df.columns if n not in names])


def numeric_columns(df: DataFrame, categorical: Iterable[str] = (), exclude: Iterable[str] = ()) -> list[str]:
    """Columns of a numeric type, without those that are categories or excluded."""
    skip = {*categorical, *exclude}
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


# --- values -------------------------------------------------------------------


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return _replace(df, {n: m.nan_to_null(col(n)) for n in floats})


def repair_case_ids(df: DataFrame, spec: LogSpec, drop: bool = False) -> DataFrame:
    """Give events without a case one common case id, or drop them."""
    if drop:
        df = df.where(col(spec.case).isNotNull())
    return _replace(df, {spec.case: F.coalesce(col(spec.case).cast("string"), F.lit(spec.missing_case))})


def parse_timestamps(df: DataFrame, spec: LogSpec, drop: bool = True) -> DataFrame:
    """Parse the timestamp column if it is text; with ``drop``, only events with a valid one."""
    ts = col(spec.timestamp)
    if isinstance(df.schema[spec.timestamp].dataType, T.StringType):
        ts = parse_timestamp(ts, spec.timestamp_formats)
    parsed = _replace(df, {spec.timestamp: ts})
    return parsed.where(col(spec.timestamp).isNotNull()) if drop else parsed


def sentinels_to_null(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """Null where a text column holds one of ``texts``."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return _replace(df, {n: m.null_if_in(col(n), texts) for n in strings}) if texts else df


def category_text(df: DataFrame, name: str) -> Column:
    return m.text_of(col(name), df.schema[name].dataType)


def fill_categories(df: DataFrame, names: Iterable[str], missing: str = "missing") -> DataFrame:
    """Categories as text, nulls filled."""
    return _replace(df, {n: F.coalesce(category_text(df, n), F.lit(missing)) for n in _present(df, names)})


def normalize_missing(df: DataFrame, names: Iterable[str], missing: str = "missing") -> DataFrame:
    return _replace(df, {n: m.normalize_spelling(col(n), missing) for n in _present(df, names)})


def coerce_numbers(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return _replace(df, {n: m.to_number(col(n)) for n in _present(df, names)})


def fill_numbers(df: DataFrame, names: Iterable[str], value: float = 0.0) -> DataFrame:
    def filled(name: str) -> Column:
        kind = df.schema[name].dataType
        known = m.nan_to_null(col(name)) if isinstance(kind, (T.DoubleType, T.FloatType)) else col(name)
        return F.coalesce(known, F.lit(value).cast(kind))

    return _replace(df, {n: filled(n) for n in _present(df, names)})


def boolean_to_text(df: DataFrame, names: Iterable[str], missing: str = "missing") -> DataFrame:
    types = {f.name: f.dataType for f in df.schema}
    return _replace(df, {n: m.boolean_text(col(n), types[n], missing) for n in _present(df, names)})


def coerce_booleans(df: DataFrame, names: Iterable[str]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema}
    return _replace(df, {n: m.to_boolean(col(n), types[n]) for n in _present(df, names)})


# --- within cases ---------------------------------------------------------------


def forward_fill(df: DataFrame, spec: LogSpec, names: Iterable[str], splits: Splits | None = None) -> DataFrame:
    """Fill nulls with the last known value of the same case; one scan for all columns."""
    names = _present(df, names)
    filled = ordered_scan(
        df, [spec.case], spec.order, {f"__filled_{i}": FillForward(col(n)) for i, n in enumerate(names)}, splits
    )
    changes = {n: col(f"__filled_{i}") for i, n in enumerate(names)}
    return filled.select(*[changes.get(n, col(n)).alias(n) for n in df.columns])


def keep_complete_cases(
    df: DataFrame, spec: LogSpec, activities: Sequence[str], splits: Splits | None = None
) -> DataFrame:
    """Only cases in which one of ``activities`` occurs."""
    return flag_complete_cases(df, spec, activities, "__complete", splits).where("__complete").drop("__complete")


def flag_complete_cases(
    df: DataFrame, spec: LogSpec, activities: Sequence[str], output: str, splits: Splits | None = None
) -> DataFrame:
    """Each event with a flag: whether one of ``activities`` occurs in its case."""
    hit = F.coalesce(col(spec.activity).isin(*activities), F.lit(False))
    return ordered_scan(df, [spec.case], spec.order, {output: GroupMax(hit)}, splits)


def _first_at(spec: LogSpec, activities: Sequence[str]) -> GroupMin:
    return GroupMin(F.when(col(spec.activity).isin(*activities), F.struct(*map(col, spec.order))))


def label_cases(
    df: DataFrame,
    spec: LogSpec,
    activity: str,
    cut: bool = False,
    label: str = "label",
    found: str = "deviant",
    absent: str = "regular",
    splits: Splits | None = None,
) -> DataFrame:
    """Label each event by whether ``activity`` occurs in its case.

    With ``cut`` only the events before the first occurrence are kept.
    """
    scanned = ordered_scan(df, [spec.case], spec.order, {"__first": _first_at(spec, [activity])}, splits)
    labelled = scanned.withColumn(label, F.when(F.col("__first").isNull(), absent).otherwise(found))
    if cut:
        position = F.struct(*map(col, spec.order))
        labelled = labelled.where(F.col("__first").isNull() | (position < F.col("__first")))
    return labelled.drop("__first")


def cut_at_terminal(
    df: DataFrame, spec: LogSpec, activities: Sequence[str], splits: Splits | None = None
) -> DataFrame:
    """Events up to and including the first of the terminal ``activities``."""
    if not activities:
        return df
    scanned = ordered_scan(df, [spec.case], spec.order, {"__first": _first_at(spec, activities)}, splits)
    position = F.struct(*map(col, spec.order))
    return scanned.where(F.col("__first").isNull() | (position <= F.col("__first"))).drop("__first")


#: Frequent values of a column that are written into the plan; more are joined.
LISTED_VALUES = 500

# --- rare values ----------------------------------------------------------------


def value_counts(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """(attribute, value, n) of all ``names`` in one aggregation; nulls are not counted."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias("attribute"), category_text(df, n).alias("value")) for n in _present(df, names)]
    )
    return (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("attribute", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def frequent_values(df: DataFrame, names: Iterable[str], threshold: int) -> DataFrame:
    """(attribute, value) that occur in at least ``threshold`` events."""
    return value_counts(df, names).where(F.col("n") >= threshold).select("attribute", "value")


def group_rare_values(
    df: DataFrame, names: Iterable[str], frequent: DataFrame, other: str = "other"
) -> DataFrame:
    """Replace values that are not in ``frequent`` (see :func:`frequent_values`).

    Hand in a staged table. Columns with few frequent values are compared with
    these, all in one projection; only the others are joined, and the table's
    file size decides whether it is broadcast. The result is the same.
    """
    names = _present(df, names)
    order = df.columns
    sizes = {r["attribute"]: r["n"] for r in frequent.groupBy("attribute").agg(F.count(F.lit(1)).alias("n")).collect()}
    short = [n for n in names if sizes.get(n, 0) <= LISTED_VALUES]
    listed: dict[str, list[str]] = {n: [] for n in short}
    for r in frequent.where(F.col("attribute").isin(short)).collect() if short else []:
        listed[r["attribute"]].append(r["value"])
    changes = {}
    for i, name in enumerate(names):
        text = category_text(df, name)
        if name in listed:
            changes[name] = F.when(text.isin(*listed[name]), text).otherwise(F.lit(other)) if listed[name] else F.lit(other)
            continue
        mine = frequent.where(F.col("attribute") == name).select(F.col("value").alias(f"__value_{i}"))
        df = df.join(mine, text == F.col(f"__value_{i}"), "left")
        changes[name] = F.coalesce(F.col(f"__value_{i}"), F.lit(other))
    return df.select(*[changes.get(n, col(n)).alias(n) for n in order])
