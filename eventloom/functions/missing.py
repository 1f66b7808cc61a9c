"""Expressions for missing, textual and boolean-like values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings that stand for a missing category
MISSING_SPELLINGS = ("UNKNOWN", "Unknown", "unknown", "MISSING", "Missing", "missing", "NaN", "nan")

# Texts that count as true
TRUE_TEXTS = ("true", "1", "yes", "si", "y")

# Cell texts that a delimited file reader takes for null
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def normalize_spelling(value: Column, missing: str = "missing") -> Column:
    return F.when(value.isin(*MISSING_SPELLINGS), missing).otherwise(value)


def null_if_in(value: Column, texts: Sequence[str]) -> Column:
    return F.when(~F.coalesce(value.isin(*texts), F.lit(False)), value)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def to_number(value: Column) -> Column:
    """Number, or null where the text is none."""
    return value.try_cast("double")


def to_boolean(value: Column, data_type: T.DataType) -> Column:
    """True for true, numbers other than 0, and the texts of TRUE_TEXTS; never null."""
    if isinstance(data_type, T.BooleanType):
        flag = value
    elif isinstance(data_type, T.NumericType):
        # a NaN is missing, hence false
        flag = (value != 0) & ~F.isnan(value.cast("double"))
    else:
        flag = F.lower(F.trim(value.cast("string"))).isin(*TRUE_TEXTS)
    return F.coalesce(flag, F.lit(False))


def text_of(value: Column, data_type: T.DataType) -> Column:
    """A category as text; booleans are ``True`` and ``False``."""
    text = value.cast("string")
    return F.initcap(text) if isinstance(data_type, T.BooleanType) else text


def boolean_text(value: Column, data_type: T.DataType, missing: str = "missing") -> Column:
    """``True``/``False`` as text; missing values get their own text."""
    text = text_of(value, data_type)
    return F.coalesce(F.when(~text.isin("nan", "NaN"), text), F.lit(missing))
