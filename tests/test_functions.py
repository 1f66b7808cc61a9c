"""Column expressions against plain Python."""

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.bins import fixed_bins
from eventloom.functions.missing import to_boolean
from eventloom.functions.names import category_label, sanitize_name
from eventloom.functions.time import calendar, parse_timestamp


def values(spark, rows, schema, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {schema}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


def python_name(text):
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1-\2", text.strip())
    text = re.sub(r"[^0-9a-zA-Z]+", "-", text).strip("-").lower()
    if not text:
        return "na"
    return text if text[0].isalpha() else "v-" + text


NAMES = ["vehicleClass", "?", "3.0", "Appeal to Judge", "A_SUBMITTED", "org:resource", "  CRPHigh2Low ", "été", "--", "aB9C", "Permit ID", ""]


def test_sanitize_name(spark):
    assert values(spark, NAMES, "string", sanitize_name) == [python_name(n) for n in NAMES]


FLOATS = [3.0, -2.0, 0.0, 157.0, 0.5, 1.234567, 123456.7, 1234567.5, 0.00001234, 0.0001234, 14444.15, 99999.95, 999999.5, 1e22, 2.5e-7, 0.1 + 0.2, -0.00015]


def test_category_label_of_floats(spark):
    got = values(spark, FLOATS, "double", lambda c: category_label(c, T.DoubleType()))
    assert got == [str(int(f)) if f.is_integer() else f"{f:g}" for f in FLOATS]


def test_category_label_of_other_types(spark):
    assert values(spark, [7, -1], "long", lambda c: category_label(c, T.LongType())) == ["7", "-1"]
    assert values(spark, [True, False], "boolean", lambda c: category_label(c, T.BooleanType())) == ["True", "False"]


def test_booleans(spark):
    texts = ["True", " yes ", "1", "si", "Y", "no", "0", "", None, "2"]
    assert values(spark, texts, "string", lambda c: to_boolean(c, T.StringType())) == [True] * 5 + [False] * 5
    numbers = [1.0, 0.0, -3.5, None, math.nan]
    assert values(spark, numbers, "double", lambda c: to_boolean(c, T.DoubleType())) == [True, False, True, False, False]


def test_fixed_bins_sides(spark):
    rows = [-1.0, 20.0, 20.5, 50.0, 51.0, None, math.nan]
    right = values(spark, rows, "double", lambda c: fixed_bins(c, (20, 50), ("l", "m", "h")))
    assert right == ["l", "l", "m", "m", "h", None, None]
    left = values(spark, rows, "double", lambda c: fixed_bins(c, (20, 50), ("l", "m", "h"), right=False))
    assert left == ["l", "m", "m", "h", "h", None, None]
    with pytest.raises(ValueError):
        fixed_bins(F.lit(1), (1,), ("a",))


def test_timestamps(spark):
    rows = ["2020-01-02 03:04:05", "2020-01-02T03:04:05.250+02:00", "02.01.2020 03:04", "junk", None]
    got = values(spark, rows, "string", lambda c: F.unix_millis(parse_timestamp(c, ("dd.MM.yyyy HH:mm",))))
    base = 1577934245000
    assert got == [base, base - 2 * 3600 * 1000 + 250, base - 5000, None, None]


def test_calendar(spark):
    moment = dt.datetime(2024, 2, 25, 13, 45)  # a Sunday
    df = spark.sql("SELECT timestamp'2024-02-25 13:45:30' AS x")
    row = df.select(*[c.alias(n) for n, c in calendar(F.col("x")).items()]).first()
    assert tuple(row) == (13 * 60 + 45, 2, moment.weekday(), 13)
