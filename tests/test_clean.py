"""Cleaning: hand-made edge cases."""

import pytest
from pyspark.sql import functions as F

from eventloom.operators import clean, temporal
from eventloom.spec import LogSpec
from eventloom.staging import stage

SPEC = LogSpec(dynamic_categorical=("activity", "who"), static_numeric=("x",))


def log(spark, rows):
    schema = "case_id string, activity string, ts string, seq long, who string, x double"
    return spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("ts"))


ROWS = [
    ("a", "start", "2024-01-01 00:00:00", 0, None, None),
    ("a", "pay", "2024-01-01 00:10:00", 1, "bob", 1.0),
    ("a", "end", "2024-01-01 00:10:00", 2, None, float("nan")),
    ("b", "start", "2024-01-01 00:05:00", 0, "eve", None),
    (None, "pay", "2024-01-01 00:07:00", 0, None, 3.0),
    (None, "start", "2024-01-01 00:06:00", 1, "kim", 2.0),
]


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`case:concept:name` int, `(case) x` int, `case:y` int")
    renamed = clean.rename_columns(df, {"case:concept:name": "Case ID", "absent": "z"})
    assert clean.strip_column_names(renamed, "case:", "(case) ").columns == ["Case ID", "x", "y"]
    with pytest.raises(ValueError, match="absent"):
        clean.require_columns(df, ["absent"])
    with pytest.warns(UserWarning, match="nothing"):
        assert clean.drop_columns(renamed, ["nothing", "case:y"]).columns == ["Case ID", "(case) x"]
    assert clean.numeric_columns(df, ["case:y"], ["(case) x"]) == ["case:concept:name"]


def test_select_keeps_configured_order(spark):
    df = log(spark, ROWS).withColumn("extra", F.lit(1))
    assert clean.select_configured(df, SPEC).columns == ["x", "case_id", "activity", "who", "ts", "seq"]


def test_case_ids(spark):
    df = log(spark, ROWS)
    repaired = clean.repair_case_ids(df, SPEC).groupBy("case_id").count().collect()
    assert {(r[0], r[1]) for r in repaired} == {("a", 3), ("b", 1), ("missing_caseid", 2)}
    assert clean.repair_case_ids(df, SPEC, drop=True).count() == 4


def test_forward_fill_stays_within_cases_and_follows_the_sequence(spark):
    df = clean.nan_to_null(clean.repair_case_ids(log(spark, ROWS), SPEC))
    got = {(r["case_id"], r["seq"]): (r["who"], r["x"]) for r in clean.forward_fill(df, SPEC, ["who", "x", "absent"]).collect()}
    assert got == {
        ("a", 0): (None, None), ("a", 1): ("bob", 1.0), ("a", 2): ("bob", 1.0), ("b", 0): ("eve", None),
        ("missing_caseid", 1): ("kim", 2.0), ("missing_caseid", 0): ("kim", 3.0),
    }


def test_missing_values(spark):
    df = spark.createDataFrame(
        [("Unknown", "7", True, None), (None, "x", None, 2.0), ("ok", None, False, float("nan"))],
        "c string, n string, b boolean, d double",
    )
    out = clean.fill_categories(df, ["c", "b"])
    out = clean.normalize_missing(out, ["c"])
    out = clean.fill_numbers(clean.coerce_numbers(out, ["n"]), ["n", "d"])
    assert [tuple(r) for r in out.collect()] == [
        ("missing", 7.0, "True", 0.0),
        ("missing", 0.0, "missing", 2.0),
        ("ok", 0.0, "False", 0.0),
    ]
    text = clean.boolean_to_text(spark.createDataFrame([("nan",), (None,), ("True",)], "b string"), ["b"])
    assert [r[0] for r in text.collect()] == ["missing", "missing", "True"]
    gone = clean.sentinels_to_null(spark.createDataFrame([("NIL", 1), ("x", 2), (None, 3)], "c string, n int"), ["NIL"])
    assert [tuple(r) for r in gone.collect()] == [(None, 1), ("x", 2), (None, 3)]


def test_rare_values(spark):
    rows = [("big", True)] * 10 + [("small", False)] * 9 + [(None, None)]
    df = spark.createDataFrame(rows, "c string, b boolean")
    frequent = stage(clean.frequent_values(df, ["c", "b"], 10), "frequent", "attribute")
    got = clean.group_rare_values(df, ["c", "b"], frequent).groupBy("c", "b").count().collect()
    assert {tuple(r) for r in got} == {("big", "True", 10), ("other", "other", 10)}


def test_labels_and_cuts(spark):
    df = clean.repair_case_ids(log(spark, ROWS), SPEC)

    def keyed(out, *more):
        return {(r["case_id"], r["seq"], *[r[m] for m in more]) for r in out.collect()}

    assert keyed(clean.label_cases(df, SPEC, "pay"), "label") == {
        ("a", 0, "deviant"), ("a", 1, "deviant"), ("a", 2, "deviant"), ("b", 0, "regular"),
        ("missing_caseid", 0, "deviant"), ("missing_caseid", 1, "deviant"),
    }
    assert keyed(clean.label_cases(df, SPEC, "pay", cut=True)) == {("a", 0), ("b", 0), ("missing_caseid", 1)}
    assert keyed(clean.cut_at_terminal(df, SPEC, ["pay"])) == {
        ("a", 0), ("a", 1), ("b", 0), ("missing_caseid", 1), ("missing_caseid", 0),
    }
    assert clean.cut_at_terminal(df, SPEC, []) is df
    assert keyed(clean.keep_complete_cases(df, SPEC, ["end"])) == {("a", 0), ("a", 1), ("a", 2)}


def test_open_cases_at_borders(spark):
    df = clean.repair_case_ids(log(spark, ROWS), SPEC)
    got = {(r["case_id"], r["seq"]): r["open_cases"] for r in temporal.with_open_cases(df, SPEC).collect()}
    # b has one event and is never open; a case is closed at its last event
    assert got == {
        ("a", 0): 1, ("a", 1): 0, ("a", 2): 0, ("b", 0): 1, ("missing_caseid", 1): 2, ("missing_caseid", 0): 1,
    }


def test_invalid_timestamps(spark):
    df = spark.createDataFrame([("a", "x", "2024-01-01", 0), ("a", "x", "bad", 1)], "case_id string, activity string, ts string, seq long")
    assert clean.parse_timestamps(df, SPEC).count() == 1
    assert clean.parse_timestamps(df, SPEC, drop=False).count() == 2
