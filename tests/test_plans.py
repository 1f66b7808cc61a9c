"""Shapes of physical plans."""

from pyspark.sql import functions as F

from eventloom.operators import clean, temporal
from eventloom.operators.scan import dense_index, unsplit
from eventloom.plans.discovery import discover
from eventloom.plans.preprocess import preprocess
from eventloom.spec import LogSpec


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written_log(spark, path):
    rows = spark.range(50).select(
        F.concat(F.lit("c"), F.col("id") % 7).alias("case_id"),
        F.concat(F.lit("a"), F.col("id") % 3).alias("activity"),
        F.timestamp_seconds(F.col("id")).alias("ts"),
        F.col("id").alias("seq"),
        F.col("id").cast("double").alias("x"),
        F.lit("never used").alias("wide"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_case_filter_features_and_fill_share_one_exchange(spark, tmp_path):
    spec = LogSpec()
    log = written_log(spark, str(tmp_path / "log"))
    splits = unsplit(["case_id"], ["ts", "seq"])
    out = clean.keep_complete_cases(log, spec, ["a1"], splits)
    out = temporal.with_time_features(out, spec, splits)
    out = clean.forward_fill(out, spec, ["x"], splits)
    out = temporal.with_case_duration(out, spec, splits)
    text = plan_of(out.select("case_id", "event_nr", "x", "execution_time_minutes"))
    assert text.count("Exchange hashpartitioning") == 1
    assert "wide" not in text.split("ReadSchema")[1]


def test_durations_aggregate_before_the_exchange(spark, tmp_path):
    log = written_log(spark, str(tmp_path / "log"))
    text = plan_of(temporal.case_durations(log, LogSpec()))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_min" in text


def test_open_cases_compare_no_pairs(spark, tmp_path):
    log = written_log(spark, str(tmp_path / "log"))
    text = plan_of(temporal.with_open_cases(log, LogSpec()))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_preprocess_runs_without_python_evaluation(spark, tmp_path):
    spec = LogSpec(dynamic_categorical=("activity",), dynamic_numeric=("x",), complete_with=("a1",), with_open_cases=True)
    out = preprocess(written_log(spark, str(tmp_path / "log")), spec)
    text = plan_of(out)
    assert "Python" not in text and "NestedLoop" not in text
    assert out.count() == written_log(spark, str(tmp_path / "again")).where("activity IN ('a0', 'a1', 'a2')").count()


def test_split_scans_compare_no_pairs(spark, tmp_path, split_everything):
    log = written_log(spark, str(tmp_path / "log"))
    opened = temporal.with_open_cases(log, LogSpec())
    numbered = dense_index(log, ["seq"], "number")
    for out in (opened, numbered):
        text = plan_of(out)
        assert "NestedLoop" not in text and "Cartesian" not in text
    assert [r["number"] for r in numbered.orderBy("seq").collect()] == list(range(50))


def test_descriptions_are_counted_before_the_join(spark, tmp_path):
    log = written_log(spark, str(tmp_path / "log"))
    model = discover(log, LogSpec(dynamic_categorical=("activity",), dynamic_numeric=("x",)), ["activity"])
    text = plan_of(model.describe(["activity"], ["x"]))
    scan = text.rindex("Join")
    # in the printed plan what runs first stands below the join
    assert "partial_count" in text[scan:]
    assert "wide" not in model.steps.columns


def test_rare_values_of_short_columns_are_not_joined(spark, tmp_path):
    log = written_log(spark, str(tmp_path / "log"))
    frequent = clean.frequent_values(log, ["activity", "case_id"], 8)
    grouped = clean.group_rare_values(log, ["activity", "case_id"], frequent)
    assert "Join" not in plan_of(grouped)
