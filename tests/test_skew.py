"""Results do not change when every group is cut into segments."""

import pytest

from test_oracles import compare, duck  # noqa: F401

SCANS = [
    "forward_fill",
    "complete_cases",
    "cut_prefix",
    "cut_at_terminal",
    "time_features",
    "event_case_duration",
    "open_cases",
    "label_encode",
    "quantile_edges",
    "discretize_states",
    "mdp_events",
    "next_state",
    "state_index",
    "transitions_unabstracted",
    "abstraction_map",
    "stick_breaking",
    "uniquify",
    "bool_fluents",
]


@pytest.mark.parametrize("name", SCANS)
def test_segmented_query_equals_sql(spark, duck, split_everything, name):  # noqa: F811
    compare(spark, duck, name)


def test_one_case_with_most_rows(spark, tmp_path):
    """A log whose hottest case holds half of all events, cut into many segments."""
    from pyspark.sql import functions as F

    from eventloom.operators import temporal
    from eventloom.operators.scan import SplitPolicy, find_splits
    from eventloom.spec import LogSpec

    spec = LogSpec()
    rows = spark.range(4000).select(
        F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("case_id"),
        F.lit("a").alias("activity"),
        # long runs of equal timestamps
        F.timestamp_seconds(F.floor(F.col("id") / 300) * 60).alias("ts"),
        F.col("id").alias("seq"),
    )
    rows.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    splits = find_splits(log, ["case_id"], ["ts", "seq"], SplitPolicy(100, 4))
    assert [(r["case_id"], len(r["__cuts"]) >= 10) for r in splits.cuts.collect()] == [("hot", True)]
    got = temporal.with_time_features(log, spec, splits)
    plain = temporal.with_time_features(log, spec)
    assert got.exceptAll(plain).count() == 0
    assert plain.exceptAll(got).count() == 0
    assert got.where("case_id = 'hot'").agg(F.max("event_nr")).first()[0] == 2000
    # the rows of the hot case do not share a window partition
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(case_id" in plan and "__segment" in plan
