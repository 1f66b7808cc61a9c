"""Fingerprints of state keys: the same states as by the keys, fewer bytes, collisions found."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import mdp
from eventloom.plans.discovery import discover
from eventloom.spec import LogSpec
from eventloom.staging import stage

SPEC = LogSpec(dynamic_categorical=("activity",))
WIDE = 25


@pytest.fixture(scope="module")
def wide_log(spark, tmp_path_factory):
    """A log with 25 long attributes."""
    path = str(tmp_path_factory.mktemp("wide") / "log")
    # texts that do not compress; states come again in all parts of the log
    texts = [F.when(F.col("id") % 97 != i, F.sha2(F.concat_ws("-", F.col("id") % 97, F.lit(i)).cast("binary"), 256)).alias(f"a{i}") for i in range(WIDE)]
    rows = spark.range(6000).select(
        F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(700))).alias("case_id"), F.concat(F.lit("act"), F.col("id") % 3).alias("activity"),
        F.timestamp_seconds("id").alias("ts"), F.col("id").alias("seq"), *texts,
    )
    rows.repartition(6).write.parquet(path)
    return spark.read.parquet(path)




def exchange_bytes(spark, df):
    """Bytes written to exchanges by an aggregation of ``df``."""
    group = f"bytes-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    df.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    store = spark.sparkContext._jsc.sc().statusStore()
    tracker, total = spark.sparkContext.statusTracker(), 0
    for job in tracker.getJobIdsForGroup(group):
        for stage_id in tracker.getJobInfo(job).stageIds:
            total += store.lastStageAttempt(stage_id).shuffleWriteBytes()
    return total


def test_fingerprints_shuffle_half_of_what_keys_do(spark, wide_log):
    names = [f"a{i}" for i in range(WIDE)]
    steps = mdp.mdp_steps(wide_log, SPEC, names)
    steps = stage(mdp.with_fingerprints(steps), "wide-steps")
    position = F.struct("case_id", "ts", "seq", "step")
    counts = [F.count(F.lit(1)).alias("n"), F.min(position).alias("first_at")]
    by_key = steps.groupBy("state_key", "action", "next_key").agg(*counts)
    by_print = mdp.count_edges(steps, SPEC)
    keys = mdp.key_dictionary(steps)
    prints = exchange_bytes(spark, by_print) + exchange_bytes(spark, keys)
    assert 0 < 2 * prints < exchange_bytes(spark, by_key)
    assert by_print.count() == by_key.count()
    assert not mdp.has_collisions(keys)


def keyed(model):
    rows = model.unabstracted.select("state", "state_key", "visits", "initial").collect()
    return {r["state"]: (tuple(r["state_key"]), r["visits"], r["initial"]) for r in rows}


def test_same_ids_when_fingerprints_collide(spark, wide_log):
    names = ["a0", "a1", "a2"]
    tried = []

    def weak(parts, salt):
        tried.append(salt)
        # the first two pairs of hashes tell few keys apart
        return mdp.key_hash(parts, salt) % 3 if salt < 4 else mdp.key_hash(parts, salt)

    plain = discover(wide_log, SPEC, names)
    salted = discover(wide_log, SPEC, names, hashed=weak)
    assert max(tried) == 5
    assert keyed(plain) == keyed(salted)
    assert sorted(map(tuple, plain.contract().collect())) == sorted(map(tuple, salted.contract().collect()))
    # ids follow the first appearance
    steps = mdp.mdp_steps(wide_log, SPEC, names).orderBy("case_id", "ts", "seq", "step").select("state_key").collect()
    order = {}
    for r in steps:
        order.setdefault(tuple(r["state_key"]), len(order))
    assert {key: state for state, (key, _, _) in keyed(plain).items()} == order
    with pytest.raises(RuntimeError, match="fingerprints"):
        discover(wide_log, SPEC, names, hashed=lambda parts, salt: F.lit(7).cast("long"))


def test_nulls_and_zeros_in_keys(spark):
    rows = [(None, "x", 0.0), ("x", None, -0.0), (None, "x", -0.0), ("x", None, float("nan")), ("x", None, None)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, p string, q string, n double")
    steps = frame.select("id", F.struct("p", "q", "n").alias("state_key"), F.when(F.col("id") > 0, F.struct("p", "q", "n")).alias("next_key"))
    printed = mdp.with_fingerprints(steps).orderBy("id").collect()
    prints = [(r["state_hi"], r["state_lo"]) for r in printed]
    # 0.0 and -0.0 are one value, as in a grouping; a null is told from its neighbour
    assert prints[0] == prints[2] and len(set(prints)) == 4
    assert printed[0]["next_hi"] is None and printed[1]["next_hi"] == printed[1]["state_hi"]
    assert mdp.key_dictionary(mdp.with_fingerprints(steps)).count() == 4
