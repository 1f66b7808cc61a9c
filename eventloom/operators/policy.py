"""Action recommendations: policies over the transition table, for a horizon or for good."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from eventloom.staging import settings, stage, stage_buckets

#: Values are rounded to so many decimals before they are compared, so that equal ones tie
TIE_DECIMALS = 7


def finite_horizon_policy(
    transitions: DataFrame,
    rewards: DataFrame,
    horizon: int = 20,
    discount: float = 1.0,
) -> DataFrame:
    """(step, state, action, value): the best action with ``step`` actions to go.

    ``rewards`` has the reward for reaching a state; reaching others gives 0,
    as does a state without actions. Equal values give the alphabetically first
    action. The values of every step are staged: the moves are then read once per
    step, the lineage stays short, and the optimizer knows whether the values are
    small enough to broadcast.
    """
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    gain = rewards.where(F.col("reward") != 0).select(F.col("state").alias("next_state"), "reward")
    moves = transitions.join(gain, "next_state", "left").select(
        "state", "action", "next_state", "probability", F.coalesce("reward", F.lit(0.0)).alias("reward")
    )
    moves = stage(moves, "moves")
    steps, values = [], None
    for step in range(1, horizon + 1):
        if values is None:
            outcome, source = F.col("reward"), moves
        else:
            later = values.select(F.col("state").alias("next_state"), F.col("value").alias("later"))
            source = moves.join(later, "next_state", "left")
            outcome = F.col("reward") + F.lit(float(discount)) * F.coalesce("later", F.lit(0.0))
        worth = source.groupBy("state", "action").agg(F.sum(F.col("probability") * outcome).alias("q"))
        # rounded, so that equal values tie whatever the order of summation
        best = F.min_by(F.struct("action", "q"), F.struct(-F.round("q", 9), F.col("action"))).alias("best")
        chosen = worth.groupBy("state").agg(best).select("state", "best.action", F.col("best.q").alias("value"))
        values = stage(chosen, f"values-{step}")
        steps.append(values.select(F.lit(step).cast("long").alias("step"), "state", "action", "value"))
    policy = steps[0]
    for table in steps[1:]:
        policy = policy.unionByName(table)
    return policy


@dataclass(frozen=True)
class BucketedMoves:
    """Moves laid out so that a step of value iteration exchanges values only.

    ``moves`` (bucket, state, action, next_state, probability) lie in buckets of
    states; a state with more than its share of all moves is spread over several.
    ``routes`` (state, bucket) say which buckets ask for the value of a state.
    ``expected`` (state, action, gain, idle_mass) has what does not change from step
    to step: the mean reward, and the probability of a state without actions.
    """

    moves: DataFrame
    routes: DataFrame
    expected: DataFrame
    buckets: int


def bucket_moves(transitions: DataFrame, rewards: DataFrame, otherwise: float = 0.0, buckets: int | None = None) -> BucketedMoves:
    """Lay out the moves of ``transitions``; the only exchange that they see."""
    buckets = buckets or int(transitions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    moves = transitions.select("state", "action", "next_state", "probability")
    acting = stage(moves.groupBy("state").agg(F.count(F.lit(1)).alias("moves")), "acting-states")
    share = -(-(acting.agg(F.coalesce(F.sum("moves"), F.lit(1))).first()[0]) // buckets)
    gains = rewards.select(F.col("state").alias("next_state"), "reward")
    to_acting = acting.select(F.col("state").alias("next_state"), F.lit(True).alias("acts"))
    known = stage(moves.join(gains, "next_state", "left").join(to_acting, "next_state", "left"), "moves")
    gain = F.sum(F.col("probability") * F.coalesce("reward", F.lit(float(otherwise))))
    idle = F.sum(F.when(F.col("acts").isNull(), F.col("probability")).otherwise(0.0))
    expected = known.groupBy("state", "action").agg(gain.alias("gain"), idle.alias("idle_mass"))
    parts = F.ceil(F.col("moves") / share)
    part = F.when(parts > 1, F.pmod(F.xxhash64("next_state"), parts)).otherwise(0)
    placed = known.where("acts").join(acting, "state").withColumn("bucket", F.pmod(F.xxhash64("state") + part, F.lit(buckets)).cast("int"))
    placed = stage(placed.select("bucket", "state", "action", "next_state", "probability"), "placed-moves")
    routes = placed.select(F.col("next_state").alias("state"), "bucket").distinct()
    return BucketedMoves(
        stage_buckets(placed, "moves", buckets, "bucket"),
        stage_buckets(routes, "routes", buckets, "state"),
        stage_buckets(expected, "expected", buckets, "state"),
        buckets,
    )


def later_worth(layout: BucketedMoves, values: DataFrame) -> DataFrame:
    """(state, action, later): the mean of the next states' ``values`` (state, value), without idle states.

    Values travel to the buckets that ask for them; the moves stay where they are, and sums leave.
    """
    asked = layout.routes.join(values.select("state", "value"), "state").select("bucket", F.col("state").alias("next_state"), "value")
    worth = layout.moves.join(asked, ["bucket", "next_state"]).groupBy("bucket", "state", "action")
    parts = worth.agg(F.sum(F.col("probability") * F.col("value")).alias("part"))
    return parts.repartition(layout.buckets, "state").groupBy("state", "action").agg(F.sum("part").alias("later"))


def _better(q: Column, action: Column) -> Column:
    return F.struct(-F.round(q, TIE_DECIMALS), action)


def converged_policy(
    transitions: DataFrame,
    rewards: DataFrame,
    discount: float = 0.9,
    tolerance: float = 1e-6,
    otherwise: float = 0.0,
    idle_action: str | None = "noop",
    max_steps: int = 1000,
    buckets: int | None = None,
) -> DataFrame:
    """(state, action, value): the best action for an endless run, for every state of both tables; staged.

    Value iteration until no value is further than ``tolerance`` from its limit,
    or an error after ``max_steps``. ``rewards`` has the reward for reaching a state, ``otherwise`` is that of
    reaching any other one. Doing nothing (``idle_action``) leads to a dead state
    outside the table, where only ``otherwise`` is earned; with ``None`` there is no
    such choice, and states without actions are worth nothing. Equal values give
    the alphabetically first action.
    """
    if not 0 <= discount < 1:
        raise ValueError("discount must be at least 0 and below 1")
    spark = transitions.sparkSession
    layout = bucket_moves(transitions, rewards, otherwise, buckets)
    dead, values = 0.0, None
    enough = tolerance * (1 - discount) / discount if discount else float("inf")
    for _ in range(max_steps):
        idle = dead if idle_action is not None else 0.0
        following = float(otherwise) + discount * dead
        # joined on fewer columns than both keys: a bucket is enough
        with settings(spark, spark__sql__requireAllClusterKeysForCoPartition="false"):
            source = layout.expected
            if values is None:
                source = source.withColumn("later", F.lit(0.0))
            else:
                source = source.join(later_worth(layout, values), ["state", "action"], "left")
            later = F.coalesce("later", F.lit(0.0)) + F.col("idle_mass") * F.lit(idle)
            worth = source.select("state", "action", (F.col("gain") + F.lit(float(discount)) * later).alias("q"))
            best = worth.groupBy("state").agg(F.min_by(F.struct("action", "q"), _better(F.col("q"), F.col("action"))).alias("best"))
            chosen = best.select("state", "best.action", F.col("best.q").alias("value"))
            if idle_action is not None:
                nothing, name = F.lit(following), F.lit(idle_action)
                rest = _better(nothing, name) < _better(F.col("value"), F.col("action"))
                chosen = chosen.select("state", F.when(rest, name).otherwise(F.col("action")).alias("action"), F.when(rest, nothing).otherwise(F.col("value")).alias("value"))
            change = F.abs(F.col("value"))
            if values is not None:
                chosen = chosen.join(values.select("state", F.col("value").alias("before")), "state")
                change = F.abs(F.col("value") - F.col("before"))
            seen = Observation()
            values = stage(chosen.observe(seen, F.max(change).alias("change")).select("state", "action", "value"), "values")
        moved = max(seen.get["change"] or 0.0, abs(following - dead) if idle_action is not None else 0.0)
        dead = following
        if moved <= enough:
            break
    else:
        raise RuntimeError(f"no convergence in {max_steps} steps")
    names = transitions.select("state").unionByName(transitions.select(F.col("next_state").alias("state"))).unionByName(rewards.select("state"))
    rest = names.distinct().join(values, "state", "left_anti")
    constant = rest.select("state", F.lit(idle_action).cast("string").alias("action"), F.lit(dead if idle_action is not None else 0.0).alias("value"))
    return stage(values.unionByName(constant), "policy")
