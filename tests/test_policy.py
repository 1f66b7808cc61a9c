"""Policies against plain value iteration, and the exchanges of a step."""

import random

import pytest

from eventloom.operators import policy
from eventloom.staging import settings


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(1)
    moves = {}
    for state in range(40):
        for action in draw.sample("abcde", draw.randrange(0, 4)):
            targets = draw.sample(range(45), draw.randrange(1, 5))
            shares = [draw.random() for _ in targets]
            for target, share in zip(targets, shares, strict=True):
                moves[state, action, target] = share / sum(shares)
    # one state has most of the moves
    for target in range(45):
        moves[7, "wide", target] = moves[7, "wider", target] = moves[7, "widest", target] = 1 / 45
    rewards = {s: float(draw.choice([0, 0, 1, 10])) for s in range(45)}
    frame = spark.createDataFrame([(s, 0, a, t, p) for (s, a, t), p in moves.items()], "state long, action_index long, action string, next_state long, probability double")
    return moves, rewards, frame, spark.createDataFrame(list(rewards.items()), "state long, reward double")


def by_hand(moves, rewards, discount, otherwise, idle, steps=60):
    states = {s for s, _, _ in moves} | {t for _, _, t in moves} | set(rewards)
    worth, dead = dict.fromkeys(states, 0.0), 0.0
    for _ in range(steps):
        q = {(s, None): 0.0 for s in states if not any(m[0] == s for m in moves)} if idle is None else {(s, idle): otherwise + discount * dead for s in states}
        for (s, a, t), p in moves.items():
            q[s, a] = q.get((s, a), 0.0) + p * (rewards.get(t, otherwise) + discount * worth[t])
        worth = {s: max(v for (x, _), v in q.items() if x == s) for s in states}
        dead = otherwise + discount * dead
    best = {}
    for (s, a), v in q.items():
        best.setdefault(s, []).append((-round(v, 7), a or "", a, v))
    return {s: min(c)[2:] for s, c in best.items()}


@pytest.mark.parametrize(("otherwise", "idle", "buckets"), [(0.0, None, 4), (1.0, "noop", 3), (0.5, "Idle", 1)])
def test_converged_policy(tables, otherwise, idle, buckets):
    moves, rewards, transitions, gains = tables
    found = policy.converged_policy(transitions, gains, 0.3, 1e-10, otherwise, idle, buckets=buckets)
    got = {r["state"]: (r["action"], r["value"]) for r in found.collect()}
    want = by_hand(moves, rewards, 0.3, otherwise, idle)
    assert {s: a for s, (a, _) in got.items()} == {s: a for s, (a, _) in want.items()}
    assert all(abs(got[s][1] - v) < 1e-7 for s, (_, v) in want.items())


def test_no_convergence_is_an_error(tables):
    with pytest.raises(RuntimeError, match="no convergence"):
        policy.converged_policy(tables[2], tables[3], 0.9, max_steps=2)
    with pytest.raises(ValueError, match="discount"):
        policy.converged_policy(tables[2], tables[3], 1.0)


def test_a_step_exchanges_values_only(spark, tables):
    _, _, transitions, gains = tables
    layout = policy.bucket_moves(transitions, gains, buckets=4)
    values = gains.selectExpr("state", "reward AS value")
    with settings(spark, spark__sql__requireAllClusterKeysForCoPartition="false", spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        text = plan_of(policy.later_worth(layout, values))
    lines = text.splitlines()
    scans = [i for i, line in enumerate(lines) if "probability" in line and "Scan parquet" in line]
    assert len(scans) == 1 and "Bucketed: true" in lines[scans[0]]
    # up from the scan of the moves to the sums of a bucket, nothing is exchanged
    depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    at, level, above = scans[0], depth[scans[0]], []
    for i in range(at - 1, -1, -1):
        if depth[i] < level:
            above.append(lines[i])
            level = depth[i]
    up = [line.strip(" :+-") for line in above]
    first = next(i for i, line in enumerate(up) if "Exchange" in line)
    assert any("HashAggregate" in line and "part" in line for line in up[:first])
    # a state with a large share of all moves lies in several buckets
    spread = layout.moves.where("state = 7").select("bucket").distinct().count()
    assert spread > 1


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(KeyError), settings(spark, spark__sql__shuffle__partitions="3", spark__eventloom__trial="1"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        raise KeyError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.eventloom.trial", None) is None
