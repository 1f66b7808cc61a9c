"""Decision models of hand-made logs, against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventloom.operators import abstraction, mdp
from eventloom.plans.discovery import discover, state_attributes
from eventloom.spec import LogSpec

SPEC = LogSpec(static_categorical=("colour",), dynamic_numeric=("level", "remaining_time_minutes"))


def make_log(spark, seed=3, cases=40):
    rng = random.Random(seed)
    rows = []
    for c in range(cases):
        colour = rng.choice(["red", "blue", None])
        for i in range(rng.randint(1, 6)):
            # equal timestamps within a case: seq decides
            rows.append((f"case{c:03d}", rng.choice("abc"), i // 2 * 60, i, colour, rng.choice([1.0, 2.0, None]), 5.0))
    rng.shuffle(rows)
    schema = "case_id string, activity string, at long, seq long, colour string, level double, remaining_time_minutes double"
    return rows, spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("at")).drop("at")


def brute_steps(rows):
    cases = defaultdict(list)
    for r in rows:
        cases[r[0]].append(r)
    out = []
    for case in sorted(cases):
        events = sorted(cases[case], key=lambda r: (r[2], r[3]))
        first, last = events[0], events[-1]
        states = [("start", first[4], first[5])]
        states += [(e[1], e[4], e[5]) for e in events]
        states += [("archive_application", last[4], last[5])]
        actions = [e[1] for e in events] + ["archive_application", None]
        out.append((case, list(zip(states, actions, [*states[1:], None]))))
    return out


@pytest.fixture(scope="module")
def log(spark):
    rows, df = make_log(spark)
    return rows, df.cache()


def plain(row):
    return tuple(row) if row is not None else None


def test_state_attributes_leave_out_outcomes(spark, log):
    assert state_attributes(log[1], SPEC) == ["colour", "level"]


def test_steps(spark, log):
    rows, df = log
    steps = mdp.mdp_steps(df, SPEC, ["colour", "level"]).orderBy("case_id", "step").collect()
    got = [(r["case_id"], r["step"], plain(r["state_key"]), r["action"], plain(r["next_key"])) for r in steps]
    expected = [(c, i, s, a, n) for c, parts in brute_steps(rows) for i, (s, a, n) in enumerate(parts)]
    assert got == expected


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_states_and_transitions(spark, log, broadcast):
    """Null attributes are values like others, in broadcast and in sorted joins."""
    rows, df = log
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        model = discover(df, SPEC)
        ids, counts = {}, Counter()
        for _, parts in brute_steps(rows):
            for state, _, _ in parts:
                ids.setdefault(state, len(ids))
        for _, parts in brute_steps(rows):
            for state, action, following in parts:
                if action is not None:
                    counts[ids[state], action, ids[following]] += 1
        assert {plain(r["state_key"]): r["state"] for r in model.unabstracted.collect()} == ids
        totals = Counter()
        for (s, a, _), n in counts.items():
            totals[s, a] += n
        got = {(r["state"], r["action"], r["next_state"]): r["probability"] for r in model.contract().collect()}
        assert got == {k: n / totals[k[:2]] for k, n in counts.items()}
        order = {}
        for _, parts in brute_steps(rows):
            for state, _, _ in parts:
                order.setdefault(state[0], len(order))
        assert {r["action"]: r["action_index"] for r in model.actions.collect()} == order
        assert {r["state"] for r in model.initial_states().collect()} == {i for s, i in ids.items() if s[0] == "start"}
        measures = {r["measure"]: r["n"] for r in model.simplicity().collect()}
        assert measures == {"nodes": len(ids), "edges": len(counts)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("kind", [k for k in abstraction.KINDS if k != "none"])
def test_abstractions(spark, log, kind):
    rows, df = log
    model = discover(df, SPEC, kind=kind, k=3, bucket_of=F.col("state_key.level") >= 1.5)
    mapping = {r["state"]: r["abstract_state"] for r in model.mapping.collect()}
    keys = {r["state"]: plain(r["state_key"]) for r in model.unabstracted.collect()}
    assert set(mapping) == set(keys)

    moves = defaultdict(set)
    ids = {k: s for s, k in keys.items()}
    for _, parts in brute_steps(rows):
        for state, action, following in parts:
            moves[ids[state]].add((action, ids[following] if following else -1))
    class_of = {
        "contextual": lambda s: keys[s][0],
        "bucket": lambda s: (keys[s][0], None if keys[s][2] is None else keys[s][2] >= 1.5),
        "structural": lambda s: frozenset(moves[s]),
        "action-set": lambda s: frozenset(a for a, _ in moves[s] if a),
        "action-count": lambda s: frozenset(a for a, _ in moves[s] if a),
        "full_k_means": lambda s: mapping[s],
        "partial_k_means": lambda s: mapping[s],
    }[kind]
    numbers = {}
    expected = {s: numbers.setdefault(class_of(s), len(numbers)) for s in sorted(keys)}
    assert mapping == expected
    if kind == "full_k_means":
        assert len(numbers) <= 3
    if kind == "partial_k_means":
        for a in set(mapping.values()):
            assert len({keys[s][0] for s in keys if mapping[s] == a}) == 1

    # probabilities sum to one, and abstract ids are contiguous
    sums = model.transitions.groupBy("state", "action").agg(F.sum("probability").alias("p")).collect()
    assert all(abs(r["p"] - 1) < 1e-12 for r in sums)
    assert sorted(set(mapping.values())) == list(range(len(numbers)))
    counts = Counter()
    for _, parts in brute_steps(rows):
        for state, action, following in parts:
            if action is not None:
                counts[mapping[ids[state]], action, mapping[ids[following]]] += 1
    assert {(r["state"], r["action"], r["next_state"]): r["n"] for r in model.transitions.collect()} == dict(counts)


def test_unknown_abstraction_is_refused(spark, log):
    with pytest.raises(ValueError, match="unknown"):
        discover(log[1], SPEC, kind="other")
    with pytest.raises(ValueError, match="bucket_of"):
        discover(log[1], SPEC, kind="bucket")


def test_valid_actions_and_descriptions(spark, log):
    rows, df = log
    model = discover(df, SPEC, kind="contextual")
    masks = {r["state"]: r["actions"] for r in model.valid_actions().collect()}
    described = {r["state"]: r for r in model.describe(["colour"], ["level"]).collect()}
    members = defaultdict(list)
    for _, parts in brute_steps(rows):
        for state, action, _ in parts:
            members[state[0]].append((state, action))
    for state, row in described.items():
        mine = members[row["last_action_name"]]
        colours = Counter(s[1] for s, _ in mine if s[1])
        best = max(colours.values())
        assert row["colour"] == min(c for c, n in colours.items() if n == best)
        levels = [s[2] for s, _ in mine if s[2] is not None]
        assert row["level"] == pytest.approx(sum(levels) / len(levels))
        assert row["initial"] == (row["last_action_name"] == "start")
        assert masks[state] == sorted({a for _, a in mine if a})


def test_terminal_activities_cut_cases(spark, log):
    rows, df = log
    model = discover(df, SPEC.with_(terminal_activities=("a",)))
    after = model.contract().join(
        model.unabstracted.where("state_key.last_action = 'a'").select("state"), "state"
    )
    assert {r["action"] for r in after.collect()} == {"archive_application"}


def test_structural_classes_are_exact_when_fingerprints_collide(spark):
    from pyspark.sql import functions as F

    from eventloom.operators import abstraction

    rows = [(0, "a", 1), (0, "b", 2), (1, "a", 1), (1, "c", 2), (2, "a", 1), (2, "b", 2), (3, None, -1), (4, "d", -1), (5, "a", 1), (5, "c", 2)]
    numbered = spark.createDataFrame(rows, "state long, action string, next_state long")
    want = {0: 0, 2: 0, 1: 1, 5: 1, 3: 2, 4: 3}
    for fingerprint in (abstraction.outcome_fingerprint, lambda salt: F.lit(0)):
        got = {r["state"]: r["abstract_state"] for r in abstraction.structural(numbered, fingerprint).collect()}
        assert got == want
