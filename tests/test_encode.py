"""Encoding tables and the policy, against brute force."""

import random
from collections import defaultdict

import pytest

from eventloom.operators import encode
from eventloom.operators.policy import finite_horizon_policy

TRANSITIONS = "state long, action_index long, action string, next_state long, probability double"


def transitions(spark, rows):
    return spark.createDataFrame([(s, 0, a, t, p) for s, a, t, p in rows], TRANSITIONS)


MOVES = [
    (0, "Create Fine", 1, 1.0),
    (1, "Add penalty", 2, 1669 / 1670),
    (1, "Add penalty", 5, 1 / 1670),
    (2, "pay", 0, 0.25),
    (2, "pay", 3, 0.5),
    (2, "pay", 4, 0.25),
    (3, "Pay", 4, 0.5),
    (3, "Pay", 2, 0.5),
]

STATES_SCHEMA = (
    "state long, last_action_name string, vehicleClass string, amount double, flag string, busy boolean, "
    "nothing string, initial string"
)
STATES = [
    (0, "start", "A", 3.0, "True", True, None, "yes"),
    (1, "Create Fine", "?", 3.0, "missing", False, None, "no"),
    (2, "Add penalty", "B c", 10.5, "False", None, None, None),
    (3, "pay", "b-C", None, None, True, None, "0"),
    (4, "archive_application", None, 20.0, "True", True, None, "no"),
    (5, "Add penalty", "A", 3.0, "False", False, None, "no"),
]


def states(spark):
    return spark.createDataFrame(STATES, STATES_SCHEMA)


def test_stick_breaking(spark):
    got = {(r["source"], r["action"], r["target"]): r for r in encode.stick_breaking(transitions(spark, MOVES)).collect()}
    assert got[1, "Add penalty", 2]["cond_p"] == pytest.approx(0.999401, abs=1e-6)
    last = got[1, "Add penalty", 5]
    assert (last["cond_p"], last["is_last"], last["position"], last["previous_target"]) == (1.0, True, 2, 2)
    three = [got[2, "pay", t] for t in (0, 3, 4)]
    assert [r["cond_p"] for r in three] == pytest.approx([0.25, 0.5 / 0.75, 1.0])
    assert [r["previous_target"] for r in three] == [None, 0, 3]
    guard = encode.earlier_targets(encode.stick_breaking(transitions(spark, MOVES)), 2, "pay", 4)
    assert sorted(tuple(r) for r in guard.collect()) == [(1, 0), (2, 3)]
    # the outcome probabilities come back from the clauses
    rest = defaultdict(lambda: 1.0)
    for key in sorted(got, key=lambda k: (k[0], k[1], k[2])):
        row = got[key]
        p = rest[key[:2]] * row["cond_p"]
        rest[key[:2]] -= p
        assert p == pytest.approx(next(m[3] for m in MOVES if (m[0], m[1], m[2]) == key))


def test_clamped_probabilities(spark):
    rows = encode.stick_breaking(transitions(spark, [(0, "a", 1, 0.9), (0, "a", 2, 0.4), (0, "a", 3, 0.2)])).orderBy("target")
    assert [r["cond_p"] for r in rows.collect()] == [0.9, 1.0, 1.0]


def test_modal_outcome(spark):
    got = {(r["source"], r["action"]): (r["target"], r["probability"]) for r in encode.modal_outcome(transitions(spark, MOVES)).collect()}
    assert got[2, "pay"] == (3, 0.5)
    assert got[3, "Pay"] == (2, 0.5)  # the smallest on ties


def test_action_names(spark):
    got = {r["action"]: r["fluent"] for r in encode.action_names(transitions(spark, MOVES)).collect()}
    assert got == {
        "Add penalty": "action-add-penalty", "Create Fine": "action-create-fine", "Pay": "action-pay", "pay": "action-pay_2",
    }


def test_names_and_fluents(spark):
    table, moves = states(spark), transitions(spark, MOVES)
    attributes = encode.classify_columns(table)
    assert [(r["attribute"], r["kind"], r["pvar"]) for r in attributes.collect()] == [
        ("vehicleClass", "cat", "vehicle-class"), ("amount", "cat", "amount"), ("flag", "tri", "flag"),
        ("busy", "tri", "busy"), ("nothing", "cat", "nothing"),
    ]
    names = encode.fluent_names(table, moves, attributes)
    ordered = [(r["pvar"], r["value"]) for r in names.orderBy("position", "rank").collect()]
    assert ordered == [
        ("vehicle-class-na", "?"), ("vehicle-class-a", "A"), ("vehicle-class-b-c", "B c"), ("vehicle-class-b-c_2", "b-C"),
        ("amount-v-3", "3.0"), ("amount-v-10-5", "10.5"), ("amount-v-20", "20.0"), ("flag", None), ("busy", None),
    ]
    fluents = encode.true_fluents(table, names, attributes)
    true = defaultdict(set)
    for r in fluents.collect():
        true[r["pvar"]].add(r["state"])
    assert true == {
        "vehicle-class-na": {1}, "vehicle-class-a": {0, 5}, "vehicle-class-b-c": {2}, "vehicle-class-b-c_2": {3},
        "amount-v-3": {0, 1, 5}, "amount-v-10-5": {2}, "amount-v-20": {4}, "flag": {0, 4}, "busy": {0, 3, 4},
    }
    at = {r["pvar"]: r["value"] for r in encode.initial_fluents(names, fluents, 4).collect()}
    assert at == {n: 4 in true[n] for n, _ in ordered}
    support = {r["pvar"]: (r["n_true"], r["constant"]) for r in encode.fluent_support(names, fluents, 6).collect()}
    assert support == {n: (len(true[n]), None) for n, _ in ordered}
    assert encode.fluent_support(names, fluents, 3).where("pvar = 'busy'").first()["constant"] is True
    assert encode.fluent_support(names, fluents.limit(0), 6).where("constant").count() == 0
    chosen = encode.classify_columns(table, attributes=[attributes.orderBy("position").first()["attribute"]])
    assert chosen.count() == 1
    with pytest.raises(ValueError, match="nowhere"):
        encode.classify_columns(table, attributes=["nowhere"])


def test_fluents_avoid_state_names(spark):
    table = spark.createDataFrame([(0, "start", "True", True), (1, "x", "False", True)], "state long, last_action_name string, s1 string, S0 boolean")
    attributes = encode.classify_columns(table)
    assert [r["pvar"] for r in attributes.collect()] == ["s1", "s0"]


def test_too_many_numbers_are_refused(spark):
    table = spark.createDataFrame([(i, float(i)) for i in range(30)], "state long, x double")
    with pytest.raises(ValueError, match="discretize"):
        encode.classify_columns(table)
    assert encode.classify_columns(table, max_numeric_values=30).count() == 1


def test_unique_names(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("a", 2), ("a", 3)], "n string, i int")
    got = encode.uniquify(df, "n", ["i"]).orderBy("i").collect()
    assert [r["unique_name"] for r in got] == ["a", "b", "a_2", "a_3"]
    clash = spark.createDataFrame([("a", 0), ("a", 1), ("a_2", 2)], "n string, i int")
    with pytest.raises(ValueError, match="collide"):
        encode.check_unique(encode.uniquify(clash, "n", ["i"]), "unique_name")


def test_initial_state_choice(spark):
    table = states(spark)
    assert encode.choose_initial_state(table) == 0
    assert encode.choose_initial_state(table, 4) == 4
    two = spark.createDataFrame([(0, "start", True), (3, "start", True)], "state long, last_action_name string, initial boolean")
    with pytest.raises(ValueError, match=r"\[0, 3\]"):
        encode.choose_initial_state(two)
    none = spark.createDataFrame([(0, "x", False), (2, "start", False)], "state long, last_action_name string, initial boolean")
    assert encode.choose_initial_state(none) == 2
    assert encode.choose_initial_state(none.select("state")) == 0


def test_ids_terminals_rewards(spark):
    table = states(spark)
    assert encode.check_ids(table).first()["contiguous"]
    for bad in ([0, 2], [1, 2], [0, 0, 1]):
        df = spark.createDataFrame([(i,) for i in bad], "state long")
        assert not encode.check_ids(df).first()["contiguous"]
    assert [r["state"] for r in encode.terminal_states(table).collect()] == [4]
    assert encode.terminal_states(table.drop("last_action_name")).count() == 0
    got = {r["state"]: r["reward"] for r in encode.rewards(table, encode.terminal_states(table), 7).collect()}
    assert got == {0: 0.0, 1: 0.0, 2: 0.0, 3: 0.0, 4: 7.0, 5: 0.0}


def test_encode_tables(spark):
    tables = encode.encode(states(spark), transitions(spark, MOVES))
    assert set(tables) == {
        "actions", "clauses", "modal_outcomes", "terminal_states", "rewards", "initial_state", "fluent_names", "fluents",
        "fluent_support", "fluent_bitmaps", "initial_fluents",
    }
    assert tables["initial_state"].first()["state"] == 0
    control_flow_only = encode.encode(states(spark), transitions(spark, MOVES), include_attributes=False)
    assert "fluents" not in control_flow_only
    with pytest.raises(ValueError, match="0..N-1"):
        encode.encode(states(spark).where("state > 0"), transitions(spark, MOVES))


def test_policy_equals_value_iteration(spark):
    rng = random.Random(9)
    rows = []
    for s in range(12):
        for a in rng.sample("abcd", rng.randint(0, 3)):
            targets = rng.sample(range(12), rng.randint(1, 4))
            weights = [rng.random() for _ in targets]
            rows += [(s, a, t, w / sum(weights)) for t, w in zip(targets, weights)]
    gains = {t: (10.0 if t in (3, 7) else 0.0) for t in range(12)}
    table = finite_horizon_policy(
        transitions(spark, rows), spark.createDataFrame(list(gains.items()), "state long, reward double"), 5, 0.9
    )
    got = {(r["step"], r["state"]): (r["action"], r["value"]) for r in table.collect()}
    value = dict.fromkeys(range(12), 0.0)
    expected = {}
    for step in range(1, 6):
        worth = defaultdict(float)
        for s, a, t, p in rows:
            worth[s, a] += p * (gains[t] + 0.9 * value[t])
        best = {}
        for (s, a), q in sorted(worth.items()):
            if s not in best or q > best[s][1] + 1e-9:
                best[s] = (a, q)
        value = {s: best[s][1] if s in best else 0.0 for s in range(12)}
        expected |= {(step, s): b for s, b in best.items()}
    assert set(got) == set(expected)
    for key, (action, worth) in expected.items():
        assert got[key] == (action, pytest.approx(worth))
    with pytest.raises(ValueError):
        finite_horizon_policy(transitions(spark, rows), table, 0)
