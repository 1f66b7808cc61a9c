"""State abstractions: each gives (state, abstract_state) for every state.

``states`` is the table of :func:`eventloom.operators.mdp.state_space`, and
``numbered`` that of :func:`eventloom.operators.mdp.number_edges`. Abstract ids
follow the first appearance, hence the smallest member state.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.mdp import LAST_ACTION
from eventloom.operators.scan import dense_index, find_splits
from eventloom.operators.transform import feature_vectors, fit_clusters
from eventloom.staging import stage

KINDS = (
    "none",
    "contextual",
    "bucket",
    "structural",
    "action-set",
    "action-count",
    "full_k_means",
    "partial_k_means",
)


def merge_equal(keyed: DataFrame) -> DataFrame:
    """Merge states of equal ``key``; ``keyed`` has (state, key).

    Both sides of the join are staged: their sizes are known, and a key with
    very many states is split.
    """
    keyed = stage(keyed, "keyed-states")
    classes = keyed.groupBy("key").agg(F.min("state").alias("first_state"))
    splits = find_splits(keyed.select(F.col("state").alias("first_state")), (), ("first_state",))
    numbered = dense_index(classes, ["first_state"], "abstract_state", splits=splits)
    return keyed.join(stage(numbered, "classes"), "key").select("state", "abstract_state")


def _keyed(states: DataFrame, *parts: Column) -> DataFrame:
    return states.select("state", F.struct(*parts).alias("key"))


def _key_field(name: str) -> Column:
    return F.col("state_key")[name].alias(name)


def identity(states: DataFrame) -> DataFrame:
    return states.select("state", F.col("state").alias("abstract_state"))


def contextual(states: DataFrame) -> DataFrame:
    """By last action."""
    return merge_equal(_keyed(states, _key_field(LAST_ACTION)))


def bucket(states: DataFrame, bucket_of: Column, control_flow: Sequence[str] = ()) -> DataFrame:
    """By last action, a bucket of an attribute (an expression over ``state_key``) and control-flow columns."""
    return merge_equal(
        _keyed(states, _key_field(LAST_ACTION), bucket_of.alias("bucket"), *map(_key_field, control_flow))
    )


def outcome_fingerprint(salt: int) -> Column:
    """An order-free hash of the (action, next state) pairs of a state."""
    return F.sum(F.xxhash64(F.lit(salt), "action", "next_state").cast("decimal(38,0)"))


def structural(numbered: DataFrame, fingerprint: Callable[[int], Column] = outcome_fingerprint) -> DataFrame:
    """States with equal sets of (action, next state); -1 stands for the end of a case.

    States are grouped by size and two hash sums, so that a state with very many
    outcomes needs no list of them; then the outcomes of each state are joined
    with those of the first one of its group. A state that differs goes on to
    another round, so the classes are exact.
    """
    pairs = stage(numbered.select("state", "action", "next_state"), "outcomes")
    left = pairs.groupBy("state").agg(F.count(F.lit(1)).alias("n"), fingerprint(1).alias("a"), fingerprint(2).alias("b"))
    left = stage(left, "outcome-sets")
    exact = None
    while True:
        first = left.groupBy("n", "a", "b").agg(F.min("state").alias("first"))
        grouped = stage(left.join(first, ["n", "a", "b"]), "outcome-groups")
        mine = pairs.join(grouped.where("state <> first").select("state", "first"), "state")
        theirs = pairs.select(F.col("state").alias("first"), "action", "next_state")
        same = [mine["first"] == theirs["first"], mine["action"].eqNullSafe(theirs["action"]), mine["next_state"] == theirs["next_state"]]
        shared = mine.join(theirs, same).groupBy("state").agg(F.count(F.lit(1)).alias("shared"))
        checked = stage(grouped.join(shared, "state", "left"), "outcome-classes")
        equal = (F.col("state") == F.col("first")) | (F.coalesce("shared", F.lit(0)) == F.col("n"))
        found = checked.where(equal).select("state", F.col("first").alias("key"))
        exact = found if exact is None else exact.unionByName(found)
        left = checked.where(~equal).select("state", "n", "a", "b")
        if left.isEmpty():
            return merge_equal(exact)


def _with_all_states(keys: DataFrame, states: DataFrame, empty: Column) -> DataFrame:
    return states.select("state").join(keys, "state", "left").select("state", F.coalesce("key", empty).alias("key"))


def action_set(numbered: DataFrame, states: DataFrame) -> DataFrame:
    """States with equal sets of actions (bounded by the alphabet of activities)."""
    taken = numbered.where(F.col("action").isNotNull())
    keys = taken.groupBy("state").agg(F.array_sort(F.collect_set("action")).alias("key"))
    empty = F.array().cast("array<string>")
    return merge_equal(_with_all_states(keys, states, empty))


def action_count(numbered: DataFrame, states: DataFrame) -> DataFrame:
    """States with equal counts of (state, action) entries per action.

    A transition model has one entry per (state, action), so every count is 0 or 1.
    """
    entries = numbered.where(F.col("action").isNotNull()).select("state", "action").distinct()
    per_action = entries.groupBy("state", "action").agg(F.count(F.lit(1)).alias("entries"))
    counts = F.array_sort(F.collect_list(F.struct("action", "entries")))
    keys = per_action.groupBy("state").agg(counts.alias("key"))
    empty = F.array().cast("array<struct<action:string,entries:bigint>>")
    return merge_equal(_with_all_states(keys, states, empty))


def k_means(
    states: DataFrame,
    k: int,
    numeric: Sequence[str],
    categorical: Sequence[str],
    control_flow: Sequence[str] = (),
    partial: bool = True,
    seed: int = 0,
    encoding: Mapping[str, str] | None = None,
) -> DataFrame:
    """By cluster of the attributes; with ``partial`` by last action, cluster and control-flow columns.

    Distinct states are scaled and clustered with their visits as weights, so
    means, deviations and centers are those of the log's state rows. ``encoding``
    is that of :func:`eventloom.operators.transform.feature_vectors`.
    """
    skip = set(control_flow) if partial else set()
    numeric = [n for n in numeric if n not in skip]
    categorical = [n for n in categorical if n not in skip]
    if not partial:
        categorical = [LAST_ACTION, *categorical]
    flat = states.select(
        "state",
        F.col("visits").cast("double").alias("visits"),
        "state_key",
        *[_key_field(n) for n in dict.fromkeys([*numeric, *categorical])],
    )
    vectors = stage(
        feature_vectors(flat, numeric, categorical, encoding=encoding, weight="visits").select("state", "visits", "state_key", "features"), "state-vectors"
    )
    model = fit_clusters(vectors, k, seed, "visits")
    clustered = model.transform(vectors)
    parts = [F.col("cluster")]
    if partial:
        parts = [_key_field(LAST_ACTION), F.col("cluster"), *map(_key_field, control_flow)]
    return merge_equal(_keyed(clustered, *parts))
