"""Discovery of a Markov decision process from an event table.

The log is scanned once (``mdp_steps``) and reduced at once to counted edges
(``count_edges``): distinct (state, action, next state) with the number of
occurrences and the first position. States, transitions, initial states and all
abstractions are derived from the edges, not from the events.

A state is a struct of the last action and the attributes, which may be many and
long texts. What is shuffled and joined in its place is a fingerprint of 128 bits
(``with_fingerprints``); the structs go once into a dictionary of distinct keys
(``key_dictionary``), which also shows whether two keys share a fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.clean import category_text
from eventloom.operators.scan import Following, RowNumber, Splits, dense_index, find_splits, ordered_scan
from eventloom.spec import LogSpec, col

LAST_ACTION = "last_action"


def mdp_steps(df: DataFrame, spec: LogSpec, attributes: Sequence[str], splits: Splits | None = None) -> DataFrame:
    """State rows of every case, with the action taken from each and the state it leads to.

    A case of n events has n + 2 rows: one before the first event (last action
    ``spec.start_action``), one per event, and one after the last (last action
    ``spec.end_action``), which has no action. The added rows carry the
    attributes of the first and the last event.

    Columns: all columns of ``df``, ``step`` (0 to n + 1), ``last_action``,
    ``action``, ``state_key`` and ``next_key`` (struct of last action and
    ``attributes``).
    """
    attributes = list(attributes)
    own = F.struct(*map(col, attributes)) if attributes else F.struct(F.lit(0).alias("none"))
    scanned = ordered_scan(
        df,
        [spec.case],
        spec.order,
        {"__number": RowNumber(), "__next": Following(F.struct(col(spec.activity).alias("activity"), own.alias("at")))},
        splits,
    )
    number, activity, following = F.col("__number"), col(spec.activity), F.col("__next")
    is_last = following.isNull()

    def row(step: Column, last: Column, action: Column, next_at: Column) -> Column:
        return F.struct(
            step.cast("long").alias("step"),
            last.alias(LAST_ACTION),
            action.cast("string").alias("action"),
            next_at.alias("next_at"),
        )

    nothing = F.lit(None)
    start = row(F.lit(0), F.lit(spec.start_action), activity, own)
    event = row(
        number, activity, F.coalesce(following["activity"], F.lit(spec.end_action)), F.coalesce(following["at"], own)
    )
    end = row(number + 1, F.lit(spec.end_action), nothing, F.when(F.lit(False), own))
    rows = (
        F.when((number == 1) & is_last, F.array(start, event, end))
        .when(number == 1, F.array(start, event))
        .when(is_last, F.array(event, end))
        .otherwise(F.array(event))
    )
    kept = [col(n) for n in df.columns if n not in ("step", LAST_ACTION, "action")]
    steps = scanned.select(*kept, F.inline(rows))
    state_key = F.struct(F.col(LAST_ACTION), *map(col, attributes))
    next_key = F.struct(F.col("action").alias(LAST_ACTION), *[F.col("next_at")[a].alias(a) for a in attributes])
    return steps.withColumns(
        {"state_key": state_key, "next_key": F.when(F.col("action").isNotNull(), next_key)}
    ).drop("next_at")


#: The two halves of the fingerprint of a row's state, and of the next one
STATE_PRINT, NEXT_PRINT = ("state_hi", "state_lo"), ("next_hi", "next_lo")


def key_hash(parts: Sequence[Column], salt: int) -> Column:
    """A 64-bit hash of values that tells nulls from other values by their places."""
    marked = [x for p in parts for x in (p.isNull(), p)]
    return F.xxhash64(F.lit(salt), *marked)


def _without_sign_of_zero(value: Column, kind: T.DataType) -> Column:
    return value + F.lit(0.0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def with_fingerprints(
    steps: DataFrame, salt: int = 0, hashed: Callable[[Sequence[Column], int], Column] = key_hash
) -> DataFrame:
    """Add the fingerprints of ``state_key`` and ``next_key``; null where there is no next key.

    ``salt`` chooses one of many independent fingerprints. Numbers that are grouped
    as equal (0.0 and -0.0) have equal fingerprints.
    """
    fields = steps.schema["state_key"].dataType.fields

    def parts(key: str) -> list[Column]:
        return [_without_sign_of_zero(F.col(key)[f.name], f.dataType) for f in fields]

    own = {n: hashed(parts("state_key"), 2 * salt + i) for i, n in enumerate(STATE_PRINT)}
    following = {n: F.when(F.col("next_key").isNotNull(), hashed(parts("next_key"), 2 * salt + i)) for i, n in enumerate(NEXT_PRINT)}
    return steps.withColumns(own | following)


#: Salt of the hash that tells keys with one fingerprint apart; no fingerprint uses it
CHECK_SALT = -1


def key_dictionary(steps: DataFrame) -> DataFrame:
    """(state_hi, state_lo, state_key, collides): one row per fingerprint, in one exchange of distinct keys.

    ``collides`` tells whether several keys have it, by a third hash of 64 bits that
    does not depend on the fingerprints.
    """
    fields = steps.schema["state_key"].dataType.fields
    third = key_hash([_without_sign_of_zero(F.col("state_key")[f.name], f.dataType) for f in fields], CHECK_SALT)
    rows = steps.select(*STATE_PRINT, "state_key", third.alias("third"))
    return rows.groupBy(*STATE_PRINT).agg(F.first("state_key").alias("state_key"), (F.min("third") < F.max("third")).alias("collides"))


def has_collisions(dictionary: DataFrame) -> bool:
    return not dictionary.where("collides").isEmpty()


def count_edges(steps: DataFrame, spec: LogSpec) -> DataFrame:
    """(state_hi, state_lo, last_action, action, next_hi, next_lo, n, first_at, initial), aggregated map-side first.

    ``steps`` have fingerprints; only these and the alphabet's texts are shuffled.
    The first position is a struct of any types, so Spark sorts before it
    aggregates; a position as one number would need a rank of all cases.
    """
    position = F.struct(col(spec.case).alias("case"), *[col(c).alias(f"at{i}") for i, c in enumerate(spec.order)], "step")
    return steps.groupBy(*STATE_PRINT, LAST_ACTION, "action", *NEXT_PRINT).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(position).alias("first_at"),
        F.max(F.col("step") == 0).alias("initial"),
    )


def state_space(edges: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(state, state_hi, state_lo, state_key, visits, initial, first_at): ids in order of first appearance.

    Both tables are read more than once, so hand in staged ones.
    """
    states = edges.groupBy(*STATE_PRINT).agg(
        F.sum("n").alias("visits"), F.max("initial").alias("initial"), F.min("first_at").alias("first_at")
    )
    numbered = dense_index(states, ["first_at"], "state", splits=find_splits(edges, (), ("first_at",)))
    keys = dictionary.select(*STATE_PRINT, "state_key")
    return numbered.join(keys, list(STATE_PRINT)).select("state", *STATE_PRINT, "state_key", "visits", "initial", "first_at")


def action_index(edges: DataFrame) -> DataFrame:
    """(action_index, action): ids in order of first appearance; the start action comes first."""
    actions = edges.groupBy(F.col(LAST_ACTION).alias("action")).agg(F.min("first_at").alias("first_at"))
    numbered = dense_index(actions, ["first_at"], "action_index", splits=find_splits(edges, (), ("first_at",)))
    return numbered.select("action_index", "action")


def _with_state_ids(rows: DataFrame, states: DataFrame, kept: Sequence[str]) -> DataFrame:
    """``kept`` columns, ``state`` and ``next_state`` (-1 where there is no next key) of rows with fingerprints."""
    following = states.select(F.col("state").alias("next_state"), *[F.col(a).alias(b) for a, b in zip(STATE_PRINT, NEXT_PRINT, strict=True)])
    columns = [*STATE_PRINT, *map(col, kept)]
    # the final rows have no next key, and would meet in one task if they were joined on it
    leading = rows.where(F.col(NEXT_PRINT[0]).isNotNull()).join(following, list(NEXT_PRINT))
    final = rows.where(F.col(NEXT_PRINT[0]).isNull()).withColumn("next_state", F.lit(-1).cast("long"))
    both = leading.select(*columns, "next_state").unionByName(final.select(*columns, "next_state"))
    ids = states.select("state", *STATE_PRINT)
    return both.join(ids, list(STATE_PRINT)).select(*map(col, kept), "state", "next_state")


def number_edges(edges: DataFrame, states: DataFrame) -> DataFrame:
    """Edges with state ids: (state, action, next_state, n, first_at); -1 after the last row of a case."""
    return _with_state_ids(edges, states, ["action", "n", "first_at"]).select("state", "action", "next_state", "n", "first_at")


def map_edges(numbered: DataFrame, mapping: DataFrame) -> DataFrame:
    """Edges between abstract states: (state, action, next_state, n)."""
    here = mapping.select("state", "abstract_state")
    there = mapping.select(F.col("state").alias("next_state"), F.col("abstract_state").alias("__to"))
    # the end of a case (-1) has no mapping and stays
    to = F.coalesce(F.col("__to"), F.col("next_state"))
    return (
        numbered.join(here, "state")
        .join(there, "next_state", "left")
        .groupBy(F.col("abstract_state").alias("state"), "action", to.alias("next_state"))
        .agg(F.sum("n").alias("n"))
    )


def transition_probabilities(numbered: DataFrame, actions: DataFrame | None = None) -> DataFrame:
    """(state, action_index, action, next_state, n, probability); pairs never seen have no row.

    ``numbered`` has one row per (state, action, next state), as :func:`number_edges`
    and :func:`map_edges` give them.
    """
    taken = numbered.where(F.col("action").isNotNull()).select("state", "action", "next_state", "n")
    # a join and not a window: a (state, action) with very many outcomes can be split
    totals = taken.groupBy("state", "action").agg(F.sum("n").alias("total"))
    table = taken.join(totals, ["state", "action"])
    if actions is not None:
        table = table.join(actions, "action", "left")
    else:
        table = table.withColumn("action_index", F.lit(None).cast("long"))
    return table.select("state", "action_index", "action", "next_state", "n", (F.col("n") / F.col("total")).alias("probability"))


def valid_actions(transitions: DataFrame, states: DataFrame) -> DataFrame:
    """(state, actions): sorted actions with mass; an empty list where there are none.

    The list is as long as the log's alphabet of activities at most.
    """
    masks = transitions.groupBy("state").agg(F.array_sort(F.collect_set("action")).alias("actions"))
    empty = F.array().cast(T.ArrayType(T.StringType()))
    return states.select("state").distinct().join(masks, "state", "left").select(
        "state", F.coalesce(F.col("actions"), empty).alias("actions")
    )


def states_of_action(transitions: DataFrame) -> DataFrame:
    """(action, state): the states each action was seen in, one row each."""
    return transitions.select("action", "state").distinct()


def initial_states(states: DataFrame) -> DataFrame:
    return states.where("initial").select("state").distinct()


def simplicity(states: DataFrame, transitions: DataFrame) -> DataFrame:
    """(measure, n): distinct states, and distinct (state, action, next state) with mass."""
    nodes = states.select("state").distinct().agg(F.count(F.lit(1)).alias("n"))
    # transitions are unique by construction
    edges = transitions.where(F.col("probability") > 0).agg(F.count(F.lit(1)).alias("n"))
    return nodes.select(F.lit("nodes").alias("measure"), "n").unionByName(
        edges.select(F.lit("edges").alias("measure"), "n")
    )


def next_states(steps: DataFrame, spec: LogSpec, states: DataFrame) -> DataFrame:
    """Per step its state id and the id of the next step's state in the case, -1 at the end.

    A step has the fingerprint of the next state, so both ids are looked up.
    """
    position = [*(col(n) for n in (spec.case, *spec.order)), F.col("step")]
    rows = steps.select(*position, *STATE_PRINT, *NEXT_PRINT)
    return _with_state_ids(rows, states, rows.columns[: len(position)])


def describe_states(
    steps: DataFrame,
    states: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
) -> DataFrame:
    """One row per state: last action, most frequent category (the smallest on ties), mean number, initial flag.

    ``states`` maps the fingerprints of keys to ``state``; several keys may share a state.
    Categories are counted per (key, column, value) first, so that no task
    keeps all values of a state; only the counts are joined with the states.
    """
    names = [LAST_ACTION, *categorical]
    rows = steps.select(*STATE_PRINT, *map(col, [LAST_ACTION, "step", *categorical, *numeric]))

    def pair(i: int, name: str) -> Column:
        """A category; the first one also carries the row's numbers, so that one pass does for all."""
        numbers = [
            (col(n).cast("double") if i == 0 else F.lit(None).cast("double")).alias(f"x{j}") for j, n in enumerate(numeric)
        ]
        first = (F.col("step") == 0) if i == 0 else F.lit(False)
        return F.struct(F.lit(i).alias("at"), category_text(steps, name).alias("value"), first.alias("first"), *numbers)

    numbers = range(len(numeric))
    per_key = (
        rows.select(*STATE_PRINT, F.inline(F.array(*[pair(i, n) for i, n in enumerate(names)])))
        .groupBy(*STATE_PRINT, "at", "value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("first").alias("first"),
            *[F.sum(f"x{j}").alias(f"sum{j}") for j in numbers],
            *[F.count(f"x{j}").alias(f"count{j}") for j in numbers],
        )
    )
    counted = (
        per_key.join(states.select("state", *STATE_PRINT), list(STATE_PRINT))
        .groupBy("state", "at", "value")
        .agg(F.sum("n").alias("n"), F.max("first").alias("first"), *[F.sum(f"{s}{j}").alias(f"{s}{j}") for s in ("sum", "count") for j in numbers])
    )

    def mode(i: int) -> Column:
        mine = (F.col("at") == i) & F.col("value").isNotNull()
        return F.min_by("value", F.when(mine, F.struct(-F.col("n"), F.col("value"))))

    renamed = ["last_action_name", *categorical]
    return counted.groupBy("state").agg(
        *[mode(i).alias(n) for i, n in enumerate(renamed)],
        *[(F.sum(f"sum{j}") / F.sum(f"count{j}")).alias(n) for j, n in enumerate(numeric)],
        F.max("first").alias("initial"),
    )
