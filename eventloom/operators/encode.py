"""A decision model as tables of boolean fluents and conditional outcome clauses.

``states`` has one row per state (id, last action name, attributes, initial
flag), ``transitions`` is the table of
:func:`eventloom.operators.mdp.transition_probabilities`.

Fluents are kept sparse: ``true_fluents`` has a row for each (fluent, state)
that holds; everything else is false. In the same way a clause does not list
the earlier targets of its group: they are the rows of the same (source,
action) with a smaller ``position``. Both stay linear in the input.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.missing import to_boolean
from eventloom.functions.names import category_label, sanitize_name
from eventloom.operators.distinct import many_valued
from eventloom.operators.scan import GroupMax, Previous, RowNumber, RunningSum, Splits, ordered_scan, unsplit
from eventloom.spec import col
from eventloom.staging import stage

# Texts of a true/false/missing attribute
TRI_VALUES = ("True", "False", "missing")

#: no remaining mass below this
SMALLEST_REMAINDER = 1e-9

ATTRIBUTE_SCHEMA = "position long, attribute string, kind string, pvar string"


# --- names -----------------------------------------------------------------------


def uniquify(
    df: DataFrame, name: str, order: Sequence[str], output: str = "unique_name", splits: Splits | None = None
) -> DataFrame:
    """Number repeated names in ``order``: x, x_2, x_3, ..."""
    numbered = ordered_scan(df, [name], order, {"__occurrence": RowNumber()}, splits)
    again = F.concat_ws("_", col(name), F.col("__occurrence").cast("string"))
    value = F.when(F.col("__occurrence") == 1, col(name)).otherwise(again)
    return numbered.withColumn(output, value).drop("__occurrence")


def check_unique(df: DataFrame, name: str) -> DataFrame:
    """Raise if a name still occurs twice (``a``, ``a``, ``a_2`` collide)."""
    twice = df.groupBy(col(name)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(5).collect()
    if twice:
        raise ValueError(f"names collide: {[r[0] for r in twice]}")
    return df


def action_names(transitions: DataFrame) -> DataFrame:
    """(action, fluent) for the sorted action alphabet."""
    actions = transitions.select("action").distinct()
    named = actions.withColumn("name", F.concat(F.lit("action-"), sanitize_name(F.col("action"))))
    return uniquify(named, "name", ["action"], "fluent").select("action", "fluent")


# --- attributes --------------------------------------------------------------------


def check_ids(states: DataFrame, id_col: str = "state") -> DataFrame:
    """One row (n, smallest, largest, distinct_ids, contiguous) about the state ids."""
    per_id = states.groupBy(col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    row = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.min("id").cast("long").alias("smallest"),
        F.max("id").cast("long").alias("largest"),
        F.count("id").alias("distinct_ids"),
    )
    contiguous = (F.col("smallest") == 0) & (F.col("largest") == F.col("n") - 1) & (F.col("distinct_ids") == F.col("n"))
    return row.withColumn("contiguous", F.coalesce(contiguous, F.col("n") == 0))


def classify_columns(
    states: DataFrame,
    id_col: str = "state",
    skip: Iterable[str] = ("last_action_name", "initial"),
    max_numeric_values: int = 20,
    attributes: Sequence[str] | None = None,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """(position, attribute, kind, pvar): ``tri`` for true/false/missing, else ``cat``.

    ``attributes`` names the columns to encode, all by default. A numeric column with more than ``max_numeric_values`` distinct values is
    an error: it must be discretized first. ``sketches`` of the columns
    (:func:`eventloom.operators.distinct.distinct_sketches`) save a pass over the table.
    """
    skip = {id_col, *skip}
    unknown = set(attributes or ()) - set(states.columns)
    if unknown:
        raise ValueError(f"no such attributes: {sorted(unknown)}")
    fields = [f for f in states.schema if f.name not in skip and (attributes is None or f.name in attributes)]
    strings = [f.name for f in fields if not isinstance(f.dataType, (T.BooleanType, T.NumericType))]
    numbers = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    checks = [F.lit(1).alias("one")]
    for i, n in enumerate(strings):
        checks += [F.count(col(n)).alias(f"c{i}"), F.min(col(n).cast("string").isin(*TRI_VALUES)).alias(f"t{i}")]
    row = states.agg(*checks).first()
    tri = {n for i, n in enumerate(strings) if row[f"c{i}"] > 0 and row[f"t{i}"]}
    many = many_valued(states, numbers, max_numeric_values, sketches)
    for name in numbers:
        if many[name]:
            raise ValueError(f"column {name!r} is numeric with more than {max_numeric_values} distinct values: discretize it first")
    kinds = [
        (i, f.name, "tri" if isinstance(f.dataType, T.BooleanType) or f.name in tri else "cat")
        for i, f in enumerate(fields)
    ]
    if not kinds:
        return states.sparkSession.createDataFrame([], ATTRIBUTE_SCHEMA)
    table = states.sparkSession.createDataFrame(kinds, "position long, attribute string, kind string")
    table = table.withColumn("name", sanitize_name(F.col("attribute")))
    named = uniquify(table, "name", ["position"], "pvar", unsplit(["name"], ["position"]))
    # one row per column of the table
    rows = named.select("position", "attribute", "kind", "pvar").orderBy("position").collect()
    return states.sparkSession.createDataFrame(rows, ATTRIBUTE_SCHEMA)


def _attribute_values(states: DataFrame, attributes: Sequence, id_col: str) -> DataFrame:
    """(state, position, value, number, label) of the categorical attributes, nulls left out."""
    types = {f.name: f.dataType for f in states.schema}

    def entry(a) -> Column:
        value, kind = col(a["attribute"]), types[a["attribute"]]
        number = value.cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")
        return F.struct(
            F.lit(a["position"]).alias("position"),
            F.when(F.isnan(number), None).otherwise(value.cast("string")).alias("value"),
            number.alias("number"),
            category_label(value, kind).alias("label"),
        )

    return states.select(col(id_col).alias("state"), F.inline(F.array(*[entry(a) for a in attributes]))).where(
        F.col("value").isNotNull()
    )


def fluent_names(states: DataFrame, transitions: DataFrame, attributes: DataFrame, id_col: str = "state") -> DataFrame:
    """(pvar, attribute, value, position, rank): all fluents of the attributes, in order.

    A ``tri`` attribute is one fluent (value null), a ``cat`` attribute one per
    value. Names are unique also against states, actions and attributes.
    """
    kinds = attributes.collect()  # one row per column of the table
    tri = attributes.where(F.col("kind") == "tri").select(
        "pvar", "attribute", F.lit(None).cast("string").alias("value"), "position", F.lit(0).cast("long").alias("rank")
    )
    cats = [a for a in kinds if a["kind"] == "cat"]
    if not cats:
        return tri
    values = _attribute_values(states, cats, id_col).groupBy("position", "value", "number").agg(F.min("label").alias("label"))
    values = stage(values, "attribute-values")
    ranked = ordered_scan(values, ["position"], ["number", "value"], {"rank": RowNumber()})
    named = ranked.join(attributes.select("position", "attribute", F.col("pvar").alias("base")), "position").withColumn(
        "name", F.concat_ws("-", "base", sanitize_name(F.col("label")))
    )

    def section(df: DataFrame, number: int, name: Column, *order: Column) -> DataFrame:
        first, second = (*order, F.lit(0), F.lit(0))[:2]
        return df.select(
            F.lit(number).alias("section"), first.cast("long").alias("first"), second.cast("long").alias("second"), name.alias("name")
        )

    own = section(named, 4, F.col("name"), F.col("position"), F.col("rank"))
    actions = ordered_scan(action_names(transitions), (), ["action"], {"at": RowNumber()})
    reserved = (
        section(states.sparkSession.range(1), 0, F.lit("DUMMY"))
        # the name of a state, s and its number, has no dash and is unlike that of any value
        .unionByName(section(actions, 2, F.col("fluent"), F.col("at")))
        .unionByName(section(attributes.where(F.col("kind") != "cat"), 3, F.col("pvar"), F.col("position")))
    )
    unique = uniquify(reserved.unionByName(own), "name", ["section", "first", "second"], "pvar").where("section = 4")
    cat = named.join(
        unique.select(F.col("first").alias("position"), F.col("second").alias("rank"), "pvar"), ["position", "rank"]
    ).select("pvar", "attribute", "value", "position", "rank")
    return tri.unionByName(cat)


def true_fluents(states: DataFrame, names: DataFrame, attributes: DataFrame, id_col: str = "state") -> DataFrame:
    """(pvar, state) for each fluent that holds in a state."""
    kinds = attributes.collect()  # one row per column of the table
    types = {f.name: f.dataType for f in states.schema}
    flags = [
        F.struct(
            F.lit(a["pvar"]).alias("pvar"),
            (
                F.coalesce(col(a["attribute"]), F.lit(False))
                if isinstance(types[a["attribute"]], T.BooleanType)
                else F.coalesce(col(a["attribute"]) == "True", F.lit(False))
            ).alias("holds"),
        )
        for a in kinds
        if a["kind"] == "tri"
    ]
    cats = [a for a in kinds if a["kind"] == "cat"]
    parts = []
    if flags:
        long = states.select(col(id_col).alias("state"), F.inline(F.array(*flags)))
        parts.append(long.where("holds").select("pvar", "state"))
    if cats:
        long = _attribute_values(states, cats, id_col)
        parts.append(
            long.join(names.where(F.col("value").isNotNull()), ["position", "value"]).select("pvar", "state")
        )
    if not parts:
        return states.select(F.lit(None).cast("string").alias("pvar"), col(id_col).alias("state")).limit(0)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def fluent_support(names: DataFrame, fluents: DataFrame, n_states: int) -> DataFrame:
    """(pvar, n_true, constant): in how many states a fluent holds; constant if in all or none."""
    counts = fluents.groupBy("pvar").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    constant = F.when(n == 0, F.lit(False)).when(n == n_states, F.lit(True))
    return names.select("pvar").join(counts, "pvar", "left").select("pvar", n.alias("n_true"), constant.alias("constant"))


#: States in one bitmap
BITMAP_STATES = 32_768


def support_bitmaps(pairs: DataFrame, name: str = "pvar") -> DataFrame:
    """(``name``, bucket, bits): the states of each name, a bitmap per 32,768 ids.

    ``pairs`` has (``name``, state) with ids from 0: fluents and the states where
    they hold, or actions and the states that have them. Bit i of bucket b is state
    32,768 * b + i. Buckets without a state have no row.
    """
    # Spark's bitmaps count from 1
    one = F.col("state") + 1
    return pairs.groupBy(col(name), (F.bitmap_bucket_number(one) - 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("bits")
    )


def bitmap_states(bits: Column, bucket: Column) -> Column:
    """The sorted states of a bitmap."""
    byte = F.transform(F.sequence(F.lit(1), F.octet_length(bits)), lambda i: F.struct(i.alias("at"), F.hex(F.substring(bits, i, F.lit(1))).alias("hex")))
    used = F.filter(byte, lambda b: b["hex"] != "00")

    def eight(b: Column) -> Column:
        value = F.conv(b["hex"], 16, 10).cast("int")
        set_bits = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda i: F.call_function("shiftright", value, i) % 2 == 1)
        return F.transform(set_bits, lambda i: bucket.cast("long") * BITMAP_STATES + (b["at"] - 1) * 8 + i)

    return F.flatten(F.transform(used, eight))


def in_all(bitmaps: DataFrame, name: str = "pvar", group: Sequence[str] = ()) -> DataFrame:
    """(group..., bucket, bits): the states that all names of a group have."""
    keys = list(map(col, group))
    distinct = bitmaps.select(*keys, col(name)).distinct()
    both = bitmaps.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("found"), F.bitmap_and_agg("bits").alias("bits"))
    if group:
        joined = both.join(distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("names")), list(group))
    else:
        joined = both.withColumn("names", F.lit(distinct.count()))
    return joined.where("found = names and bitmap_count(bits) > 0").select(*keys, "bucket", "bits")


def in_any(bitmaps: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """(group..., bucket, bits): the states that some name of a group has."""
    return bitmaps.groupBy(*map(col, group), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def shared_states(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """(``left_name``, ``right_name``, n): in how many states each pair of names of two tables of bitmaps meets.

    Meant for two alphabets: the result has a row for each pair that meets.
    """
    pairs = left.select(col(left_name), "bucket", F.col("bits").alias("a")).join(right.select(col(right_name), "bucket", F.col("bits").alias("b")), "bucket")
    both = pairs.select(col(left_name), col(right_name), "bucket", F.explode(F.array("a", "b")).alias("bits"))
    met = both.groupBy(col(left_name), col(right_name), "bucket").agg(F.bitmap_and_agg("bits").alias("bits"))
    return met.groupBy(col(left_name), col(right_name)).agg(F.sum(F.bitmap_count("bits")).alias("n")).where("n > 0")


def initial_fluents(names: DataFrame, fluents: DataFrame, state: int) -> DataFrame:
    """(pvar, value): every fluent at the initial state."""
    here = fluents.where(F.col("state") == state).select("pvar", F.lit(True).alias("value"))
    return names.select("pvar").join(here, "pvar", "left").select("pvar", F.coalesce("value", F.lit(False)).alias("value"))


# --- initial, terminal, reward ---------------------------------------------------------


def terminal_states(
    states: DataFrame, end_action: str = "archive_application", id_col: str = "state", last_col: str = "last_action_name"
) -> DataFrame:
    if last_col not in states.columns:
        return states.select(col(id_col).alias("state")).limit(0)
    return states.where(col(last_col) == end_action).select(col(id_col).alias("state"))


def rewards(
    states: DataFrame, terminal: DataFrame, bonus: float = 10.0, otherwise: float = 0.0, id_col: str = "state"
) -> DataFrame:
    """(state, reward) for reaching a state: ``bonus`` where it is terminal."""
    flagged = terminal.select(F.col("state").alias("__terminal")).distinct()
    reached = F.when(F.col("__terminal").isNotNull(), F.lit(float(bonus))).otherwise(F.lit(float(otherwise)))
    return states.join(flagged, col(id_col) == F.col("__terminal"), "left").select(
        col(id_col).alias("state"), reached.alias("reward")
    )


def initial_candidates(states: DataFrame, id_col: str = "state", initial_col: str = "initial") -> DataFrame:
    """States whose flag is true in any of its spellings."""
    if initial_col not in states.columns:
        return states.select(col(id_col).alias("state")).limit(0)
    flag = to_boolean(col(initial_col), states.schema[initial_col].dataType)
    return states.where(flag).select(col(id_col).alias("state"))


def choose_initial_state(
    states: DataFrame,
    explicit: int | None = None,
    id_col: str = "state",
    initial_col: str = "initial",
    last_col: str = "last_action_name",
    start_action: str = "start",
) -> int:
    """The given state, the only flagged one, the first after ``start``, or 0.

    Several flagged states need a choice: the error lists the first of them.
    """
    if explicit is not None:
        return explicit
    found = initial_candidates(states, id_col, initial_col).orderBy("state").limit(101).collect()
    if len(found) == 1:
        return int(found[0]["state"])
    if found:
        ids = [int(r["state"]) for r in found[:100]]
        raise ValueError(f"several initial states, choose one of {ids}{' ...' if len(found) > 100 else ''}")
    if last_col in states.columns:
        first = states.where(col(last_col) == start_action).agg(F.min(col(id_col)).alias("state")).first()["state"]
        if first is not None:
            return int(first)
    return 0


# --- clauses -----------------------------------------------------------------------------


def stick_breaking(transitions: DataFrame) -> DataFrame:
    """Conditional outcome clauses of each (source, action).

    Targets are tried in ascending order. ``cond_p`` is the probability of a
    target given that none of the earlier ones (smaller ``position``) came
    about; the last target is certain then. ``previous_target`` links a clause
    to the one before it.
    """
    rows = transitions.select(
        F.col("state").alias("source"), "action", F.col("next_state").alias("target"), "probability"
    )
    scanned = ordered_scan(
        rows,
        ["source", "action"],
        ["target"],
        {
            "position": RowNumber(),
            "before": RunningSum(F.col("probability"), before=True),
            "previous_target": Previous(F.col("target")),
            "__last": GroupMax(F.col("target")),
        },
    )
    is_last = F.col("target") == F.col("__last")
    remaining = F.greatest(F.lit(1.0) - F.col("before"), F.lit(SMALLEST_REMAINDER))
    conditional = F.least(F.greatest(F.col("probability") / remaining, F.lit(0.0)), F.lit(1.0))
    return scanned.select(
        "source",
        "action",
        "target",
        "position",
        "previous_target",
        F.col("before").cast("double").alias("mass_before"),
        F.when(is_last, F.lit(1.0)).otherwise(conditional).alias("cond_p"),
        is_last.alias("is_last"),
    )


def earlier_targets(clauses: DataFrame, source: int, action: str, target: int) -> DataFrame:
    """(position, target): the targets that the guard of one clause rules out."""
    group = clauses.where((F.col("source") == source) & (F.col("action") == action))
    return group.where(F.col("target") < target).select("position", "target")


def modal_outcome(transitions: DataFrame) -> DataFrame:
    """(source, action, target, probability): the likeliest target, the smallest on ties."""
    best = F.max(F.struct("probability", (-F.col("next_state")).alias("minus_target"))).alias("best")
    return (
        transitions.groupBy(F.col("state").alias("source"), "action")
        .agg(best)
        .select("source", "action", (-F.col("best.minus_target")).alias("target"), F.col("best.probability"))
    )


def encode(
    states: DataFrame,
    transitions: DataFrame,
    initial: int | None = None,
    bonus: float = 10.0,
    end_action: str = "archive_application",
    attributes_to_encode: Sequence[str] | None = None,
    max_numeric_values: int = 20,
    include_attributes: bool = True,
) -> dict[str, DataFrame]:
    """All tables of the encoded model, by name."""
    if not check_ids(states).first()["contiguous"]:
        raise ValueError("state ids must be 0..N-1")
    n_states = states.count()
    chosen = choose_initial_state(states, initial)
    terminal = terminal_states(states, end_action)
    tables = {
        "actions": action_names(transitions),
        "clauses": stick_breaking(transitions),
        "modal_outcomes": modal_outcome(transitions),
        "terminal_states": terminal,
        "rewards": rewards(states, terminal, bonus),
        "initial_state": states.where(F.col("state") == chosen).select("state"),
    }
    if include_attributes:
        classified = classify_columns(states, max_numeric_values=max_numeric_values, attributes=attributes_to_encode)
        names = stage(fluent_names(states, transitions, classified), "fluent-names")
        check_unique(names, "pvar")
        fluents = true_fluents(states, names, classified)
        tables |= {
            "fluent_names": names,
            "fluents": fluents,
            "fluent_support": fluent_support(names, fluents, n_states),
            "fluent_bitmaps": support_bitmaps(fluents),
            "initial_fluents": initial_fluents(names, fluents, chosen),
        }
    return tables
