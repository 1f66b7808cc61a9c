"""Query functions: (spark, sf_dir) to DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.catalog.log import (
    BUCKET_EDGES,
    BUCKET_LABELS,
    SPEC,
    bucket_log,
    bucket_model,
    described,
    level_log,
    load_log,
    model_of,
    position_model,
    raw_log,
)
from eventloom.functions import missing as m
from eventloom.functions.bins import fixed_bins
from eventloom.functions.names import category_label, sanitize_name
from eventloom.functions.time import infer_formats
from eventloom.operators import clean, distinct, encode, mdp, policy, temporal, transform
from eventloom.plans.discovery import discover
from eventloom.plans.preprocess import preprocess
from eventloom.plans.report import CleaningReport
from eventloom.staging import stage

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def micros(name: str = "ts"):
    return F.unix_micros(F.col(name)).alias(f"{name}_us")


def r6(name: str):
    return F.round(F.col(name), 6).alias(name)


# --- log ---------------------------------------------------------------------------


@query
def canonical_log(spark, sf_dir):
    return load_log(spark, sf_dir).select(
        "case_id", "seq", "activity", micros(), "value", "k", "resource", "segment"
    )


@query
def log_summary(spark, sf_dir):
    return temporal.log_summary(load_log(spark, sf_dir), SPEC)


@query
def activity_counts(spark, sf_dir):
    return temporal.activity_counts(load_log(spark, sf_dir), SPEC)


@query
def value_counts(spark, sf_dir):
    return clean.value_counts(load_log(spark, sf_dir), ["activity", "resource", "segment"])


@query
def invalid_ts_filter(spark, sf_dir):
    log = load_log(spark, sf_dir)
    text = (
        F.when(F.col("k") % 10 == 0, "n/a")
        .when(F.col("k") % 3 == 0, F.date_format("ts", "dd.MM.yyyy HH:mm:ss"))
        .when(F.col("k") % 3 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    spec = SPEC.with_(timestamp_formats=("dd.MM.yyyy HH:mm:ss",))
    return clean.parse_timestamps(log.withColumn("ts", text), spec).select("seq", micros())


@query
def numeric_coerce(spark, sf_dir):
    log = load_log(spark, sf_dir)
    text = F.when(F.col("k") % 4 == 0, F.concat(F.lit("x"), F.col("k"))).otherwise(F.col("k").cast("string"))
    return clean.coerce_numbers(log.select("seq", text.alias("number")), ["number"])


@query
def coerce_bool(spark, sf_dir):
    log = load_log(spark, sf_dir)
    k = F.col("k") % 8
    text = (
        F.when(k == 0, "true").when(k == 1, "1").when(k == 2, " Yes ").when(k == 3, "si")
        .when(k == 4, "Y").when(k == 5, "no").when(k == 6, "0")
    )
    rows = log.select("seq", text.alias("from_text"), (F.col("k") % 3).alias("from_number"))
    return clean.coerce_booleans(rows, ["from_text", "from_number"])


# --- cleaning --------------------------------------------------------------------------


@query
def sentinel_to_null(spark, sf_dir):
    log = load_log(spark, sf_dir).select("seq", "activity", "resource", "segment")
    return clean.sentinels_to_null(log, ["error", "r3", "BUILDING"])


@query
def normalize_missing(spark, sf_dir):
    k = F.col("k") % 6
    spelled = (
        F.when(k == 0, "UNKNOWN").when(k == 1, "unknown").when(k == 2, "Missing").when(k == 3, "nan")
        .otherwise(F.col("activity"))
    )
    rows = load_log(spark, sf_dir).select("seq", spelled.alias("label"), "resource")
    return clean.normalize_missing(rows, ["label", "resource"])


@query
def fill_missing(spark, sf_dir):
    gaps = F.when(F.col("k") % 3 != 0, F.col("value"))
    rows = load_log(spark, sf_dir).select("seq", "resource", gaps.alias("value"))
    return clean.fill_numbers(clean.fill_categories(rows, ["resource"]), ["value"])


@query
def forward_fill(spark, sf_dir):
    gaps = F.when(F.col("k") % 3 != 0, F.col("value"))
    log = load_log(spark, sf_dir).withColumn("value", gaps)
    return clean.forward_fill(log, SPEC, ["resource", "value", "segment"]).select("seq", "resource", "value", "segment")


@query
def rare_to_other(spark, sf_dir):
    slot = F.concat_ws("-", F.col("k").cast("string"), F.hour("ts").cast("string"))
    log = load_log(spark, sf_dir).select("seq", slot.alias("slot"), F.coalesce("resource", F.lit("missing")).alias("resource"))
    frequent = stage(clean.frequent_values(log, ["slot", "resource"], 10), "frequent-values", "attribute")
    return clean.group_rare_values(log, ["slot", "resource"], frequent)


def _log_with_gaps(spark, sf_dir):
    """A log with gaps, lost case ids, a boolean and rare values, and its specification."""
    k = F.col("k")
    gaps = {
        "case:concept:name": F.when(k % 17 != 0, F.col("case:concept:name")),
        "value": F.when(k % 3 != 0, F.col("value")),
        "busy": F.when(k % 5 != 0, k > 49),
        "slot": F.concat_ws("-", k.cast("string"), F.hour("time:timestamp").cast("string")),
    }
    spec = SPEC.with_(
        dynamic_categorical=("activity", "slot", "busy"),
        complete_with=("purchase", "signup"),
        with_open_cases=True,
        boolean_text=("busy",),
    )
    return raw_log(spark, sf_dir).withColumns(gaps), spec


@query
def preprocessed_log(spark, sf_dir):
    """The whole preprocessing."""
    log = preprocess(*_log_with_gaps(spark, sf_dir))
    features = map(r6, (*temporal.FEATURES[:3], "execution_time_minutes", "value", "k"))
    return log.select("case_id", "seq", "activity", "slot", "busy", "segment", *features, "event_nr", "timesincemidnight", "month", "weekday", "hour", "open_cases")


@query
def cleaning_report(spark, sf_dir):
    """What the preprocessing counted on its way."""
    report = CleaningReport()
    preprocess(*_log_with_gaps(spark, sf_dir), report)
    return report.table(spark)


@query
def complete_cases(spark, sf_dir):
    kept = clean.keep_complete_cases(load_log(spark, sf_dir), SPEC, ["purchase", "signup"])
    return kept.select("case_id", "seq", "activity")


@query
def label_cases(spark, sf_dir):
    return clean.label_cases(load_log(spark, sf_dir), SPEC, "purchase").select("case_id", "seq", "label")


@query
def cut_prefix(spark, sf_dir):
    cut = clean.label_cases(load_log(spark, sf_dir), SPEC, "purchase", cut=True)
    return cut.select("case_id", "seq", "activity", "label")


@query
def cut_at_terminal(spark, sf_dir):
    return clean.cut_at_terminal(load_log(spark, sf_dir), SPEC, ["purchase", "error"]).select("case_id", "seq", "activity")


# --- temporal features --------------------------------------------------------------------


@query
def time_features(spark, sf_dir):
    log = temporal.with_time_features(load_log(spark, sf_dir), SPEC)
    return log.select("case_id", "seq", *map(r6, temporal.FEATURES[:3]), "event_nr")


@query
def calendar_features(spark, sf_dir):
    log = temporal.with_calendar_features(load_log(spark, sf_dir), SPEC)
    return log.select("seq", "timesincemidnight", "month", "weekday", "hour")


@query
def infer_timestamps(spark, sf_dir):
    """Five ways to write a timestamp in one column, and texts that are none."""
    ts, way = F.col("ts"), F.col("seq") % 5
    formats = ("yyyy/MM/dd HH:mm:ss", "dd.MM.yyyy HH:mm", "M/d/yyyy h:mm:ss a", "d MMM yyyy HH:mm:ss.SSSSSS", "yyyyMMdd")
    text = F.when(F.col("seq") % 97 == 0, F.lit("not a date"))
    for i, pattern in enumerate(formats):
        text = text.when(way == i, F.date_format(ts, pattern))
    log = load_log(spark, sf_dir).select("seq", text.alias("ts"))
    return infer_formats(log, "ts").apply(log).select("seq", micros())


@query
def case_duration(spark, sf_dir):
    cases = temporal.case_durations(load_log(spark, sf_dir), SPEC)
    return cases.select("case_id", micros("start_time"), micros("end_time"), r6("execution_time_minutes"))


@query
def event_case_duration(spark, sf_dir):
    log = temporal.with_case_duration(load_log(spark, sf_dir), SPEC)
    return log.select("case_id", "seq", r6("execution_time_minutes"))


@query
def open_cases(spark, sf_dir):
    return temporal.with_open_cases(load_log(spark, sf_dir), SPEC).select("seq", "open_cases")


# --- transforms ---------------------------------------------------------------------------


@query
def fixed_bins_both_sides(spark, sf_dir):
    value = F.round("value", 0)
    return load_log(spark, sf_dir).select(
        "seq",
        fixed_bins(value, BUCKET_EDGES, BUCKET_LABELS).alias("right_closed"),
        fixed_bins(value, (50.0,), ("low", "high"), right=False).alias("left_closed"),
    )


@query
def standardize(spark, sf_dir):
    log = load_log(spark, sf_dir).select("seq", "value", "k")
    return transform.Standardizer.fit(log, ["value", "k"]).apply(log).select("seq", r6("value"), r6("k"))


@query
def standardize_inverse(spark, sf_dir):
    log = load_log(spark, sf_dir).select("seq", "value", "k")
    scaler = transform.Standardizer.fit(log, ["value", "k"])
    return scaler.invert(scaler.apply(log)).select("seq", r6("value"), r6("k"))


@query
def one_hot(spark, sf_dir):
    log = load_log(spark, sf_dir).select("seq", "activity", "resource")
    names = ["activity", "resource"]
    levels = transform.category_levels(transform.category_codes(log, names), names)
    return transform.one_hot_columns(log, levels).drop(*names)


@query
def sparse_one_hot(spark, sf_dir):
    slot = F.concat_ws("-", F.col("k").cast("string"), F.hour("ts").cast("string"))
    log = load_log(spark, sf_dir).select("seq", slot.alias("slot"), "activity", "resource")
    return transform.sparse_one_hot(log, ["seq"], ["slot", "activity", "resource"])


@query
def from_one_hot(spark, sf_dir):
    log = load_log(spark, sf_dir).select("seq", "activity")
    levels = transform.category_levels(transform.category_codes(log, ["activity"]), ["activity"])
    wide = transform.one_hot_columns(log, levels).drop("activity")
    return wide.select("seq", transform.from_one_hot(wide, "activity", levels["activity"]).alias("activity"))


@query
def label_encode(spark, sf_dir):
    slot = F.concat_ws("-", F.col("k").cast("string"), F.hour("ts").cast("string"))
    log = load_log(spark, sf_dir).select("seq", slot.alias("slot"))
    codes = stage(transform.category_codes(log, ["slot"]), "category-codes", "attribute")
    return transform.label_encode(log, "slot", codes, "code").select("seq", "slot", "code")


def _group_table(spark, sf_dir):
    return (
        load_log(spark, sf_dir)
        .groupBy("activity", "k")
        .agg(
            F.round(F.avg("value"), 6).alias("mean_value"),
            F.count(F.lit(1)).alias("n_events"),
            F.max(F.coalesce("resource", F.lit("NIL"))).alias("resource"),
        )
    )


@query
def discretize_states(spark, sf_dir):
    return transform.discretize_table(
        _group_table(spark, sf_dir), sentinels=["NIL"], categorical=["k"], bins=3
    )


@query
def discretize_fallback(spark, sf_dir):
    table = load_log(spark, sf_dir).select(
        "seq",
        (F.col("k") % 2).alias("two_values"),
        F.when(F.col("k") % 10 == 0, F.col("k")).otherwise(F.lit(1)).alias("mostly_one"),
        "k",
    )
    # bins without labels of their own have interval texts, which SQL does not know
    fitted = transform.Discretizer.fit(table, ["two_values", "mostly_one", "k"], 4, ("a", "b", "c", "d"))
    return fitted.apply(table).withColumnRenamed("k", "bin")


@query
def quantile_edges(spark, sf_dir):
    found = transform.quantiles(load_log(spark, sf_dir), ["value", "k"], [0.0, 0.25, 0.5, 0.9, 1.0])
    picked = {f"q{i}": F.round(F.get("edges", F.lit(i)), 6) for i in range(5)}
    return found.select("attribute", "distinct_values", *[c.alias(n) for n, c in picked.items()])


@query
def many_valued_columns(spark, sf_dir):
    """Which columns have more than 100 values, by sketches of two parts of the log."""
    slot = F.concat_ws("-", F.col("k").cast("string"), F.hour("ts").cast("string"))
    log = load_log(spark, sf_dir).withColumn("slot", slot).withColumn("minute", F.minute("ts"))
    names = ["value", "k", "slot", "minute", "activity", "resource"]
    parts = [distinct.distinct_sketches(log.where(F.col("seq") % 2 == i), names) for i in (0, 1)]
    many = distinct.many_valued(log, names, 100, distinct.merge_sketches(*parts))
    return spark.createDataFrame(sorted(many.items()), "attribute string, many boolean")


@query
def kmeans_states(spark, sf_dir):
    # three groups of near numbers, far from each other: any good partition is this one
    model = model_of(level_log(spark, sf_dir), ["level"], kind="partial_k_means", k=3)
    return model.mapping.join(model.unabstracted, "state").select(
        "state", "abstract_state", F.col("state_key.last_action").alias("last_action"), "visits"
    )


# --- decision model --------------------------------------------------------------------------


@query
def mdp_events(spark, sf_dir):
    log = bucket_log(spark, sf_dir)
    steps = mdp.mdp_steps(log, SPEC, ["bucket"])
    return steps.select(
        "case_id", "seq", "step", "last_action", "bucket", "action", F.col("next_key.bucket").alias("next_bucket")
    )


@query
def action_index(spark, sf_dir):
    return bucket_model(spark, sf_dir).actions


@query
def state_index(spark, sf_dir):
    states = position_model(spark, sf_dir).unabstracted
    return states.select("state", "state_key.last_action", "state_key.event_nr", "state_key.k10", "visits", "initial")


@query
def next_state(spark, sf_dir):
    found = bucket_model(spark, sf_dir).next_states()
    return found.select("case_id", "seq", "step", "state", "next_state")


@query
def transitions(spark, sf_dir):
    return bucket_model(spark, sf_dir).transitions.select(
        "state", "action_index", "action", "next_state", r6("probability")
    )


@query
def transitions_unabstracted(spark, sf_dir):
    return position_model(spark, sf_dir).transitions.select(
        "state", "action_index", "action", "next_state", r6("probability")
    )


@query
def terminal_model(spark, sf_dir):
    """Cases end at a terminal activity, and states are merged by last action."""
    spec = SPEC.with_(terminal_activities=("purchase", "error"))
    model = discover(bucket_log(spark, sf_dir), spec, ["bucket"], kind="contextual", keep=())
    return model.transitions.select("state", "action_index", "action", "next_state", "n", r6("probability"))


@query
def initial_states(spark, sf_dir):
    return bucket_model(spark, sf_dir).initial_states()


@query
def valid_actions(spark, sf_dir):
    masks = position_model(spark, sf_dir).valid_actions()
    return masks.select("state", F.array_join("actions", ",").alias("actions"))


@query
def states_of_action(spark, sf_dir):
    return mdp.states_of_action(position_model(spark, sf_dir).transitions)


@query
def simplicity(spark, sf_dir):
    return position_model(spark, sf_dir).simplicity()


@query
def states_per_event(spark, sf_dir):
    model = position_model(spark, sf_dir)
    n = F.count(F.lit(1)).alias("states")
    rows = F.sum(F.when(F.col("state_key.last_action") == "start", 0).otherwise(F.col("visits")))
    # every case has one closing row beside its events
    closing = F.sum(F.when(F.col("state_key.last_action") == "archive_application", F.col("visits")).otherwise(0))
    counted = model.unabstracted.agg(n, (rows - closing).alias("events"))
    return counted.select("states", "events", F.round(F.col("states") / F.col("events"), 6).alias("ratio"))


@query
def describe_states(spark, sf_dir):
    _, table = described(spark, sf_dir)
    return table.select("state", "last_action_name", "segment", "resource", r6("value"), r6("k"), "initial")


def _abstract(model):
    return model.transitions.select("state", "action", "next_state", r6("probability"))


def _half():
    return fixed_bins(F.col("state_key.k10"), (5,), ("low", "high"), right=False)


@query
def abs_contextual(spark, sf_dir):
    return _abstract(position_model(spark, sf_dir, kind="contextual"))


@query
def abs_bucket(spark, sf_dir):
    return _abstract(position_model(spark, sf_dir, kind="bucket", bucket_of=_half()))


@query
def abs_structural(spark, sf_dir):
    return position_model(spark, sf_dir, kind="structural").mapping


@query
def abs_action_set(spark, sf_dir):
    return position_model(spark, sf_dir, kind="action-set").mapping


@query
def abs_action_count(spark, sf_dir):
    return position_model(spark, sf_dir, kind="action-count").mapping


@query
def abstraction_map(spark, sf_dir):
    return position_model(spark, sf_dir, kind="bucket", bucket_of=_half(), control_flow=["event_nr"]).mapping


# --- encoding ------------------------------------------------------------------------------------


def _encoded_states(spark, sf_dir):
    """Described and discretized states; also a flag and a true/false/missing text."""
    model, table = described(spark, sf_dir)
    flagged = table.withColumns(
        {
            "tenfold": F.floor(F.col("k") % 3).cast("double"),
            "isBusy": F.col("k") > 49.5,
            "Overspent": F.when(F.col("state") % 3 == 0, "True").when(F.col("state") % 3 == 1, "missing").otherwise("False"),
        }
    )
    staged = stage(flagged, "described")
    return model, transform.discretize_table(staged, drop=["segment"], exclude=["state", "tenfold"])


@query
def classify_columns(spark, sf_dir):
    _, states = _encoded_states(spark, sf_dir)
    return encode.classify_columns(states).select("position", "attribute", "kind", "pvar")


@query
def bool_fluents(spark, sf_dir):
    model, states = _encoded_states(spark, sf_dir)
    attributes = encode.classify_columns(states)
    names = stage(encode.fluent_names(states, model.transitions, attributes), "fluent-names")
    return encode.true_fluents(states, names, attributes)


@query
def fluent_support(spark, sf_dir):
    model, states = _encoded_states(spark, sf_dir)
    attributes = encode.classify_columns(states)
    names = stage(encode.fluent_names(states, model.transitions, attributes), "fluent-names")
    return encode.fluent_support(names, encode.true_fluents(states, names, attributes), states.count())


def _fluents(spark, sf_dir):
    model, states = _encoded_states(spark, sf_dir)
    attributes = encode.classify_columns(states)
    names = stage(encode.fluent_names(states, model.transitions, attributes), "fluent-names")
    return model, encode.true_fluents(states, names, attributes)


@query
def fluent_support_sets(spark, sf_dir):
    """The states of each fluent, as bitmaps unpacked for the comparison."""
    _, fluents = _fluents(spark, sf_dir)
    states = F.array_join(encode.bitmap_states(F.col("bits"), F.col("bucket")), ",")
    return encode.support_bitmaps(fluents).select("pvar", "bucket", F.bitmap_count("bits").alias("n_true"), states.alias("states"))


@query
def action_fluents(spark, sf_dir):
    """In how many states with an action a fluent holds, by bitmaps."""
    model, fluents = _fluents(spark, sf_dir)
    actions = encode.support_bitmaps(mdp.states_of_action(model.transitions), "action")
    return encode.shared_states(actions, encode.support_bitmaps(fluents), "action", "pvar")


@query
def initial_fluents(spark, sf_dir):
    model, states = _encoded_states(spark, sf_dir)
    attributes = encode.classify_columns(states)
    names = stage(encode.fluent_names(states, model.transitions, attributes), "fluent-names")
    state = encode.initial_candidates(states).agg(F.min("state")).first()[0]
    return encode.initial_fluents(names, encode.true_fluents(states, names, attributes), state)


@query
def sanitize_names(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    label = F.concat_ws(" / ", "p_name", "p_brand", F.lit("?"))
    camel = F.concat(F.element_at(F.split("p_name", " "), -1), F.col("p_brand"))
    digits = F.concat(F.col("p_size").cast("string"), F.lit(" "), F.col("p_type"))
    return parts.select(
        "p_partkey", *[sanitize_name(t).alias(n) for n, t in {"plain": label, "camel": camel, "digits": digits}.items()]
    )


@query
def category_labels(spark, sf_dir):
    log = load_log(spark, sf_dir)
    values = {
        "plain": F.col("value"),
        "whole": F.round("value", 0),
        "small": F.col("value") / 1e6,
        "large": F.col("value") * 12345.0 + 0.5,
    }
    double = log.schema["value"].dataType
    return log.select("seq", *[category_label(v, double).alias(n) for n, v in values.items()])


@query
def uniquify(spark, sf_dir):
    log = load_log(spark, sf_dir)
    return encode.uniquify(log.select("seq", "case_id"), "case_id", ["seq"])


@query
def action_names(spark, sf_dir):
    return encode.action_names(bucket_model(spark, sf_dir).transitions)


@query
def stick_breaking(spark, sf_dir):
    clauses = encode.stick_breaking(position_model(spark, sf_dir).transitions)
    return clauses.select(
        "source", "action", "target", "position", "previous_target", r6("mass_before"), r6("cond_p"), "is_last"
    )


@query
def modal_outcome(spark, sf_dir):
    return encode.modal_outcome(position_model(spark, sf_dir).transitions).select(
        "source", "action", "target", r6("probability")
    )


@query
def terminal_states(spark, sf_dir):
    _, table = described(spark, sf_dir)
    return encode.terminal_states(table)


@query
def rewards(spark, sf_dir):
    _, table = described(spark, sf_dir)
    table = stage(table, "described")
    return encode.rewards(table, encode.terminal_states(table))


@query
def initial_candidates(spark, sf_dir):
    _, table = described(spark, sf_dir)
    as_text = F.when(F.col("initial"), " Yes").otherwise("no")
    return encode.initial_candidates(table.withColumn("initial", as_text))


@query
def id_check(spark, sf_dir):
    return encode.check_ids(position_model(spark, sf_dir).unabstracted)


# --- policy ----------------------------------------------------------------------------------------


@query
def policy_h3(spark, sf_dir):
    model = bucket_model(spark, sf_dir)
    states = model.unabstracted.select("state", F.col("state_key.last_action").alias("last_action_name"))
    gains = encode.rewards(states, encode.terminal_states(states))
    table = policy.finite_horizon_policy(model.transitions, gains, horizon=3, discount=0.9)
    return table.select("step", "state", "action", r6("value"))


@query
def policy_converged(spark, sf_dir):
    model = bucket_model(spark, sf_dir)
    states = model.unabstracted.select("state", F.col("state_key.last_action").alias("last_action_name"))
    gains = encode.rewards(states, encode.terminal_states(states), otherwise=1.0)
    table = policy.converged_policy(model.transitions, gains, discount=0.3, tolerance=1e-9, otherwise=1.0)
    return table.select("state", "action", r6("value"))
