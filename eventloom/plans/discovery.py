"""From an event table to a (possibly abstracted) decision model."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators import abstraction, clean, mdp
from eventloom.operators.scan import Splits, find_splits
from eventloom.spec import LogSpec, col
from eventloom.staging import stage


#: Fingerprints to try before giving up; two keys of a log share one of 128 bits about never
SALTS = 4


@dataclass(frozen=True)
class DecisionModel:
    """Tables of a discovered model, each staged when it is first used. State ids are those of the abstraction."""

    spec: LogSpec
    steps: DataFrame  # state rows of the cases, with fingerprints of their keys
    dictionary: DataFrame  # (state_hi, state_lo, state_key)
    map_states: Callable[[DecisionModel], DataFrame] | None  # gives (state, abstract_state)

    @cached_property
    def edges(self) -> DataFrame:
        return stage(mdp.count_edges(self.steps, self.spec), "edges")

    @cached_property
    def unabstracted(self) -> DataFrame:
        """(state, state_hi, state_lo, state_key, visits, initial, first_at)"""
        return stage(mdp.state_space(self.edges, self.dictionary), "states")

    @cached_property
    def numbered(self) -> DataFrame:
        """Edges between unabstracted states: (state, action, next_state, n, first_at)"""
        return stage(mdp.number_edges(self.edges, self.unabstracted), "numbered-edges")

    @cached_property
    def mapping(self) -> DataFrame:
        """(state, abstract_state)"""
        if self.map_states is None:
            return abstraction.identity(self.unabstracted)
        return stage(self.map_states(self), "mapping")

    @cached_property
    def states(self) -> DataFrame:
        """(state, state_hi, state_lo, state_key, initial): one row per unabstracted key"""
        kept = (*mdp.STATE_PRINT, "state_key", "initial")
        if self.map_states is None:
            return self.unabstracted.select("state", *kept)
        joined = self.unabstracted.select("state", *kept).join(self.mapping, "state")
        return stage(joined.select(F.col("abstract_state").alias("state"), *kept), "state-keys")

    @cached_property
    def actions(self) -> DataFrame:
        """(action_index, action)"""
        return stage(mdp.action_index(self.edges), "actions")

    @cached_property
    def transitions(self) -> DataFrame:
        """(state, action_index, action, next_state, n, probability)"""
        edges = self.numbered
        if self.map_states is not None:
            edges = stage(mdp.map_edges(self.numbered, self.mapping), "abstract-edges")
        return stage(mdp.transition_probabilities(edges, self.actions), "transitions")

    def initial_states(self) -> DataFrame:
        return mdp.initial_states(self.states)

    def valid_actions(self) -> DataFrame:
        return mdp.valid_actions(self.transitions, self.states)

    def simplicity(self) -> DataFrame:
        return mdp.simplicity(self.states, self.transitions)

    def describe(self, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
        return mdp.describe_states(self.steps, self.states, categorical, numeric)

    def next_states(self) -> DataFrame:
        """Per step its unabstracted state and the next one of the case."""
        return mdp.next_states(self.steps, self.spec, self.unabstracted)

    def contract(self) -> DataFrame:
        """The transition table as it is handed on."""
        return self.transitions.select("state", "action_index", "action", "next_state", "probability")


def state_attributes(df: DataFrame, spec: LogSpec) -> list[str]:
    """Configured attributes that are known while a case runs, without the activity."""
    skip = {spec.activity, *spec.outcome_columns}
    return [n for n in dict.fromkeys((*spec.categorical, *spec.numeric)) if n in df.columns and n not in skip]


def discover(
    df: DataFrame,
    spec: LogSpec,
    attributes: Sequence[str] | None = None,
    kind: str = "none",
    k: int = 10,
    control_flow: Sequence[str] = (),
    bucket_of: Column | None = None,
    seed: int = 0,
    splits: Splits | None = None,
    encoding: Mapping[str, str] | None = None,
    keep: Sequence[str] | None = None,
    hashed: Callable[[Sequence[Column], int], Column] = mdp.key_hash,
) -> DecisionModel:
    """Discover states, actions and transition probabilities.

    ``attributes`` make up a state together with the last action. ``kind`` is
    one of :data:`eventloom.operators.abstraction.KINDS`; ``bucket_of`` is an
    expression over ``state_key`` for the kind ``bucket``. ``encoding`` is the
    role of each category in k-means. ``keep`` names the columns that the steps
    keep for :meth:`DecisionModel.describe`, all configured ones by default.

    The steps and the dictionary of their keys are staged here, the other tables
    when they are used. If two keys share a fingerprint, another one is tried;
    ``hashed`` takes the place of :func:`eventloom.operators.mdp.key_hash`.
    """
    if kind not in abstraction.KINDS:
        raise ValueError(f"unknown abstraction {kind!r}, one of {abstraction.KINDS}")
    attributes = list(attributes if attributes is not None else state_attributes(df, spec))
    splits = splits or find_splits(df, [spec.case], spec.order)
    cut = clean.cut_at_terminal(df, spec, spec.terminal_activities, splits)
    kept = keep if keep is not None else dict.fromkeys((*spec.categorical, *spec.numeric, *spec.outcome_columns))
    described = [n for n in dict.fromkeys([*kept, *attributes]) if n in df.columns]
    position = [n for n in (spec.case, *spec.order) if n not in described]
    rows = mdp.mdp_steps(cut, spec, attributes, splits)
    own = ("step", "last_action", "action", "state_key", *mdp.STATE_PRINT, *mdp.NEXT_PRINT)
    kept = [*map(col, [*position, *(n for n in described if n not in own)]), *own]
    if kind == "bucket" and bucket_of is None:
        raise ValueError("the bucket abstraction needs bucket_of")
    for salt in range(SALTS):
        steps = stage(mdp.with_fingerprints(rows, salt, hashed).select(*kept), "steps")
        dictionary = stage(mdp.key_dictionary(steps), "state-dictionary")
        if not mdp.has_collisions(dictionary):
            break
    else:
        raise RuntimeError(f"state keys share fingerprints with each of {SALTS} salts")

    def mapping(model: DecisionModel) -> DataFrame:
        return _mapping(df, model.unabstracted, model.numbered, attributes, kind, k, control_flow, bucket_of, seed, encoding)

    return DecisionModel(spec, steps, dictionary.drop("collides"), None if kind == "none" else mapping)


def _mapping(
    df: DataFrame,
    states: DataFrame,
    numbered: DataFrame,
    attributes: Sequence[str],
    kind: str,
    k: int,
    control_flow: Sequence[str],
    bucket_of: Column | None,
    seed: int,
    encoding: Mapping[str, str] | None,
) -> DataFrame:
    if kind == "contextual":
        return abstraction.contextual(states)
    if kind == "bucket":
        return abstraction.bucket(states, bucket_of, control_flow)
    if kind == "structural":
        return abstraction.structural(numbered)
    if kind == "action-set":
        return abstraction.action_set(numbered, states)
    if kind == "action-count":
        return abstraction.action_count(numbered, states)
    numeric = [n for n in attributes if isinstance(df.schema[n].dataType, T.NumericType)]
    categorical = [n for n in attributes if n not in numeric]
    return abstraction.k_means(states, k, numeric, categorical, control_flow, kind == "partial_k_means", seed, encoding)
