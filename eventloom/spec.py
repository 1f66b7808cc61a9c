"""Column roles and options of one event log."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class LogSpec:
    """What the columns of an event table mean.

    ``sequence`` breaks ties between events of one case with equal timestamps;
    (case, timestamp, sequence) must identify an event.
    """

    case: str = "case_id"
    activity: str = "activity"
    timestamp: str = "ts"
    sequence: str = "seq"

    static_categorical: tuple[str, ...] = ()
    static_numeric: tuple[str, ...] = ()
    dynamic_categorical: tuple[str, ...] = ()
    dynamic_numeric: tuple[str, ...] = ()
    #: known only once the case has ended; never part of a state by default
    outcome_columns: tuple[str, ...] = ("remaining_time_minutes", "execution_time_minutes")

    # reading
    rename: Mapping[str, str] = field(default_factory=dict)
    strip_prefix: str | None = None
    strip_text: str | None = None
    timestamp_formats: tuple[str, ...] = ()
    xes_case_attributes: Mapping[str, str] = field(default_factory=dict)
    xes_event_attributes: Mapping[str, str] = field(default_factory=dict)

    # cleaning
    complete_with: tuple[str, ...] = ()
    # fixed values: texts that stand for lost case ids and missing categories
    missing_case: str = "missing_caseid"
    missing_value: str = "missing"
    normalize_spellings: bool = False
    boolean_text: tuple[str, ...] = ()
    rare_threshold: int = 10
    rare_value: str = "other"
    group_rare_activity: bool = False
    with_open_cases: bool = False
    #: keep only the configured columns (and the case duration) in the result
    only_configured: bool = False

    # labelling and decision model
    label_activity: str | None = None
    terminal_activities: tuple[str, ...] = ()
    # fixed values: names of the added first and last action
    start_action: str = "start"
    end_action: str = "archive_application"

    # state table
    drop_before_discretize: tuple[str, ...] = ()
    sentinels: tuple[str, ...] = ()
    keep_as_category: tuple[str, ...] = ()

    @property
    def categorical(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.dynamic_categorical + self.static_categorical))

    @property
    def numeric(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.static_numeric + self.dynamic_numeric))

    @property
    def configured(self) -> tuple[str, ...]:
        """Static columns, the case, dynamic columns, the timestamp; each once."""
        return tuple(
            dict.fromkeys(
                self.static_categorical
                + self.static_numeric
                + (self.case,)
                + self.dynamic_categorical
                + self.dynamic_numeric
                + (self.timestamp, self.sequence)
            )
        )

    @property
    def order(self) -> tuple[str, str]:
        return (self.timestamp, self.sequence)

    def with_(self, **changes) -> LogSpec:
        return replace(self, **changes)
