"""Temporal features of events and cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.time import calendar, minutes_between
from eventloom.operators.scan import GroupMax, GroupMin, Previous, RowNumber, RunningSum, ScanColumn, Splits
from eventloom.operators.scan import find_splits, ordered_scan
from eventloom.spec import LogSpec, col

# Names of the temporal features
FEATURES = ("timesincelastevent", "timesincecasestart", "remaining_time_minutes", "event_nr")


def with_calendar_features(df: DataFrame, spec: LogSpec) -> DataFrame:
    parts = calendar(col(spec.timestamp))
    kept = [col(n) for n in df.columns if n not in parts]
    return df.select(*kept, *[c.alias(n) for n, c in parts.items()])


def time_columns(spec: LogSpec) -> dict[str, ScanColumn]:
    """What :func:`derive_time_features` needs from a scan of the cases."""
    ts = col(spec.timestamp)
    return {
        "__previous_ts": Previous(ts),
        "__case_start": GroupMin(ts),
        "__case_end": GroupMax(ts),
        "event_nr": RowNumber(),
    }


def derive_time_features(scanned: DataFrame, spec: LogSpec) -> DataFrame:
    ts = col(spec.timestamp)
    since_last = F.coalesce(minutes_between(F.col("__previous_ts"), ts), F.lit(0.0))
    features = {
        "timesincelastevent": since_last,
        "timesincecasestart": minutes_between(F.col("__case_start"), ts),
        "remaining_time_minutes": minutes_between(ts, F.col("__case_end")),
        "event_nr": F.col("event_nr"),
    }
    helpers = {"__previous_ts", "__case_start", "__case_end", *features}
    kept = [col(n) for n in scanned.columns if n not in helpers]
    return scanned.select(*kept, *[c.alias(n) for n, c in features.items()])


def with_time_features(df: DataFrame, spec: LogSpec, splits: Splits | None = None) -> DataFrame:
    """Minutes since the last event and the case start, minutes to its end, event number."""
    df = df.select(*[col(n) for n in df.columns if n not in FEATURES])
    return derive_time_features(ordered_scan(df, [spec.case], spec.order, time_columns(spec), splits), spec)


def case_durations(df: DataFrame, spec: LogSpec) -> DataFrame:
    """One row per case: start, end and ``execution_time_minutes``."""
    ts = col(spec.timestamp)
    cases = df.groupBy(col(spec.case)).agg(F.min(ts).alias("start_time"), F.max(ts).alias("end_time"))
    return cases.withColumn("execution_time_minutes", minutes_between(F.col("start_time"), F.col("end_time")))


def with_case_duration(df: DataFrame, spec: LogSpec, splits: Splits | None = None) -> DataFrame:
    """The duration of its case at every event, without a join."""
    ts = col(spec.timestamp)
    scanned = ordered_scan(
        df, [spec.case], spec.order, {"__case_start": GroupMin(ts), "__case_end": GroupMax(ts)}, splits
    )
    duration = minutes_between(F.col("__case_start"), F.col("__case_end"))
    kept = [col(n) for n in df.columns if n != "execution_time_minutes"]
    return scanned.select(*kept, duration.alias("execution_time_minutes"))


def open_case_counts(df: DataFrame, spec: LogSpec) -> DataFrame:
    """(timestamp, open_cases) for each distinct event time.

    A case is open from its first event (included) to its last (excluded). With
    +1 at starts and -1 at ends, summed per instant first, the number of open
    cases is a running sum; no event is compared with a case.
    """
    ts = col(spec.timestamp)
    log = df.where(ts.isNotNull())
    marks = F.inline(
        F.array(
            F.struct(F.col("start_time").alias("at"), F.lit(1).alias("delta")),
            F.struct(F.col("end_time").alias("at"), F.lit(-1).alias("delta")),
        )
    )
    instants = log.select(ts.alias("at"), F.lit(0).alias("delta"))
    changes = case_durations(log, spec).select(marks).unionByName(instants)
    net = changes.groupBy("at").agg(F.sum("delta").alias("net"))
    # the log's own timestamps show where to cut; the sampling sinks below the distinct
    splits = find_splits(instants.select("at").distinct(), (), ("at",))
    running = ordered_scan(net, (), ("at",), {"open_cases": RunningSum(F.col("net"))}, splits)
    return running.select(F.col("at").alias(spec.timestamp), "open_cases")


def with_open_cases(df: DataFrame, spec: LogSpec, counts: DataFrame | None = None) -> DataFrame:
    """The number of cases that are open at each event.

    ``counts`` are those of :func:`open_case_counts` if they were taken already.
    """
    counts = open_case_counts(df, spec) if counts is None else counts
    counts = counts.withColumnRenamed(spec.timestamp, "__at")
    kept = [col(n) for n in df.columns if n != "open_cases"]
    return df.join(counts, col(spec.timestamp) == F.col("__at"), "left").select(*kept, "open_cases")


def activity_counts(df: DataFrame, spec: LogSpec) -> DataFrame:
    return df.groupBy(col(spec.activity).alias("activity")).agg(F.count(F.lit(1)).alias("n"))


def log_summary(df: DataFrame, spec: LogSpec) -> DataFrame:
    """One row: events, cases, columns."""
    per_case = df.groupBy(col(spec.case)).agg(F.count(F.lit(1)).alias("n"))
    return per_case.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
        F.count(col(spec.case)).alias("cases"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
    )
