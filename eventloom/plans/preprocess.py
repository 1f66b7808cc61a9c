"""From a raw log to a preprocessed event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions import missing as m
from eventloom.operators import clean, temporal
from eventloom.operators.scan import FillForward, Splits, find_splits, ordered_scan
from eventloom.plans.report import CleaningReport, times
from eventloom.spec import LogSpec, col
from eventloom.staging import stage

#: features that are numbers whether or not the configuration names them
FEATURES = ("timesincemidnight", "month", "weekday", "hour", *temporal.FEATURES)


def named(raw: DataFrame, spec: LogSpec) -> DataFrame:
    """Configured names, checked columns."""
    df = clean.strip_column_names(raw, text=spec.strip_text)
    df = clean.rename_columns(df, spec.rename)
    df = clean.strip_column_names(df, prefix=spec.strip_prefix)
    return clean.require_columns(df, (spec.case, spec.activity, spec.timestamp, spec.sequence))


def canonical(raw: DataFrame, spec: LogSpec) -> DataFrame:
    """Configured names, checked columns, repaired case ids."""
    return clean.nan_to_null(clean.repair_case_ids(named(raw, spec), spec))


def preprocess(raw: DataFrame, spec: LogSpec, report: CleaningReport | None = None) -> DataFrame:
    """Clean a log and add temporal features.

    Order: complete cases, selection, valid timestamps, calendar, one scan per
    case (temporal features, duration and forward fill), missing values, open
    cases, rare values. Case filter and scan share one exchange on the case.

    ``report`` counts what is read, repaired, dropped, filled, coerced and grouped,
    in the same pass; the result is then a staged table.
    """
    log = clean.parse_timestamps(canonical(raw, spec), spec, drop=False)
    splits = find_splits(log, [spec.case], spec.order)
    counts = None
    if spec.with_open_cases:
        # needs case and timestamp only: counted before the log gets wide
        kept = _kept(log, spec, splits, None)
        counts = stage(temporal.open_case_counts(kept.select(col(spec.case), col(spec.timestamp)), spec), "open-cases")
    if report is not None:
        read = report.watch(named(raw, spec), {("read", None): F.count(F.lit(1)), ("case ids repaired", spec.case): times(col(spec.case).isNull())})
        log = clean.parse_timestamps(clean.nan_to_null(clean.repair_case_ids(read, spec)), spec, drop=False)
    log = temporal.with_calendar_features(_kept(log, spec, splits, report), spec)

    fill = [n for n in dict.fromkeys((*spec.categorical, *spec.numeric)) if n in log.columns]
    scans = {
        **temporal.time_columns(spec),
        **{f"__filled_{i}": FillForward(col(n)) for i, n in enumerate(fill)},
    }
    scanned = ordered_scan(log, [spec.case], spec.order, scans, splits)
    filled = {n: F.col(f"__filled_{i}") for i, n in enumerate(fill)}
    if report is not None:
        scanned = report.watch(scanned, {("filled forward", n): times(col(n).isNull() & f.isNotNull()) for n, f in filled.items()})
    duration = temporal.minutes_between(F.col("__case_start"), F.col("__case_end"))
    log = scanned.select(
        *[filled.get(n, col(n)).alias(n) for n in scanned.columns if not n.startswith("__filled_")],
        duration.alias("execution_time_minutes"),
    )
    log = temporal.derive_time_features(log, spec)
    if report is not None:
        log = report.watch(log, _gaps(log, spec))
    log = fill_missing(log, spec)
    if counts is not None:
        log = temporal.with_open_cases(log, spec, counts)
    if spec.only_configured:
        log = clean.select_configured(log, spec, ["execution_time_minutes"])
    log = group_rare(log, spec, report)
    return log if report is None else stage(log, "preprocessed-log")


def _kept(log: DataFrame, spec: LogSpec, splits: Splits, report: CleaningReport | None) -> DataFrame:
    """Events of complete cases with a valid timestamp, configured columns."""
    valid = col(spec.timestamp).isNotNull()
    if spec.complete_with:
        log = clean.flag_complete_cases(log, spec, spec.complete_with, "__complete", splits)
        if report is not None:
            dropped = {("dropped, case not complete", None): times(~F.col("__complete")), ("dropped, no timestamp", None): times(F.col("__complete") & ~valid)}
            log = report.watch(log, dropped)
        log = log.where("__complete").drop("__complete")
    elif report is not None:
        log = report.watch(log, {("dropped, no timestamp", None): times(~valid)})
    return clean.select_configured(log, spec).where(valid)


def _gaps(log: DataFrame, spec: LogSpec) -> dict[tuple[str, str | None], Column]:
    """What :func:`fill_missing` will fill, and the texts that it takes for numbers in vain."""
    types = {f.name: f.dataType for f in log.schema}
    found: dict[tuple[str, str | None], Column] = {}
    for n in dict.fromkeys(spec.categorical):
        if n in types:
            found["filled with a category", n] = times(col(n).isNull())
    for n in dict.fromkeys(spec.numeric):
        if n in types:
            number = m.nan_to_null(m.to_number(col(n)))
            if isinstance(types[n], T.StringType):
                found["not a number", n] = times(col(n).isNotNull() & number.isNull())
            found["filled with a number", n] = times(number.isNull())
    return found


def label_outcomes(log: DataFrame, spec: LogSpec, cut: bool = False) -> DataFrame:
    """A preprocessed log with the outcome of each case: whether ``spec.label_activity`` occurs in it.

    With ``cut`` only the events before its first occurrence are kept.
    """
    if spec.label_activity is None:
        raise ValueError("the specification names no label_activity")
    return clean.label_cases(log, spec, spec.label_activity, cut)


def fill_missing(log: DataFrame, spec: LogSpec) -> DataFrame:
    """Categories: ``missing`` for null; numbers: 0 for null or unparseable."""
    log = clean.boolean_to_text(log, spec.boolean_text, spec.missing_value)
    log = clean.fill_categories(log, spec.categorical, spec.missing_value)
    if spec.normalize_spellings:
        log = clean.normalize_missing(log, spec.categorical, spec.missing_value)
    log = clean.coerce_numbers(log, spec.numeric)
    return clean.fill_numbers(log, (*spec.numeric, *FEATURES))


def group_rare(log: DataFrame, spec: LogSpec, report: CleaningReport | None = None) -> DataFrame:
    """Values of fewer than ``rare_threshold`` events become ``other``; activities only on request.

    The log is staged first: it is read by the counting and by the replacing.
    """
    names = [n for n in spec.categorical if n in log.columns and (spec.group_rare_activity or n != spec.activity)]
    if not names:
        return log
    log = stage(log, "log-before-rare")
    counts = clean.value_counts(log, names)
    if report is not None:
        rare = F.col("n") < spec.rare_threshold
        grouped = {("grouped as rare", n): F.coalesce(F.sum(F.when(rare & (F.col("attribute") == n), F.col("n"))), F.lit(0).cast("long")) for n in names}
        counts = report.watch(counts, grouped)
    frequent = stage(counts.where(F.col("n") >= spec.rare_threshold).select("attribute", "value"), "frequent-values", "attribute")
    return clean.group_rare_values(log, names, frequent, spec.rare_value)
