"""Expressions over timestamps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.spec import col


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(60_000_000.0)


def minutes_since_midnight(ts: Column) -> Column:
    return (F.hour(ts) * 60 + F.minute(ts)).cast("long")


def calendar(ts: Column) -> dict[str, Column]:
    """Minutes since midnight, month, weekday (Monday is 0) and hour."""
    return {
        "timesincemidnight": minutes_since_midnight(ts),
        "month": F.month(ts).cast("long"),
        "weekday": F.weekday(ts).cast("long"),
        "hour": F.hour(ts).cast("long"),
    }


def parse_timestamp(text: Column, formats: Sequence[str] = ()) -> Column:
    """ISO text or one of ``formats``; null where nothing fits."""
    tries = [F.try_to_timestamp(text)]
    tries += [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(*tries)


# --- formats by evidence -------------------------------------------------------------
#
# The shape of a text has ``n`` for one or two digits, ``y`` for four, ``D`` for eight, ``f`` for a fraction
# of a second, ``b`` for the name of a month, ``p`` for a half of a day and ``z`` for a zone.

#: Date shapes and their patterns; of two, evidence in the column decides
DATES = {
    "y-n-n": ("yyyy-M-d",),
    "y/n/n": ("yyyy/M/d",),
    "y.n.n": ("yyyy.M.d",),
    "D": ("yyyyMMdd",),
    "n/n/y": ("M/d/yyyy", "d/M/yyyy"),
    "n-n-y": ("M-d-yyyy", "d-M-yyyy"),
    "n.n.y": ("M.d.yyyy", "d.M.yyyy"),
    "n b y": ("d MMM yyyy",),
    "n-b-y": ("d-MMM-yyyy",),
    "b n y": ("MMM d yyyy",),
    "b n, y": ("MMM d, yyyy",),
}
TIMES = {"": "", "n:n": "H:mm", "n:n:n": "H:mm:ss", "n:n:nf": "H:mm:ss.SSSSSS", "n:n p": "h:mm a", "n:n:n p": "h:mm:ss a"}
ZONES = {"": "", "z": "XXX", " z": " XXX"}
_MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
_DAYS = "mon|tue|wed|thu|fri|sat|sun"


def known_shapes() -> dict[str, tuple[str, ...]]:
    """Every shape that is read, with its patterns: dates with times and zones."""
    shapes = {}
    for date, patterns in DATES.items():
        for time, clock in TIMES.items():
            for zone, offset in ZONES.items():
                for between in (" ", "T") if time else ("",):
                    if zone and not time:
                        continue
                    mark = "'T'" if between == "T" else between
                    shapes[date + between + time + zone] = tuple(p + mark + clock + offset for p in patterns)
    return shapes


def _plain(text: Column) -> Column:
    """The text without what patterns do not tell apart: no day of the week, names of months in three letters, zones with a colon."""
    named = F.regexp_replace(F.trim(text), rf"(?i)\b({_MONTHS})[a-z]*\b", "$1")
    named = F.regexp_replace(named, rf"(?i)^(?:{_DAYS})[a-z]*,? +", "")
    named = F.regexp_replace(named, r"(?i)(\d) ?(am|pm)\b", "$1 $2")
    named = F.regexp_replace(named, r"(\d) ?(?:GMT|UTC|Z)$", "$1Z")
    named = F.regexp_replace(named, r"(:\d\d(?:\.\d+)?) ?([+-]\d\d):?(\d\d)$", "$1$2:$3")
    # six digits of a second are kept
    return F.regexp_replace(named, r"([:]\d\d\.\d{6})\d+", "$1")


def shape_of(plain: Column) -> Column:
    """The shape of a text, null for a null."""
    shape = F.regexp_replace(plain, r"(:\d\d(?:\.\d+)?(?: [aApP][mM])?)(?:Z|[+-]\d\d:\d\d)$", "$1\u0001")
    shape = F.regexp_replace(shape, rf"(?i)\b(?:{_MONTHS})\b", "\u0002")
    shape = F.regexp_replace(shape, r"(?i)\b(?:am|pm)\b", "\u0004")
    shape = F.regexp_replace(shape, r"(:\d\d)\.\d+", "$1\u0005")
    shape = F.regexp_replace(shape, r"(?<!\d)\d{8}(?!\d)", "\u0006")
    shape = F.regexp_replace(shape, r"(?<!\d)\d{4}(?!\d)", "\u0007")
    shape = F.regexp_replace(shape, r"(?<!\d)\d{1,2}(?!\d)", "n")
    return F.translate(shape, "\u0001\u0002\u0004\u0005\u0006\u0007", "zbpfDy")


@dataclass(frozen=True)
class TimestampFormats:
    """What a column's texts look like, and the patterns that were chosen."""

    column: str
    chosen: dict[str, tuple[str, ...]]  # shape to patterns, the first that fits counts
    shapes: DataFrame  # (shape, n, pattern, largest_first, largest_second), also of shapes that are not read

    def parse(self, text: Column) -> Column:
        """The timestamps; null where a text has no known shape or is no date."""
        plain = _plain(text)
        return F.coalesce(*self._tries(plain)) if self.chosen else F.lit(None).cast("timestamp")

    def _tries(self, plain: Column) -> list[Column]:
        shape = shape_of(plain)
        return [F.when(shape == s, F.coalesce(*[F.try_to_timestamp(plain, F.lit(p)) for p in patterns])) for s, patterns in sorted(self.chosen.items())]

    def apply(self, df: DataFrame, output: str | None = None) -> DataFrame:
        """``df`` with the column parsed, in its place or as ``output``."""
        return df.withColumn(output or self.column, self.parse(col(self.column)))


def infer_formats(df: DataFrame, column: str, day_first: bool = False) -> TimestampFormats:
    """Find out how the texts of a column write their timestamps.

    Texts are reduced to shapes, and these are counted. Where a shape may have the
    day or the month first, a number above 12 in one of the two places decides for all
    texts of the shape; with such numbers in both, or in none, ``day_first`` says
    which order is tried first, and a text that does not fit it is read in the other.
    Shapes that are not known stay in the report, and their texts are not read.
    """
    plain = _plain(col(column).cast("string"))
    # of a date of three numbers, the first and the second one
    numbers = [F.regexp_extract(plain, r"^(\d{1,2})[/.-](\d{1,2})[/.-]\d{4}", i).try_cast("int") for i in (1, 2)]
    rows = df.where(col(column).isNotNull()).select(shape_of(plain).alias("shape"), numbers[0].alias("first"), numbers[1].alias("second"))
    counted = rows.groupBy("shape").agg(
        F.count(F.lit(1)).alias("n"), F.max("first").alias("largest_first"), F.max("second").alias("largest_second")
    )
    known = known_shapes()
    chosen = {}
    # one row for each known shape at most
    for r in counted.where(F.col("shape").isin(*known)).collect():
        patterns = known[r["shape"]]
        if len(patterns) > 1:
            days = [r["largest_second"] is not None and r["largest_second"] > 12, r["largest_first"] is not None and r["largest_first"] > 12]
            swap = days[1] if days[0] != days[1] else day_first
            patterns = patterns[::-1] if swap else patterns
            if days[0] != days[1]:
                patterns = patterns[:1]
        chosen[r["shape"]] = patterns
    pattern = F.create_map(*[F.lit(x) for s, p in sorted(chosen.items()) for x in (s, p[0])]) if chosen else F.lit(None).cast(T.MapType(T.StringType(), T.StringType()))
    report = counted.select("shape", "n", F.try_element_at(pattern, F.col("shape")).alias("pattern"), "largest_first", "largest_second")
    return TimestampFormats(column, chosen, report)
