"""What cleaning did to a log, counted in the pass that does it.

Counts are observed metrics: Spark adds them up while the rows go by, so a report
costs no scan of its own. They are known once the table they belong to was written.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "measure string, attribute string, n long"


def times(condition: Column) -> Column:
    """How often a condition holds."""
    return F.coalesce(F.sum(F.when(condition, F.lit(1).cast("long"))), F.lit(0).cast("long"))


class CleaningReport:
    """Measures of one run; hand a new one to :func:`eventloom.plans.preprocess.preprocess`."""

    def __init__(self) -> None:
        self._seen: list[tuple[Observation, list[tuple[str, str | None]]]] = []

    def watch(self, df: DataFrame, counts: Mapping[tuple[str, str | None], Column]) -> DataFrame:
        """``df``, whose rows are counted as they pass; keys are (measure, column or null)."""
        if not counts:
            return df
        observation, keys = Observation(), list(counts)
        self._seen.append((observation, keys))
        return df.observe(observation, *[counts[k].alias(f"m{i}") for i, k in enumerate(keys)])

    def table(self, spark: SparkSession) -> DataFrame:
        """(measure, attribute, n); waits for the tables that were watched."""
        rows = []
        for observation, keys in self._seen:
            values = observation.get
            rows += [(measure, attribute, values[f"m{i}"]) for i, (measure, attribute) in enumerate(keys)]
        return spark.createDataFrame(rows, SCHEMA)
