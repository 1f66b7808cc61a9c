"""Fixed bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_bins(value: Column, edges: Sequence[float], labels: Sequence[str], right: bool = True) -> Column:
    """Label of the bin between inner ``edges``; the outer bins are open-ended.

    With ``right`` a value on an edge belongs to the lower bin, else to the upper.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges")
    known = value.isNotNull() & ~F.isnan(value.cast("double"))
    result = None
    for edge, label in zip(edges, labels):
        below = known & ((value <= edge) if right else (value < edge))
        result = F.when(below, label) if result is None else result.when(below, label)
    last = labels[-1]
    return F.when(known, last) if result is None else result.when(known, last)
