"""Threshold banding of measurements into a 1..n index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from airlens.constants import PM10_THRESHOLDS, PM25_THRESHOLDS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(value: Column | str, thresholds: Sequence[float]) -> Column:
    """Band ``value`` against ascending, upper-inclusive ``thresholds``.

    Band i (1-based) holds values <= thresholds[i-1]; anything above the last
    threshold is band len(thresholds)+1. NULL (and NaN, which sorts above
    every number) stays NULL instead of falling into the top band.
    """
    if not thresholds:
        raise ValueError("thresholds must not be empty")
    if list(thresholds) != sorted(thresholds):
        raise ValueError("thresholds must be ascending")
    v = _col(value)
    expr = F.when(v.isNull() | F.isnan(v), F.lit(None).cast("int"))
    for i, t in enumerate(thresholds, start=1):
        expr = expr.when(v <= F.lit(t), F.lit(i))
    return expr.otherwise(F.lit(len(thresholds) + 1))


def composite_index(*bands: Column) -> Column:
    """Worst-of composite: the largest band, as int."""
    if len(bands) == 1:
        return bands[0].cast("int")
    return F.greatest(*bands).cast("int")


def pm_index(p1: Column | str = "P1", p2: Column | str = "P2") -> Column:
    """Composite index of a PM10 / PM2.5 pair."""
    return composite_index(band(p1, PM10_THRESHOLDS), band(p2, PM25_THRESHOLDS))
