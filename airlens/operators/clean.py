"""Cleaning: deterministic dedupe, NULL drop, open-interval range filters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.constants import P1_BOUNDS, P2_BOUNDS

# Same sensor, same day, same position: one reading survives.
DAY_KEY = ("sensor_id", "date", "latitude", "longitude")
# Same sensor, same instant.
TIMESTAMP_KEY = ("sensor_id", "ts")
REQUIRED = ("latitude", "longitude", "P1", "P2", "date", "country")
BOUNDS = {"P1": P1_BOUNDS, "P2": P2_BOUNDS}


def dedupe_first(df: DataFrame, key: Sequence[str] = DAY_KEY,
                 order: Sequence[str] = ("ts", "id")) -> DataFrame:
    """Keep, per ``key``, the row that is smallest by ``order`` (then by the
    remaining columns, so the survivor never depends on partitioning).

    Written as an aggregate over a struct rather than a row_number window: the
    aggregate combines map-side, so a key holding a large share of all rows is
    reduced inside each map task before the shuffle instead of being sorted in
    one task.
    """
    key = list(key)
    order = [c for c in order if c not in key]
    rest = [c for c in df.columns if c not in key and c not in order]
    winner = F.min(F.struct(*order, *rest)).alias("_first")
    return (df.groupBy(*key).agg(winner)
              .select(*key, *[F.col(f"_first.{c}").alias(c) for c in order + rest])
              .select(*df.columns))


def _reduced(flat: DataFrame, key: Sequence[str], order: Sequence[str], by: str) -> DataFrame:
    """``flat`` reduced to the one row per own part of ``key`` that can win after any join on ``by``."""
    own = [c for c in key if c in flat.columns]
    if by not in own:
        raise ValueError(f"rows can only be reduced below a join on a column of the dedupe key, not on {by!r}")
    return dedupe_first(flat, own, order)


def dedupe_before_join(flat: DataFrame, locate: Callable[[DataFrame], DataFrame], key: Sequence[str] = DAY_KEY,
                       order: Sequence[str] = ("ts", "id"), by: str = "sensor_id") -> DataFrame:
    """``dedupe_first(locate(flat), key, order)`` with most of the work below the join (eager aggregation).

    ``locate`` joins ``flat`` to dimensions on ``by`` alone, a column of the key, so every
    row of an entity meets the same dimension rows, however many: whatever position of a key they
    bring, the first row of the entity's own part of the key (sensor and day) wins there. That
    part is reduced first, map-side, so an entity with a third of all rows enters the join as one row a
    day; the dedupe above settles repeated dimension rows and only sees what is left.
    """
    return dedupe_first(locate(_reduced(flat, key, order, by)), key, order)


def drop_incomplete(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """Drop rows with a NULL in any of ``columns``."""
    return df.dropna(subset=list(columns))


def within_bounds(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = BOUNDS) -> DataFrame:
    """Keep rows with low < value < high for every bounded column (NaN fails)."""
    cond = None
    for name, (lo, hi) in bounds.items():
        c = (F.col(name) > F.lit(lo)) & (F.col(name) < F.lit(hi))
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def clean_readings(df: DataFrame, key: Sequence[str] = DAY_KEY,
                   validate_first: bool = False,
                   required: Sequence[str] = REQUIRED,
                   bounds: Mapping[str, tuple[float, float]] = BOUNDS) -> DataFrame:
    """Dedupe, then drop incomplete and out-of-range rows.

    The default order (dedupe first) is the original behaviour: an invalid
    reading can win the dedupe and the valid one is lost with it.
    ``validate_first=True`` filters first so that a valid reading survives.
    """
    if validate_first:
        return dedupe_first(within_bounds(drop_incomplete(df, required), bounds), key)
    return within_bounds(drop_incomplete(dedupe_first(df, key), required), bounds)


def clean_before_join(flat: DataFrame, locate: Callable[[DataFrame], DataFrame], key: Sequence[str] = DAY_KEY,
                      validate_first: bool = False, required: Sequence[str] = REQUIRED,
                      bounds: Mapping[str, tuple[float, float]] = BOUNDS, by: str = "sensor_id") -> DataFrame:
    """``clean_readings(locate(flat), ...)`` with the dedupe reduced below the join (see ``dedupe_before_join``).

    With ``validate_first`` the columns at hand are checked below the join too; what the
    dimensions bring is the same for all rows of an entity, so checking it later changes no winner.
    """
    if validate_first:
        flat = within_bounds(drop_incomplete(flat, [c for c in required if c in flat.columns]), bounds)
    return clean_readings(locate(_reduced(flat, key, ("ts", "id"), by)), key, validate_first, required, bounds)
