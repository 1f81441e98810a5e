"""Mergeable summaries of runs of good days: the longest run of an entity without sorting its history.

A *summary* of an entity's days from ``first`` to ``last`` holds their number ``n``, the good days at their
beginning (``prefix``) and end (``suffix``), the longest good run (``longest``) and whether all of
them are one good run (``whole``). Two summaries of neighbouring spans give that of both, and the operation is
associative, so spans can be summed in any grouping:

* ``run_summaries`` merges days into spans of ``SPANS`` days, spans into longer ones, and those into one row per
  entity; no list is longer than the ratio of two spans and no task sorts a whole history.
* ``advance`` merges later days into stored summaries: a daily update reads the day and the state, not the history.

``gap="rows"`` counts observed days (a missing day does not end a run, as in ``runs.runs``),
``gap="calendar"`` calendar days. Rows without a day have no place in a span and are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = (32, 1024)       # days of the spans of each level
FIELDS = ("first", "last", "n", "prefix", "suffix", "longest", "whole")
STATE = "first date, last date, n int, prefix int, suffix int, longest int, whole boolean"


def _joins(left: Column, right: Column, gap: str) -> Column:
    """Whether a run can go on from the end of ``left`` to the beginning of ``right``."""
    if gap == "rows":
        return F.lit(True)
    if gap == "calendar":
        return F.date_add(left["last"], 1) == right["first"]
    raise ValueError(f"gap must be 'rows' or 'calendar', not {gap!r}")


def merged(left: Column, right: Column, gap: str = "rows") -> Column:
    """The summary of two neighbouring spans, ``left`` the earlier one."""
    on = _joins(left, right, gap)
    across = F.when(on, left["suffix"] + right["prefix"]).otherwise(F.lit(0))
    return F.struct(
        left["first"].alias("first"), right["last"].alias("last"), (left["n"] + right["n"]).alias("n"),
        F.when(left["whole"] & on, across).otherwise(left["prefix"]).alias("prefix"),
        F.when(right["whole"] & on, across).otherwise(right["suffix"]).alias("suffix"),
        F.greatest(left["longest"], right["longest"], across).alias("longest"),
        (left["whole"] & right["whole"] & on).alias("whole"))


def _of_days(daily: DataFrame, keys: Sequence[str], date: str, flag: str) -> DataFrame:
    """Each day of an entity as the summary of itself."""
    good = F.coalesce(F.col(flag), F.lit(0)).cast("int")
    own = F.struct(F.col(date).alias("first"), F.col(date).alias("last"), F.lit(1).alias("n"), good.alias("prefix"),
                   good.alias("suffix"), good.alias("longest"), (good == 1).alias("whole"))
    return daily.where(F.col(date).isNotNull()).select(*keys, own.cast(f"struct<{STATE.replace(' ', ':').replace(',:', ',')}>").alias("_s"))


def _level(spans: DataFrame, keys: Sequence[str], days: int | None, gap: str) -> DataFrame:
    """Neighbouring summaries of an entity merged: those of one span of ``days`` days, or all."""
    by = [] if days is None else [F.floor(F.unix_date(F.col("_s.first")) / days).alias("_span")]
    lists = spans.groupBy(*keys, *by).agg(F.sort_array(F.collect_list("_s")).alias("_l"))     # by the first day
    folded = F.reduce(F.slice("_l", F.lit(2), F.size("_l")), F.element_at("_l", 1), lambda a, b: merged(a, b, gap))
    return lists.select(*keys, folded.alias("_s"))


def run_summaries(daily: DataFrame, keys: Sequence[str], date: str = "date", flag: str = "LowIndex",
                  gap: str = "rows") -> DataFrame:
    """One row per entity (keys and the columns of ``STATE``) from ``runs.daily_flags``: one row per entity and day."""
    keys = list(keys)
    spans = _of_days(daily, keys, date, flag)
    for days in (*SPANS, None):
        spans = _level(spans, keys, days, gap)
    return spans.select(*keys, *[f"_s.{c}" for c in FIELDS])


def advance(state: DataFrame, daily: DataFrame, keys: Sequence[str], date: str = "date", flag: str = "LowIndex",
            gap: str = "rows") -> DataFrame:
    """``state`` with later days merged in: equal to ``run_summaries`` of all days.

    Entities seen in one of the two only are kept. The keys are matched null-safe. A day that is not
    after the entity's last day in the state is an error: its span has been summed up already.
    """
    keys = list(keys)
    new = run_summaries(daily, keys, date, flag, gap).select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*FIELDS).alias("_new"))
    old = state.select(*keys, F.struct(*FIELDS).alias("_old"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    both = old.join(new, same, "full")
    late = F.raise_error(F.concat(F.lit("days up to "), F.col("_old.last").cast("string"), F.lit(" are in the state, got "),
                                  F.col("_new.first").cast("string"))).cast(f"struct<{STATE.replace(' ', ':').replace(',:', ',')}>")
    value = (F.when(F.col("_new").isNull(), F.col("_old")).when(F.col("_old").isNull(), F.col("_new"))
             .when(F.col("_new.first") <= F.col("_old.last"), late).otherwise(merged(F.col("_old"), F.col("_new"), gap)))
    known = F.col("_old").isNotNull()
    return both.select(*[F.when(known, F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys], value.alias("_s")) \
        .select(*keys, *[f"_s.{c}" for c in FIELDS])


def max_runs(state: DataFrame, keys: Sequence[str], ranked: bool = True) -> DataFrame:
    """(keys, max_streak): what ``runs.max_runs`` gives."""
    res = state.select(*keys, F.col("longest").alias("max_streak"))
    return res.orderBy(F.col("max_streak").desc(), *keys) if ranked else res


def open_runs(state: DataFrame, keys: Sequence[str], date: str = "last") -> DataFrame:
    """(keys, last day, current_streak): good days up to each entity's last day."""
    return state.select(*keys, F.col("last").alias(date), F.col("suffix").alias("current_streak"))
