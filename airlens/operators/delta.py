"""Day-over-day change per entity and the per-day level ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.functions.dates import as_date
from airlens.operators.ranking import rank_desc
from airlens.schemas import PARTITION_MARK


def latest_date(df: DataFrame, date: str = "date") -> Column:
    """max(date) as an in-plan scalar subquery (no driver round trip).

    On a table partitioned by day it reads partition values and file footers,
    no column; used in a filter on that table it prunes partitions at run time.
    ``sinks.latest_day`` finds the day of a stored table from its folders alone.
    """
    return df.select(F.max(date)).scalar()


def split_by_day(df: DataFrame, date: str = "date") -> bool:
    """Whether ``date`` is a partition column of the stored table under ``df`` (marked by the readers of ``sinks``)."""
    return bool(df.schema[date].metadata.get(PARTITION_MARK))


def on_days(df: DataFrame, date: str, today: Column, previous: Column | None = None) -> DataFrame:
    """The rows of ``today`` (and of ``previous``); on a table partitioned by day only those folders are read.

    A literal day prunes while the query is planned, a subquery (``latest_date``) when it runs.
    """
    d = F.col(date)
    return df.where(d == today if previous is None else d.isin(today, previous))


def _daily(df: DataFrame, keys: Sequence[str], date: str, value: str) -> tuple[DataFrame, Column]:
    """(one row per entity and day with the day's mean, the latest day), from one pass over ``df``.

    The latest day is a scalar subquery over the same small per-day aggregate. It reads all of
    its columns, so its plan is the main one's and Spark reuses the exchange instead of
    running the source again.
    """
    daily = df.groupBy(*keys, date).agg(F.avg(value).alias("_mean"))
    return daily, daily.select(F.max(F.struct(date, "_mean", *keys)).getField(date)).scalar()


def day_over_day(df: DataFrame, keys: Sequence[str], date: str = "date",
                 value: str = "AQI", as_of=None, out: str = "AQI_improvement",
                 require_both_days: bool = False, ranked: bool = True,
                 previous=None) -> DataFrame:
    """mean(value) on the ``previous`` day minus mean(value) on ``as_of``.

    Positive = the value went down (improved). ``as_of`` defaults to the
    latest date in ``df``; ``previous`` defaults to the calendar day before
    it ('yesterday'), even if that day has no rows; any earlier day can be
    given instead (e.g. a week before). Like the original, an entity seen on only one of
    the two days scores +mean (yesterday only) or -mean (today only);
    ``require_both_days=True`` keeps only entities seen on both days.

    With ``as_of``, or on a table partitioned by day, only the two days are read, and one grouping
    on ``keys`` with two conditional means replaces the original's (key, date) grouping
    followed by a signed sum: one shuffle and no self-join. Otherwise days are
    averaged first and the latest day is found in that small table.
    """
    keys = list(keys)
    d = F.col(date)
    if as_of is None and split_by_day(df, date):
        as_of = latest_date(df, date)
    if as_of is None:
        source, today = _daily(df, keys, date, value)
        value = "_mean"
    else:
        source, today = df, as_date(as_of)
    yesterday = F.date_sub(today, 1) if previous is None else as_date(previous)
    if as_of is not None:
        source = on_days(source, date, today, yesterday)
    per_key = source.groupBy(*keys).agg(
        F.avg(F.when(d == yesterday, F.col(value))).alias("_y"),
        F.avg(F.when(d == today, F.col(value))).alias("_t"))
    per_key = per_key.where(F.col("_y").isNotNull() | F.col("_t").isNotNull())
    if require_both_days:
        per_key = per_key.where(F.col("_y").isNotNull() & F.col("_t").isNotNull())
    res = per_key.select(*keys, (F.coalesce(F.col("_y"), F.lit(0.0))
                                 - F.coalesce(F.col("_t"), F.lit(0.0))).alias(out))
    return rank_desc(res, out, keys) if ranked else res


def level_on_day(df: DataFrame, keys: Sequence[str], date: str = "date",
                 value: str = "AQI", as_of=None, out: str = "avg_AQI",
                 ranked: bool = True) -> DataFrame:
    """mean(value) per entity on ``as_of`` (default: the latest date), worst first."""
    keys = list(keys)
    if as_of is None and split_by_day(df, date):
        as_of = latest_date(df, date)
    if as_of is None:
        daily, today = _daily(df, keys, date, value)
        res = daily.groupBy(*keys).agg(F.max(F.when(F.col(date) == today, F.struct("_mean"))).alias("_level")) \
            .where(F.col("_level").isNotNull()).select(*keys, F.col("_level._mean").alias(out))
    else:
        res = on_days(df, date, as_date(as_of)).groupBy(*keys).agg(F.avg(value).alias(out))
    return rank_desc(res, out, keys) if ranked else res
