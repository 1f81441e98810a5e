"""Runs of good days per entity (gaps-and-islands with window functions).

Pipeline: readings -> ``daily_flags`` (one row per entity and day) -> ``runs``
(run length on the last row of each good run) -> ``max_runs`` /
``run_histogram`` / ``run_bins`` / ``run_tiers`` / ``run_summary``.

The daily aggregate runs first, so every window partition holds one row per
observed day of one entity, however many readings that entity has. All three
windows are partitioned by the entity keys first, so a single hash exchange
serves them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlens.constants import DEFAULT_MAX_STREAK, GOOD_INDEX_LIMIT
from airlens.functions.presentation import streak_saturation, streak_tier
from airlens.operators.ranking import best


def daily_flags(df: DataFrame, keys: Sequence[str], date: str = "date",
                value: str = "AQI", limit: float = GOOD_INDEX_LIMIT,
                flag: str = "LowIndex", mean: str = "avg_AQI") -> DataFrame:
    """(keys, date, mean, flag): flag = 1 when the day's mean value <= ``limit``."""
    keys = list(keys)
    return (df.groupBy(*keys, date).agg(F.avg(value).alias(mean))
              .withColumn(flag, F.when(F.col(mean) <= F.lit(limit), F.lit(1)).otherwise(F.lit(0))))


def runs(daily: DataFrame, keys: Sequence[str], date: str = "date",
         flag: str = "LowIndex", gap: str = "rows") -> DataFrame:
    """Add ``next_<flag>``, ``grp`` and ``streak``.

    ``streak`` is the length of a good run on the run's last row and 0 on
    every other row. ``gap="rows"`` counts observed rows (a missing day does
    not break a run, as in the original); ``gap="calendar"`` counts calendar
    days (a missing day ends the run).

    ``grp`` is the island id of the classic gaps-and-islands form: the row
    number within the entity minus the row number within (entity, flag) (in
    calendar mode the day number minus the latter). Every window function
    here uses the one spec (entity ORDER BY date): the row number within
    (entity, flag) is a running count of the flag, and the position inside a
    run is the row number minus a running max of run-start row numbers. So
    each entity's days are sorted once, not once per window spec.
    """
    keys = list(keys)
    d, f = F.col(date), F.col(flag)
    w = Window.partitionBy(*keys).orderBy(date)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nxt = f"next_{flag}"
    out = (daily
           .withColumn("_rn", F.row_number().over(w))
           .withColumn(nxt, F.lead(flag, 1).over(w))
           .withColumn("_prev", F.lag(flag, 1).over(w))
           .withColumn("_rn_flag", F.when(f == 1, F.sum(f).over(upto))
                                    .otherwise(F.sum(F.lit(1) - f).over(upto)).cast("int")))
    if gap == "rows":
        out = out.withColumn("grp", F.col("_rn") - F.col("_rn_flag"))
        starts = F.col("_prev").isNull() | (F.col("_prev") != f)
        continues = f == F.col(nxt)
    elif gap == "calendar":
        day_no = F.datediff(d, F.lit("1970-01-01").cast("date"))
        out = (out.withColumn("grp", day_no - F.col("_rn_flag"))
                  .withColumn("_prev_date", F.lag(date, 1).over(w))
                  .withColumn("_next_date", F.lead(date, 1).over(w)))
        starts = (F.col("_prev").isNull() | (F.col("_prev") != f)
                  | (F.col("_prev_date") != F.date_sub(d, 1)))
        continues = (f == F.col(nxt)) & (F.col("_next_date") == F.date_add(d, 1))
    else:
        raise ValueError(f"gap must be 'rows' or 'calendar', not {gap!r}")
    out = (out.withColumn("_start", F.when(starts, F.col("_rn")))
              .withColumn("_pos", F.col("_rn") - F.max("_start").over(upto) + F.lit(1)))
    # Three-valued logic: on an entity's last row next is NULL, the condition
    # is NULL, and the row falls through to emit its run length.
    streak = F.when((f == 0) | continues, F.lit(0)).otherwise(F.col("_pos")).cast("int")
    return (out.withColumn("streak", streak)
               .drop("_rn", "_prev", "_rn_flag", "_prev_date", "_next_date", "_start", "_pos"))


def max_runs(with_streak: DataFrame, keys: Sequence[str], ranked: bool = True) -> DataFrame:
    """Longest good run per entity (0 when it never had a good day)."""
    keys = list(keys)
    res = with_streak.groupBy(*keys).agg(F.max("streak").alias("max_streak"))
    if ranked:
        res = res.orderBy(F.col("max_streak").desc(), *keys)
    return res


def streak_tables(df: DataFrame, keys: Sequence[str], date: str = "date", value: str = "AQI",
                  limit: float = GOOD_INDEX_LIMIT, gap: str = "rows") -> tuple[DataFrame, DataFrame]:
    """Readings -> (run series, longest run per entity, best first)."""
    with_streak = runs(daily_flags(df, keys, date, value, limit), keys, date, gap=gap)
    return with_streak, max_runs(with_streak, keys)


def _run_counts(with_streak: DataFrame, by: Sequence[str]) -> DataFrame:
    return (with_streak.where(F.col("streak") > 0)
            .groupBy(*by, "streak").agg(F.count("*").alias("count")))


def run_histogram(with_streak: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of good runs per run length (optionally per ``by``), sorted."""
    by = list(by)
    return _run_counts(with_streak, by).orderBy(*by, "streak")


def _filled(per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Unit bins 0..``_max`` from (keys, _max, _counts: run length -> count)."""
    return (per_key.select(*keys, "_counts", F.explode(F.sequence(F.lit(0), F.col("_max"))).alias("streak"))
            .select(*keys, "streak", F.coalesce(F.try_element_at("_counts", F.col("streak")), F.lit(0))
                    .cast("long").alias("count")))


def _count_map() -> list[Column]:
    entries = F.map_from_entries(F.collect_list(F.when(F.col("streak") > 0, F.struct("streak", "count"))))
    return [F.max("streak").alias("_max"), entries.alias("_counts")]


def run_bins(with_streak: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Zero-filled unit bins 0..max run length per entity: (keys, streak, count).

    Entities without a good run have no bins (their histogram is empty). The
    counts of an entity become one map (at most one entry per run length), so
    the runs are computed once.
    """
    keys = list(keys)
    return _filled(_run_counts(with_streak, keys).groupBy(*keys).agg(*_count_map()), keys)


def best_entity_bins(with_streak: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``run_bins`` of the entity with the longest run (ties: the smallest key), picked before binning."""
    keys = list(keys)
    counts = with_streak.groupBy(*keys, "streak").agg(F.count("*").alias("count"))
    top = best(counts.groupBy(*keys).agg(*_count_map()), "_max", keys)
    return _filled(top.where(F.col("_max") > 0), keys)


def histogram_text(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per entity with its histogram as text ``len:count,...`` sorted
    by length (bounded by the number of distinct run lengths <= days)."""
    keys = list(keys)
    pairs = F.sort_array(F.collect_list(F.struct("streak", "count")))
    return hist.groupBy(*keys).agg(
        F.array_join(F.transform(pairs, lambda p: F.concat_ws(":", p["streak"].cast("string"),
                                                                p["count"].cast("string"))),
                     ",").alias("histogram"),
        F.max("streak").alias("max_streak"))


def run_tiers(universe: DataFrame, with_streak: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of ``universe`` (one per entity, with or without runs) with max run, tier,
    saturation and histogram text. Entities without a good day are 'gray'."""
    keys = list(keys)
    per = histogram_text(_run_counts(with_streak, keys), keys)
    longest = F.coalesce(F.col("max_streak"), F.lit(0))
    return (universe.join(per, keys, "left")
            .select(*universe.columns, longest.alias("max_streak"),
                    streak_tier(F.col("max_streak")).alias("tier"),
                    streak_saturation(longest).alias("saturation"),
                    F.coalesce(F.col("histogram"), F.lit("")).alias("histogram")))


def overall_max_run(with_streak: DataFrame, default: int = DEFAULT_MAX_STREAK) -> DataFrame:
    """Longest run over all entities, ``default`` when no good run exists (axis length)."""
    return with_streak.where(F.col("streak") > 0).agg(
        F.coalesce(F.max("streak"), F.lit(default)).alias("max_streak_overall"))


def run_summary(with_streak: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """One row: number of days, entities, mean of the max run, entities good on
    every day, entities never good.

    One pass over the runs: grouping sets give a row per day and a row per
    entity; entities are counted per max run (at most one value per day).
    """
    keys = list(keys)
    rows = (with_streak.groupingSets([[F.col(k) for k in keys], [F.col(date)]], *keys, date)
            .agg(F.max("streak").alias("m"), F.grouping(F.col(date)).alias("is_entity")))
    m = F.when(F.col("is_entity") == 1, F.col("m"))
    counts = rows.groupBy("is_entity", m.alias("m")).agg(F.count("*").alias("n"))
    entity = F.col("is_entity") == 1
    n = F.when(entity, F.col("n"))
    one = counts.agg(F.coalesce(F.sum(F.when(~entity, F.col("n"))), F.lit(0)).alias("n_days"),
                     F.coalesce(F.sum(n), F.lit(0)).alias("n_entities"),
                     (F.sum(n * F.col("m")) / F.sum(n)).alias("mean_max_streak"),
                     F.map_from_entries(F.collect_list(F.when(entity, F.struct("m", "n")))).alias("_by"))
    of = lambda k: F.coalesce(F.try_element_at("_by", k), F.lit(0)).cast("long")
    return one.select("n_days", "n_entities", "mean_max_streak",
                      of(F.col("n_days").cast("int")).alias("n_full_window"), of(F.lit(0)).alias("n_never_good"))
