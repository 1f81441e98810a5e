"""Registered queries over tables that the library has written itself, from all rows of the driver's tables.

Each writes its table to the shared folder of the cluster (``spark.checkpoint.dir``) while it is
built and then runs on what is stored, as a user of the batch job would the next day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.operators import delta, run_state, runs
from airlens.plans import catalog
from airlens.sources import incremental, sinks
from airlens.sources.paths import shared_folder


def curated(spark: SparkSession, sf: str) -> str:
    """Folder of the clean readings, partitioned by day."""
    path = shared_folder(spark, "readings")
    sinks.write_curated(catalog.readings(spark, sf), path)
    return path


def q_curated_improve_by_country(spark: SparkSession, sf: str) -> DataFrame:
    """Today and yesterday from the names of the stored days: the scan opens two folders."""
    path = curated(spark, sf)
    return delta.day_over_day(sinks.read_curated(spark, path), ["country", "country_name"], as_of=sinks.latest_day(spark, path))


def q_curated_worst_today(spark: SparkSession, sf: str) -> DataFrame:
    """The latest day by a subquery over the partition values; the scan opens its folder only."""
    return delta.level_on_day(sinks.read_curated(spark, curated(spark, sf)), ["country"])


def _streaks_by_update(spark: SparkSession, sf: str, gap: str) -> DataFrame:
    """Summaries of all days but the last are stored; the last day is merged into them."""
    path = curated(spark, sf)
    clean, today = sinks.read_curated(spark, path), sinks.latest_day(spark, path)
    history = clean.where(F.col("date") < F.lit(today)) if today else clean
    state = shared_folder(spark, "run-state")
    run_state.run_summaries(runs.daily_flags(history, ["sensor_id"]), ["sensor_id"], gap=gap).write.parquet(state)
    new = runs.daily_flags(clean.where(F.col("date") == F.lit(today)), ["sensor_id"])
    return run_state.max_runs(run_state.advance(spark.read.parquet(state), new, ["sensor_id"], gap=gap), ["sensor_id"])


def q_streak_max_updated(spark: SparkSession, sf: str) -> DataFrame:
    return _streaks_by_update(spark, sf, "rows")


def q_streak_max_calendar_updated(spark: SparkSession, sf: str) -> DataFrame:
    return _streaks_by_update(spark, sf, "calendar")


def q_readings_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The curated table after two runs: all days but the last, then all of them, which writes the last day only."""
    clean, path = catalog.readings(spark, sf), shared_folder(spark, "incremental")
    incremental.update(clean.where(F.col("date") < delta.latest_date(clean)), path)
    incremental.update(clean, path)
    return incremental.read(spark, path)


QUERIES = {
    "readings_incremental": q_readings_incremental,
    "streak_max_updated": q_streak_max_updated,
    "streak_max_calendar_updated": q_streak_max_calendar_updated,
    "curated_improve_by_country": q_curated_improve_by_country,
    "curated_worst_today": q_curated_worst_today,
}
