"""Result sinks: every result is a Parquet table (charts and maps read them)."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens.schemas import CLEAN_COLUMNS, CURATED, PARTITION_MARK
from airlens.sources.paths import folders


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Overwrite ``path`` with ``df`` as Parquet (optionally partitioned)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_curated(df: DataFrame, path: str, date: str = "date",
                  cluster_by: tuple[str, ...] = ("sensor_id",)) -> None:
    """Write clean readings partitioned by day.

    A REBALANCE on the day groups rows by day so each task writes few files,
    while AQE splits a day that is much larger than the others over several
    tasks (a plain repartition by day would send a whole day to one task).
    Later day filters become partition pruning. Within a day, rows are
    sorted by ``cluster_by`` so Parquet row-group min/max statistics can
    skip data for filters on those columns.
    """
    order = [date, *[c for c in cluster_by if c in df.columns]]
    (df.hint("rebalance", date).sortWithinPartitions(*order)
       .write.mode("overwrite").partitionBy(date).parquet(path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _by_day(spark: SparkSession, path: str, columns: list[T.StructField], date: str = "date") -> DataFrame:
    """A table written by ``write_curated``: explicit schema (no partition type inference), ``date`` marked as partition."""
    df = spark.read.schema(T.StructType([*CURATED.fields, *columns])).parquet(path)
    marked = F.col(date).alias(date, metadata={PARTITION_MARK: True})
    return df.select(*[marked if c == date else c for c in CLEAN_COLUMNS], *[f.name for f in columns])


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    """The curated readings with their region."""
    return _by_day(spark, path, [T.StructField("cluster", T.IntegerType())])


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """The curated readings."""
    return _by_day(spark, path, [])


def stored_days(spark: SparkSession, path: str, date: str = "date") -> list[datetime.date]:
    """The days of a table partitioned by day, ascending, from the names of its folders: no file is opened.

    The writer makes a folder only for a day with rows; a folder of null days is left out.
    """
    found = [name.partition("=")[2] for name in folders(spark, path) if name.startswith(f"{date}=")]
    return sorted(datetime.date.fromisoformat(day) for day in found if day != "__HIVE_DEFAULT_PARTITION__")


def latest_day(spark: SparkSession, path: str, date: str = "date") -> datetime.date | None:
    """The last day of a table partitioned by day, None if it has none."""
    days = stored_days(spark, path, date)
    return days[-1] if days else None
