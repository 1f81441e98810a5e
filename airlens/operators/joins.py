"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_dimension(df: DataFrame, key: str) -> DataFrame:
    """``df`` with one row per non-NULL ``key``; a repeated key (it would fan out a left join) is an error.

    The check is part of the plan: rows are grouped by the key and a count
    above one raises when the row is used, so no job runs while a query is
    built. How to join (broadcast or shuffle) is left to the planner, which
    knows the size in bytes. NULL keys never match and are dropped.
    """
    others = [c for c in df.columns if c != key]
    grouped = (df.where(F.col(key).isNotNull()).groupBy(key)
               .agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in others]))
    once = F.when(F.col("_n") == 1, F.col(key)).otherwise(F.raise_error(
        F.concat(F.lit(f"dimension key {key!r} is not unique: "), F.col(key).cast("string"))))
    return grouped.select(once.cast(df.schema[key].dataType).alias(key), *others)
