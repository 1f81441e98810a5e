"""Rankings with a total order (score, then key), top-k and best entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rank_desc(df: DataFrame, score: str, keys: Sequence[str]) -> DataFrame:
    """Sort by ``score`` descending; ``keys`` ascending break ties."""
    return df.orderBy(F.col(score).desc_nulls_last(), *[F.col(k).asc_nulls_first() for k in keys])


def top_k(df: DataFrame, score: str, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` best rows. Planned as TakeOrderedAndProject (per-partition
    top-k, then a k-row merge): no full sort of the input."""
    return rank_desc(df, score, keys).limit(k)


def best(df: DataFrame, score: str, keys: Sequence[str]) -> DataFrame:
    """The single best row (ties go to the smallest key)."""
    return top_k(df, score, keys, 1)
