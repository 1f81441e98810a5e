"""DataFrame -> DataFrame operators, parameterised by column names."""

from airlens.operators import clean, delta, enrich, extract, joins, ranking, regions, runs

__all__ = ["clean", "delta", "enrich", "extract", "joins", "ranking", "regions", "runs"]
