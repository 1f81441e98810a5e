"""Dimension enrichment: alpha2 country code -> alpha3 code and name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.operators.joins import unique_dimension


def join_country_codes(df: DataFrame, codes: DataFrame | None,
                       country: str = "country", check_unique: bool = True) -> DataFrame:
    """Replace ``country`` (alpha2) by its alpha3 code and add ``country_name``.

    Left join: an unknown code gives NULL for both. Without a code table
    (``codes is None``) the code itself is kept and copied into
    ``country_name``.
    """
    if codes is None:
        return df.withColumn("country_name", F.col(country))
    dim = codes.select(F.col("alpha2Code").alias("_alpha2"),
                       F.col("alpha3Code").alias("_alpha3"),
                       F.col("englishShortName").alias("_name"))
    if check_unique:
        dim = unique_dimension(dim, "_alpha2")
    cols = []
    for c in df.columns:
        if c == country:
            cols += [F.col("_alpha3").alias(country), F.col("_name").alias("country_name")]
        else:
            cols.append(F.col(c))
    return df.join(dim, F.col(country) == F.col("_alpha2"), "left").select(*cols)
