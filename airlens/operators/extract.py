"""Nested reading extraction (struct fields, field-of-array, typed casts)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _measure_by_position(slot: int, expected: str) -> tuple[Column, Column]:
    types = F.col("sensordatavalues.value_type")
    values = F.col("sensordatavalues.value")
    # get() is NULL past the end of the array instead of raising under ANSI.
    return F.get(values, slot), F.get(types, slot) == F.lit(expected)


def _measure_by_name(name: str) -> tuple[Column, Column]:
    hit = F.get(F.filter(F.col("sensordatavalues"), lambda v: v["value_type"] == F.lit(name)), 0)
    return hit["value"], hit.isNotNull()


def extract_readings(raw: DataFrame, match: str = "position", keep: Sequence[str] | None = None) -> DataFrame:
    """Flatten nested readings to (id, ts, country, latitude, longitude,
    sensor_id, date, P1, P2).

    ``match="position"`` keeps a reading only when slot 0 is P1 and slot 1 is
    P2 (the original behaviour); ``match="name"`` finds P1 and P2 anywhere in
    the list. Text that is not a number or a date becomes NULL (``try_cast``)
    and is dropped later by the cleaning step, never raising. With ``keep`` no reading is dropped: the columns of
    ``keep`` come first, and ``_ok`` tells whether the measures are listed as asked.
    """
    if match == "position":
        p1, ok1 = _measure_by_position(0, "P1")
        p2, ok2 = _measure_by_position(1, "P2")
    elif match == "name":
        p1, ok1 = _measure_by_name("P1")
        p2, ok2 = _measure_by_name("P2")
    else:
        raise ValueError(f"match must be 'position' or 'name', not {match!r}")
    source = raw.where(ok1 & ok2) if keep is None else raw.withColumn("_ok", F.coalesce(ok1 & ok2, F.lit(False)))
    return (source
            .select(
                *([] if keep is None else [*keep, "_ok"]),
                F.col("id").alias("id"),
                F.col("timestamp").try_cast("timestamp_ntz").alias("ts"),
                F.col("location.country").alias("country"),
                F.col("location.latitude").try_cast("double").alias("latitude"),
                F.col("location.longitude").try_cast("double").alias("longitude"),
                F.col("sensor.id").alias("sensor_id"),
                F.col("timestamp").try_cast("date").alias("date"),
                p1.try_cast("double").alias("P1"),
                p2.try_cast("double").alias("P2"),
            ))


EXTRACT_SQL = """
SELECT
    id                                                 AS id,
    try_cast(timestamp AS timestamp_ntz)               AS ts,
    location.country                                   AS country,
    try_cast(location.latitude AS double)              AS latitude,
    try_cast(location.longitude AS double)             AS longitude,
    sensor.id                                          AS sensor_id,
    try_cast(timestamp AS date)                        AS date,
    try_cast(get(sensordatavalues.value, 0) AS double) AS P1,
    try_cast(get(sensordatavalues.value, 1) AS double) AS P2
FROM {raw}
WHERE get(sensordatavalues.value_type, 0) = 'P1'
  AND get(sensordatavalues.value_type, 1) = 'P2'
"""


def extract_readings_sql(spark, raw: DataFrame) -> DataFrame:
    """The same positional extraction written as one SQL statement."""
    return spark.sql(EXTRACT_SQL, raw=raw)
