"""Clean readings: extract -> clean -> band -> enrich."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.functions.bands import pm_index
from airlens.operators.clean import DAY_KEY, clean_before_join, clean_readings
from airlens.operators.enrich import join_country_codes
from airlens.operators.extract import extract_readings
from airlens.schemas import CLEAN_COLUMNS
from airlens.sources import tables
from airlens.sources.json_readings import READINGS_GLOB, read_country_codes, read_readings


def add_index(df: DataFrame, p1: str = "P1", p2: str = "P2", out: str = "AQI") -> DataFrame:
    """Band P1 and P2 and keep the worse band as ``out``; drop P1 and P2."""
    return df.withColumn(out, pm_index(p1, p2)).drop(p1, p2)


def build_clean(extracted: DataFrame, codes: DataFrame | None,
                key: Sequence[str] = DAY_KEY, validate_first: bool = False) -> DataFrame:
    """Clean readings (country, country_name, latitude, longitude, sensor_id,
    date, AQI) from flat extracted readings."""
    return _finished(clean_readings(extracted, key=key, validate_first=validate_first), codes)


def _finished(cleaned: DataFrame, codes: DataFrame | None) -> DataFrame:
    return join_country_codes(add_index(cleaned), codes).select(*CLEAN_COLUMNS)


def build_from_tables(spark: SparkSession, sf_dir: str, key: Sequence[str] = DAY_KEY,
                      validate_first: bool = False) -> DataFrame:
    """The whole ingest from the driver's tables: events are reduced to one row per sensor and day (or instant)
    before they are joined to positions and countries."""
    cleaned = clean_before_join(tables.event_readings(spark, sf_dir), lambda df: tables.locate(df, sf_dir),
                                key=key, validate_first=validate_first)
    return _finished(cleaned, tables.country_codes(spark, sf_dir))


def build_from_json(spark: SparkSession, readings_path: str, codes_path: str | None,
                    match: str = "position", key: Sequence[str] = DAY_KEY,
                    validate_first: bool = False, glob: str | None = READINGS_GLOB) -> DataFrame:
    """The whole ingest from JSON files."""
    raw = read_readings(spark, readings_path, glob=glob)
    codes = read_country_codes(spark, codes_path)
    return build_clean(extract_readings(raw, match=match), codes, key, validate_first)


def profile(df: DataFrame, date: str = "date") -> DataFrame:
    """One pass: (rows, first_date, last_date)."""
    return df.agg(F.count("*").alias("rows"), F.min(date).alias("first_date"),
                  F.max(date).alias("last_date"))
