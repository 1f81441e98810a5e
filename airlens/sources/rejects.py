"""The bad-record channel: lines that the ingest cannot use, with their text, file and reason.

Reading lines are read as text and parsed with the reading schema, so a line that is not JSON keeps its text
(``columnNameOfCorruptRecord``) and its file. ``checked_lines`` gives every line the first reason that applies:

* ``malformed``: no JSON object;
* ``measures``: the slots do not list P1 and P2 as the extraction asks;
* ``number``: a measure is missing or no number;
* ``timestamp``: no readable time;
* ``place``: no country, latitude or longitude.

Lines without one are the readings. Values out of range and repeated readings are no bad lines: the cleaning
drops them by rule. Blank lines are no lines, as for the JSON reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens.operators.extract import extract_readings
from airlens.schemas import INGEST
from airlens.sources.json_readings import READINGS_GLOB, InputError
from airlens.sources.paths import exists

REASONS = ("malformed", "measures", "number", "timestamp", "place")
CORRUPT = "_corrupt_line"


def read_lines(spark: SparkSession, path: str, glob: str | None = READINGS_GLOB) -> DataFrame:
    """(file, line) of every line of the reading files that is not blank."""
    if not any(c in path for c in "*?[{") and not exists(spark, path):
        raise InputError(f"no readings at {path}")
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")).where(F.trim("line") != "")


def _reason(match: str) -> Column:
    """The first reason against the extracted reading ``_e`` of a parsed line, null if there is none."""
    e = F.col("_e")
    return (F.when(F.col(f"_r.{CORRUPT}").isNotNull() | F.col("_r").isNull(), "malformed")
            .when(e.isNull(), "measures")
            .when(e["P1"].isNull() | e["P2"].isNull(), "number")
            .when(e["ts"].isNull() | e["date"].isNull(), "timestamp")
            .when(e["country"].isNull() | e["latitude"].isNull() | e["longitude"].isNull(), "place"))


def checked_lines(lines: DataFrame, match: str = "position") -> DataFrame:
    """(file, line, reason, reading): ``reading`` as ``extract_readings`` gives it, null for a bad line."""
    schema = T.StructType([*INGEST.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = lines.select("file", "line", F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_r"))
    extracted = extract_readings(parsed.select("*", "_r.*"), match, keep=["file", "line", "_r"])
    own = [c for c in extracted.columns if c not in ("file", "line", "_r", "_ok")]
    checked = extracted.select("file", "line", "_r", F.when(F.col("_ok"), F.struct(*own)).alias("_e")).withColumn("reason", _reason(match))
    return checked.select("file", "line", "reason", F.when(F.col("reason").isNull(), F.col("_e")).alias("reading"))


def rejected(checked: DataFrame) -> DataFrame:
    """(file, line, reason) of the bad lines."""
    return checked.where(F.col("reason").isNotNull()).select("file", "line", "reason")


def reject_counts(checked: DataFrame) -> DataFrame:
    """(file, lines, and one count per reason), from one pass."""
    return checked.groupBy("file").agg(F.count("*").alias("lines"), *[
        F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in REASONS])


def check_share(counts: DataFrame, most: float) -> None:
    """Raises ``InputError`` if more than the share ``most`` of all lines are bad."""
    bad = sum((F.col(r) for r in REASONS[1:]), F.col(REASONS[0]))
    lines, found = counts.agg(F.sum("lines"), F.sum(bad)).first()
    if lines and found > most * lines:
        raise InputError(f"{found} of {lines} lines are bad, more than the share {most}")
