"""JSON sources: nested readings (JSON lines) and the country-code array."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airlens.schemas import CODES, INGEST
from airlens.sources.paths import exists

# day files, plain or compressed (sensors_20240101.json, sensors_20240101.json.gz, ...)
READINGS_GLOB = "sensors_*.json*"


class InputError(RuntimeError):
    """A source path is missing or holds no usable data."""


def read_readings(spark: SparkSession, path: str, glob: str | None = READINGS_GLOB,
                  schema=INGEST) -> DataFrame:
    """Scan a folder of JSON-lines readings with an explicit schema.

    No inference pass. The default ``INGEST`` schema holds only the fields
    the ingest uses, so the parser skips the others (pass ``RAW`` for every
    field). ``glob`` keeps other files in the folder (such as the
    country-code array) out of the scan. Malformed lines give NULL fields and
    are dropped by extraction and cleaning. Raises ``InputError`` for a
    missing path (never exits the process).
    """
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if not any(c in path for c in "*?[{") and not exists(spark, path):
        raise InputError(f"no readings at {path}")
    return reader.json(path)


def read_country_codes(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The multi-line JSON array of country codes, or ``None`` if no path is
    given or nothing is there (the enrichment step then keeps the alpha2 code
    as the name). A file that cannot be read or parsed, or holds no code, is an error.
    """
    if not path or not exists(spark, path):
        return None
    df = spark.read.schema(CODES).option("multiLine", True).option("mode", "FAILFAST").json(path)
    if df.where("alpha2Code is not null").isEmpty():
        raise InputError(f"no country code in {path}")
    return df
