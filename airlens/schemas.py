"""Explicit schemas for the JSON inputs (no inference pass over the text)."""

from pyspark.sql import types as T

VALUE_ENTRY = T.StructType([
    T.StructField("value_type", T.StringType()),
    T.StructField("value", T.StringType()),
])

# One reading per JSON line. Coordinates and measurements are numeric text;
# every field may be missing.
RAW = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("location", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
    ])),
    T.StructField("sensor", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("sensor_type", T.StructType([
            T.StructField("name", T.StringType()),
        ])),
    ])),
    T.StructField("sensordatavalues", T.ArrayType(VALUE_ENTRY)),
])

# Only the fields the ingest uses. The JSON reader does not prune nested
# fields by itself (its ReadSchema keeps every field of ``RAW``); reading with
# this schema lets the parser skip the rest of each record.
INGEST = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("location", T.StructType([
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
        T.StructField("country", T.StringType()),
    ])),
    T.StructField("sensor", T.StructType([
        T.StructField("id", T.LongType()),
    ])),
    T.StructField("sensordatavalues", T.ArrayType(VALUE_ENTRY)),
])

# The country dimension: one JSON array of objects.
CODES = T.StructType([
    T.StructField("alpha2Code", T.StringType()),
    T.StructField("alpha3Code", T.StringType()),
    T.StructField("englishShortName", T.StringType()),
])

# Flat readings after extraction (id and ts are kept for the deterministic dedupe).
EXTRACTED_COLUMNS = ("id", "ts", "country", "latitude", "longitude",
                     "sensor_id", "date", "P1", "P2")

# Clean, banded, enriched readings.
CLEAN_COLUMNS = ("country", "country_name", "latitude", "longitude",
                 "sensor_id", "date", "AQI")

# Column metadata of a partition column: a filter on it chooses folders, its values cost no data.
PARTITION_MARK = "airlens.partition"

# The curated clean-readings table (partitioned by ``date``); read back with
# this schema so the partition column's type is never inferred.
CURATED = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("sensor_id", T.LongType()),
    T.StructField("AQI", T.IntegerType()),
    T.StructField("date", T.DateType()),
])

# The driver tables that queries read.
TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}
