"""The driver's Parquet tables, mapped onto the reading model.

Role mapping (one event = one reading):

* ``events.event_id`` -> reading id, ``events.ts`` -> timestamp (its day is the
  reading date), ``events.user_id`` -> sensor id;
* ``events.value`` -> P1, the number ``k`` in ``events.props`` (JSON text) -> P2;
* ``embeddings`` dimensions 0 and 1 of the row with ``vec_id = user_id`` ->
  latitude and longitude; ``embeddings.label`` groups positions into regions;
* ``customer.c_nationkey`` of ``c_custkey = user_id`` -> the alpha2-style
  country code, and ``nation`` (+ ``region``) -> the country-code dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.schemas import EXTRACTED_COLUMNS, TABLES


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its known schema, so no footer is read while a query is built."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, label, latitude, longitude) from the first two embedding dimensions."""
    emb = load(spark, sf_dir, "embeddings")
    return emb.select("vec_id", "label",
                      F.get(F.col("embedding"), 0).cast("double").alias("latitude"),
                      F.get(F.col("embedding"), 1).cast("double").alias("longitude"))


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the events alone tell of a reading (id, ts, sensor_id, date, P1, P2)."""
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), "ts", F.col("user_id").alias("sensor_id"), F.to_date("ts").alias("date"),
        F.col("value").alias("P1"), F.get_json_object("props", "$.k").try_cast("double").alias("P2"))


def locate(readings: DataFrame, sf_dir: str) -> DataFrame:
    """Readings with the position and country of their sensor, in the order of ``EXTRACTED_COLUMNS``.

    Joins to ``embeddings`` and ``customer`` are left joins: a sensor without
    a position or a country keeps NULLs and is dropped by cleaning. Both
    tables grow with the data, so no broadcast is forced; the planner and AQE
    pick the strategy from their sizes.
    """
    spark = readings.sparkSession
    pos = positions(spark, sf_dir).select("vec_id", "latitude", "longitude")
    cust = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("country"))
    return (readings.join(pos, readings.sensor_id == pos.vec_id, "left")
                    .join(cust, readings.sensor_id == cust.c_custkey, "left").select(*EXTRACTED_COLUMNS))


def extracted_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat readings (id, ts, country, latitude, longitude, sensor_id, date, P1, P2), every event located.

    To dedupe or clean them, ``clean.dedupe_before_join`` and ``clean.clean_before_join`` take
    ``event_readings`` and ``locate`` instead: they join one row per sensor and day.
    """
    return locate(event_readings(spark, sf_dir), sf_dir)


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country-code dimension (alpha2Code, alpha3Code, englishShortName)
    from ``nation`` and ``region``."""
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
                  .select(F.col("n_nationkey").cast("string").alias("alpha2Code"),
                          F.col("n_name").alias("alpha3Code"),
                          F.concat(F.col("n_name"), F.lit(" ("), F.col("r_name"), F.lit(")"))
                           .alias("englishShortName")))


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written out as the nested JSON reading text and parsed back
    with the ``RAW`` schema (exercises the JSON path on the driver tables).

    Slot layout by event type: most types list P1 then P2; ``error`` lists P2
    first (dropped by positional matching, kept by name matching); ``signup``
    lists only P1 (dropped either way, without raising).
    """
    from airlens.schemas import RAW

    return raw_lines(spark, sf_dir).select(F.from_json("line", RAW).alias("r")).select("r.*")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line) the text that ``raw_readings`` parses."""
    ev = load(spark, sf_dir, "events")
    p1 = F.struct(F.lit("P1").alias("value_type"), F.col("value").cast("string").alias("value"))
    p2 = F.struct(F.lit("P2").alias("value_type"),
                  F.get_json_object("props", "$.k").alias("value"))
    values = (F.when(F.col("event_type") == "error", F.array(p2, p1))
               .when(F.col("event_type") == "signup", F.array(p1))
               .otherwise(F.array(p1, p2)))
    record = F.struct(
        F.col("event_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.struct(F.col("user_id").alias("id"),
                 F.lit("0.0").alias("latitude"), F.lit("0.0").alias("longitude"),
                 F.col("event_type").alias("country"),
                 F.lit(None).cast("string").alias("city")).alias("location"),
        F.struct(F.col("user_id").alias("id"),
                 F.struct(F.lit(None).cast("string").alias("name")).alias("sensor_type")).alias("sensor"),
        values.alias("sensordatavalues"))
    return ev.select(F.to_json(record).alias("line"))


def nested_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver tables as nested reading records (``RAW`` layout, numbers
    as text, P1 then P2), with the date for writing one folder per day."""
    ex = extracted_readings(spark, sf_dir)
    values = F.array(
        F.struct(F.lit("P1").alias("value_type"), F.col("P1").cast("string").alias("value")),
        F.struct(F.lit("P2").alias("value_type"), F.col("P2").cast("string").alias("value")))
    return ex.select(
        F.col("date"),
        F.col("id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.struct(F.col("sensor_id").alias("id"),
                 F.col("latitude").cast("string").alias("latitude"),
                 F.col("longitude").cast("string").alias("longitude"),
                 F.col("country"), F.lit(None).cast("string").alias("city")).alias("location"),
        F.struct(F.col("sensor_id").alias("id"),
                 F.struct(F.lit(None).cast("string").alias("name")).alias("sensor_type")).alias("sensor"),
        values.alias("sensordatavalues"))


def json_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nested_readings`` as JSON text, parsed back with the ``RAW`` schema:
    the reading source as the batch ingest sees it (timestamps to the second)."""
    from airlens.schemas import RAW

    nested = nested_readings(spark, sf_dir).drop("date")
    text = nested.select(F.to_json(F.struct(*nested.columns)).alias("line"))
    return text.select(F.from_json("line", RAW).alias("r")).select("r.*")
