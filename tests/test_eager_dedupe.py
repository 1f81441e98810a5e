"""The dedupe reduced below the joins: same rows, and a hot sensor joins one row a day."""

import os
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airlens.operators import clean
from airlens.operators.clean import DAY_KEY, TIMESTAMP_KEY
from airlens.sources import tables
from tests.conftest import SF_CHECK

EVENTS = "id long, ts timestamp_ntz, sensor_id long, date date, P1 double, P2 double"
value = st.sampled_from([None, -1.0, 5.0, 20.0, 2000.0])
event = st.tuples(st.integers(1, 6) | st.none(), st.integers(0, 3), st.integers(0, 2), st.integers(1, 3) | st.none(), value, value)
position = st.tuples(st.integers(1, 4), st.sampled_from([None, 1.0, 2.0]), st.sampled_from([None, 7.0, 8.0]))
country = st.tuples(st.integers(1, 4), st.sampled_from([None, "A", "B"]))


def located(positions, countries):
    """A join to dimensions that repeat keys and hold nulls."""
    def locate(df):
        pos = positions.withColumnRenamed("vec_id", "p")
        own = countries.withColumnRenamed("c_custkey", "c")
        return (df.join(pos, df.sensor_id == pos.p, "left").join(own, df.sensor_id == own.c, "left")
                  .select("id", "ts", "country", "latitude", "longitude", "sensor_id", "date", "P1", "P2"))
    return locate


def rows(df):
    return sorted(map(repr, df.collect()))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, max_size=25), st.lists(position, max_size=6), st.lists(country, max_size=6))
def test_equals_the_join_first(spark, events, positions, countries):
    flat = spark.createDataFrame([(i, f"2024-01-0{d + 1} 0{h}:00:00", s, f"2024-01-0{d + 1}", a, b) for i, h, d, s, a, b in events],
                                 "id long, t string, sensor_id long, d string, P1 double, P2 double").selectExpr(
        "id", "CAST(t AS timestamp_ntz) AS ts", "sensor_id", "CAST(d AS date) AS date", "P1", "P2")
    locate = located(spark.createDataFrame(positions, "vec_id long, latitude double, longitude double"),
                     spark.createDataFrame(countries, "c_custkey long, country string"))
    for key in (DAY_KEY, TIMESTAMP_KEY):
        assert rows(clean.dedupe_before_join(flat, locate, key)) == rows(clean.dedupe_first(locate(flat), key))
        for first in (False, True):
            assert rows(clean.clean_before_join(flat, locate, key, first)) == rows(clean.clean_readings(locate(flat), key, first))


def test_the_join_must_be_on_the_key(spark):
    flat = spark.createDataFrame([], EVENTS)
    with pytest.raises(ValueError):
        clean.dedupe_before_join(flat, lambda df: df, by="id")


@pytest.fixture
def hot(spark, tmp_path):
    """The driver's tables with one sensor holding a third of all events; joins by shuffle, no skew handling."""
    for name in ("embeddings", "customer"):
        os.symlink(f"{SF_CHECK}/{name}.parquet", tmp_path / f"{name}.parquet")
    (tables.load(spark, SF_CHECK, "events").withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
     .repartition(16).write.parquet(str(tmp_path / "events.parquet")))
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16",
             "spark.sql.files.maxPartitionBytes": "64k"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield str(tmp_path)
    for k, v in old.items():
        spark.conf.set(k, v)


def rows_per_task(df):
    found = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    return max(found), statistics.median(found)


def test_a_hot_sensor_joins_one_row_a_day(spark, hot):
    events = tables.event_readings(spark, hot)
    total, days = events.count(), events.select("date").distinct().count()
    most, median = rows_per_task(tables.locate(events, hot))
    assert most > total / 3 and most > 3 * median            # every event joined: one task has the hot sensor
    few = clean.dedupe_first(events, ("sensor_id", "date"))
    assert few.where("sensor_id = 7").count() <= days
    most, median = rows_per_task(tables.locate(few, hot))
    assert most <= 3 * median
    most, median = rows_per_task(clean.dedupe_before_join(events, lambda df: tables.locate(df, hot)))
    assert most <= 3 * median
    assert rows(clean.dedupe_before_join(events, lambda df: tables.locate(df, hot))) == \
        rows(clean.dedupe_first(tables.extracted_readings(spark, hot)))
