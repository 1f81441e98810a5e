"""Versions behind a pointer, and a curated table of which only changed days are written."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from airlens.operators import delta
from airlens.plans import catalog
from airlens.schemas import CLEAN_COLUMNS
from airlens.sources import incremental, versions
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def clean(spark):
    return catalog.readings(spark, SF_SMALL).persist()


def rows(df):
    return sorted(map(repr, df.select(*CLEAN_COLUMNS).collect()))


def version(spark, path, text):
    v = versions.new_version(path)
    os.makedirs(v)
    with open(f"{v}/data", "w") as fh:
        fh.write(text)
    return v


def seen(spark, path):
    with open(f"{versions.current(spark, path)}/data") as fh:
        return fh.read()


def test_readers_follow_the_pointer(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.current(spark, path) is None
    versions.switch(spark, path, version(spark, path, "one"))
    assert seen(spark, path) == "one"
    version(spark, path, "half writt")          # a writer that fails before the switch
    assert seen(spark, path) == "one"
    for k in range(12):
        versions.switch(spark, path, version(spark, path, f"v{k}"))
        assert seen(spark, path) == f"v{k}"
    versions.clean_up(spark, path)
    assert seen(spark, path) == "v11" and len(glob.glob(f"{path}/v-*")) == 2 and len(glob.glob(f"{path}/_current-*")) == 2
    versions.switch(spark, path, version(spark, path, "next"))
    assert seen(spark, path) == "next"


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.switch(spark, path, version(spark, path, "one"))
    before = versions._pointers(spark, path)
    versions.switch(spark, path, version(spark, path, "two"))
    monkeypatch.setattr(versions, "_pointers", lambda *a: before)      # a writer that looked earlier
    with pytest.raises(Exception):
        versions.switch(spark, path, version(spark, path, "three"))
    monkeypatch.undo()
    assert seen(spark, path) == "two"


def test_unchanged_and_late_readings(spark, clean, tmp_path):
    path = str(tmp_path / "curated")
    days = sorted(r.date for r in clean.select("date").distinct().collect())
    assert incremental.update(clean, path) == days
    assert rows(incremental.read(spark, path)) == rows(clean)
    stamp = versions.current(spark, path)
    assert incremental.update(clean.repartition(7), path) == [] and versions.current(spark, path) == stamp
    late = clean.union(clean.where(F.col("date") == F.lit(days[3])).limit(1).withColumn("sensor_id", F.lit(10**9)))
    assert incremental.update(late, path) == [days[3]]
    assert rows(incremental.read(spark, path)) == rows(late)
    new = late.union(late.limit(1).withColumn("date", F.lit(days[-1] + dt.timedelta(1))))
    assert incremental.update(new, path) == [days[-1] + dt.timedelta(1)]
    assert incremental.latest_day(spark, path) == days[-1] + dt.timedelta(1)
    fewer = new.where(F.col("date") != F.lit(days[0]))
    assert incremental.update(fewer, path) == [] and rows(incremental.read(spark, path)) == rows(fewer)
    # one row of one day changed its value only
    changed = fewer.withColumn("AQI", F.when((F.col("sensor_id") == 10**9), F.col("AQI") % 10 + 1).otherwise(F.col("AQI")))
    assert incremental.update(changed, path) == [days[3]] and rows(incremental.read(spark, path)) == rows(changed)


def test_equal_to_a_full_run(spark, clean, tmp_path):
    one, two = str(tmp_path / "a"), str(tmp_path / "b")
    cut = sorted(r.date for r in clean.select("date").distinct().collect())[10]
    incremental.update(clean.where(F.col("date") < F.lit(cut)), one)
    incremental.update(clean, one)
    incremental.update(clean, two)
    a, b = incremental.read(spark, one), incremental.read(spark, two)
    assert rows(a) == rows(b)
    assert delta.split_by_day(a)
    assert delta.day_over_day(a, ["country"]).collect() == delta.day_over_day(b, ["country"]).collect()


def test_failure_before_the_switch_keeps_the_old_table(spark, clean, tmp_path, monkeypatch):
    path = str(tmp_path / "curated")
    incremental.update(clean, path)
    before = rows(incremental.read(spark, path))

    def fail(*a):
        raise OSError("lost")

    monkeypatch.setattr(versions, "switch", fail)
    with pytest.raises(OSError):
        incremental.update(clean.where("sensor_id % 2 = 0"), path)
    monkeypatch.undo()
    assert rows(incremental.read(spark, path)) == before


def test_no_version_and_no_rows(spark, clean, tmp_path):
    with pytest.raises(FileNotFoundError):
        incremental.read(spark, str(tmp_path / "none"))
    path = str(tmp_path / "curated")
    assert incremental.update(clean.limit(0), path) == []
    assert incremental.latest_day(spark, path) is None
    incremental.update(clean, path)
    assert incremental.update(clean.limit(0), path) == []
    assert incremental.read(spark, path).count() == 0
