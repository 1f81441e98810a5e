"""Rankings of the latest day open only the folders of the days they compare."""

import contextlib
import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from airlens.operators import delta
from airlens.plans import catalog
from airlens.sources import sinks
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curated") / "readings")
    sinks.write_curated(catalog.readings(spark, SF_SMALL), path)
    return path


@contextlib.contextmanager
def plain_plans(spark):
    """Without adaptive execution the executed plan holds the scans and their figures."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def files_read(df) -> int:
    df.collect()
    scans, nodes = [], [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("Scan parquet"):
            scans.append(node.metrics().apply("numFiles").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return sum(scans)


def files_of(path, *days):
    return sum(len(glob.glob(f"{path}/date={d}/*.parquet")) for d in days)


def test_days_of_a_stored_table(spark, stored, tmp_path):
    days = [r.date for r in sinks.read_curated(spark, stored).select("date").distinct().collect()]
    assert sinks.stored_days(spark, stored) == sorted(days)
    assert sinks.latest_day(spark, stored) == max(days)
    assert sinks.latest_day(spark, str(tmp_path / "nothing")) is None


@pytest.mark.parametrize("ranking", [
    lambda df, **kw: delta.day_over_day(df, ["country", "country_name"], **kw),
    lambda df, **kw: delta.day_over_day(df, ["sensor_id"], require_both_days=True, **kw),
    lambda df, **kw: delta.level_on_day(df, ["country"], **kw)])
def test_latest_day_of_a_stored_table(spark, stored, ranking):
    """By subquery, by folder names, and from an unmarked table: the same rows."""
    clean = sinks.read_curated(spark, stored)
    assert delta.split_by_day(clean)
    unmarked = clean.withColumn("date", F.col("date") + F.expr("interval 0 days")).withColumn("date", F.col("date").cast("date"))
    assert not delta.split_by_day(unmarked)
    want = ranking(unmarked).collect()
    assert ranking(clean).collect() == want and want
    assert ranking(clean, as_of=sinks.latest_day(spark, stored)).collect() == want


def test_the_latest_day_of_a_filtered_table_is_its_own(spark, stored):
    clean = sinks.read_curated(spark, stored)
    last = sinks.latest_day(spark, stored)
    before = clean.where(F.col("date") < F.lit(last))
    assert delta.split_by_day(before)
    got = delta.level_on_day(before, ["country"]).collect()
    assert got == delta.level_on_day(clean, ["country"], as_of=before.agg(F.max("date")).first()[0]).collect() and got


def test_two_folders_are_read(spark, stored):
    clean = sinks.read_curated(spark, stored)
    today = sinks.latest_day(spark, stored)
    yesterday = today - dt.timedelta(days=1)
    total = files_of(stored, *sinks.stored_days(spark, stored))
    two, one = files_of(stored, today, yesterday), files_of(stored, today)
    assert 0 < one < two < total
    with plain_plans(spark):
        assert files_read(delta.day_over_day(clean, ["country"], ranked=False)) == two
        assert files_read(delta.day_over_day(clean, ["country"], as_of=today, ranked=False)) == two
        assert files_read(delta.level_on_day(clean, ["country"], ranked=False)) == one


def test_other_days_are_not_even_opened(spark, tmp_path):
    path = str(tmp_path / "readings")
    sinks.write_curated(catalog.readings(spark, SF_SMALL), path)
    clean, today = sinks.read_curated(spark, path), sinks.latest_day(spark, path)
    want = delta.day_over_day(clean, ["sensor_id"]).collect()
    for day in sinks.stored_days(spark, path):
        if day < today - dt.timedelta(days=1):
            for f in glob.glob(f"{path}/date={day}/*.parquet"):
                with open(f, "wb") as fh:
                    fh.write(b"no parquet")
    spark.catalog.clearCache()
    assert delta.day_over_day(sinks.read_curated(spark, path), ["sensor_id"], as_of=today).collect() == want
