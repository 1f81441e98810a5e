"""Run summaries: equal to the window form, in any grouping, and after daily updates."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from airlens.operators import run_state, runs
from airlens.plans import catalog, stored
from airlens.sources import sinks
from tests.conftest import SF_SMALL

DAY0 = dt.date(2020, 2, 20)
SCHEMA = "entity string, date date, LowIndex int"


def random_days(seed, entities=12, days=150):
    rnd = random.Random(seed)
    rows = []
    for e in range(entities):
        seen, good = rnd.choice([0.05, 0.5, 0.97, 1.0]), rnd.choice([0.0, 0.3, 0.9, 1.0])
        rows += [(f"e{e}" if e else None, DAY0 + dt.timedelta(d), int(rnd.random() < good)) for d in range(days) if rnd.random() < seen]
    return rows


def summary(days, gap):
    """The state of one entity by its definition."""
    days = sorted(days)
    runs_, now, last = [], 0, None
    for day, good in days:
        broken = gap == "calendar" and last is not None and day != last + dt.timedelta(1)
        if broken or not good:
            runs_.append(now)
            now = 0
            if broken:
                runs_.append(0)
        now += good
        last = day
    runs_.append(now)
    first_break = next((i for i, (day, good) in enumerate(days) if not good or (
        gap == "calendar" and i and day != days[i - 1][0] + dt.timedelta(1))), len(days))
    back = 0
    for i in range(len(days) - 1, -1, -1):
        if not days[i][1] or (gap == "calendar" and i < len(days) - 1 and days[i + 1][0] != days[i][0] + dt.timedelta(1)):
            break
        back += 1
    return days[0][0], days[-1][0], len(days), first_break, back, max(runs_), first_break == len(days)


def by_entity(df):
    return {r.entity: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("gap", ["rows", "calendar"])
@pytest.mark.parametrize("spans", [(32, 1024), (1, 2), (7,)])
def test_summaries_equal_definition_and_windows(spark, monkeypatch, gap, spans):
    monkeypatch.setattr(run_state, "SPANS", spans)
    rows = random_days(sum(spans))
    daily = spark.createDataFrame(rows, SCHEMA).repartition(4)
    state = run_state.run_summaries(daily, ["entity"], gap=gap)
    got = by_entity(state)
    want = {}
    for e, day, good in rows:
        want.setdefault(e, []).append((day, good))
    assert got == {e: summary(days, gap) for e, days in want.items()}
    windows = runs.max_runs(runs.runs(daily, ["entity"], gap=gap), ["entity"]).collect()
    assert run_state.max_runs(state, ["entity"]).collect() == windows


@pytest.mark.parametrize("gap", ["rows", "calendar"])
def test_daily_updates_equal_the_whole(spark, gap):
    rows = random_days(4, entities=8, days=40)
    daily = spark.createDataFrame(rows, SCHEMA)
    cuts = [DAY0 + dt.timedelta(d) for d in (0, 11, 12, 30, 40)]
    state = run_state.run_summaries(daily.where(F.col("date") < F.lit(cuts[0])), ["entity"], gap=gap)
    for a, b in zip(cuts[:-1], cuts[1:]):
        new = daily.where((F.col("date") >= F.lit(a)) & (F.col("date") < F.lit(b)))
        state = spark.createDataFrame(run_state.advance(state, new, ["entity"], gap=gap).collect(), "entity string, " + run_state.STATE)
    assert by_entity(state) == by_entity(run_state.run_summaries(daily, ["entity"], gap=gap))
    assert {r.entity: r.current_streak for r in run_state.open_runs(state, ["entity"]).collect()} == \
        {e: s[4] for e, s in by_entity(state).items()}


def test_late_day_is_an_error(spark):
    daily = spark.createDataFrame([("a", DAY0, 1), ("a", DAY0 + dt.timedelta(3), 1)], SCHEMA)
    state = run_state.run_summaries(daily, ["entity"])
    late = spark.createDataFrame([("a", DAY0 + dt.timedelta(2), 1)], SCHEMA)
    with pytest.raises(Exception, match="are in the state"):
        run_state.advance(state, late, ["entity"]).collect()


def test_empty_and_missing_days(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert run_state.run_summaries(none, ["entity"]).count() == 0
    odd = spark.createDataFrame([("a", None, 1), ("b", DAY0, None)], SCHEMA)
    assert by_entity(run_state.run_summaries(odd, ["entity"])) == {"b": (DAY0, DAY0, 1, 0, 0, 0, False)}
    state = run_state.run_summaries(odd, ["entity"])
    assert by_entity(run_state.advance(state, none, ["entity"])) == by_entity(state)
    assert by_entity(run_state.advance(run_state.run_summaries(none, ["entity"]), odd, ["entity"])) == by_entity(state)
    with pytest.raises(ValueError):
        run_state.run_summaries(odd, ["entity"], gap="weeks").collect()


def test_several_keys(spark):
    rows = [(e, k, DAY0 + dt.timedelta(d), (d + k) % 3 > 0) for e in "ab" for k in (1, 2) for d in range(50)]
    daily = spark.createDataFrame([(e, k, d, int(g)) for e, k, d, g in rows], "entity string, k int, date date, LowIndex int")
    got = run_state.max_runs(run_state.run_summaries(daily, ["entity", "k"]), ["entity", "k"]).collect()
    assert got == runs.max_runs(runs.runs(daily, ["entity", "k"]), ["entity", "k"]).collect()


def test_no_window_and_no_history_in_an_update(spark, tmp_path):
    """The plan has no window; an update reads the files of one day."""
    import contextlib
    import glob
    import io
    path = str(tmp_path / "readings")
    sinks.write_curated(catalog.readings(spark, SF_SMALL), path)
    today = sinks.latest_day(spark, path)
    clean = sinks.read_curated(spark, path)
    before = runs.daily_flags(clean.where(F.col("date") < F.lit(today)), ["sensor_id"])
    run_state.run_summaries(before, ["sensor_id"]).write.parquet(str(tmp_path / "state"))
    for day in sinks.stored_days(spark, path):
        if day != today:
            for f in glob.glob(f"{path}/date={day}/*.parquet"):
                with open(f, "wb") as fh:
                    fh.write(b"no parquet")
    spark.catalog.clearCache()
    new = runs.daily_flags(sinks.read_curated(spark, path).where(F.col("date") == F.lit(today)), ["sensor_id"])
    out = run_state.max_runs(run_state.advance(spark.read.parquet(str(tmp_path / "state")), new, ["sensor_id"]), ["sensor_id"])
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        out.explain("formatted")
    assert "Window" not in said.getvalue() and "PartitionFilters: [" in said.getvalue()
    assert out.collect() == catalog.q_streak_max_by_sensor(spark, SF_SMALL).collect()


@pytest.mark.parametrize("name", ["streak_max_updated", "streak_max_calendar_updated"])
def test_registered_update(spark, name):
    whole = catalog.q_streak_max_by_sensor if name == "streak_max_updated" else catalog.q_streak_max_calendar
    assert stored.QUERIES[name](spark, SF_SMALL).collect() == whole(spark, SF_SMALL).collect()
