import datetime as dt

import pytest

from airlens.operators import runs

D = dt.date
# entity A, January 2024: day -> mean index (day 7 missing)
A_DAYS = [(1, 2), (2, 3), (3, 4), (4, 1), (5, 1), (6, 1), (8, 2)]


@pytest.fixture()
def readings(spark):
    rows = [("A", D(2024, 1, d), m) for d, m in A_DAYS]
    rows += [("B", D(2024, 1, d), 9) for d in (1, 2, 3)]          # never good
    rows += [("C", D(2024, 1, 1), 9), ("C", D(2024, 1, 2), 1)]    # one good day
    return spark.createDataFrame(rows, "entity string, date date, AQI int")


def series(readings, gap="rows"):
    return runs.runs(runs.daily_flags(readings, ["entity"]), ["entity"], gap=gap)


def test_row_streaks_match_hand_table(readings):
    got = [(r.date.day, r.LowIndex, r.next_LowIndex, r.grp, r.streak)
           for r in series(readings).where("entity = 'A'").orderBy("date").collect()]
    assert got == [(1, 1, 1, 0, 0), (2, 1, 0, 0, 2), (3, 0, 1, 2, 0), (4, 1, 1, 1, 0),
                   (5, 1, 1, 1, 0), (6, 1, 1, 1, 0), (8, 1, None, 1, 4)]


def test_max_and_calendar_mode(readings):
    rows_mode = {r.entity: r.max_streak for r in runs.max_runs(series(readings), ["entity"]).collect()}
    cal_mode = {r.entity: r.max_streak
                for r in runs.max_runs(series(readings, "calendar"), ["entity"]).collect()}
    assert rows_mode == {"A": 4, "B": 0, "C": 1}
    assert cal_mode == {"A": 3, "B": 0, "C": 1}


def test_histograms(readings):
    ws = series(readings).where("entity = 'A'")
    assert [(r.streak, r["count"]) for r in runs.run_histogram(ws).collect()] == [(2, 1), (4, 1)]
    cal = series(readings, "calendar").where("entity = 'A'")
    assert [(r.streak, r["count"]) for r in runs.run_histogram(cal).collect()] == [(1, 1), (2, 1), (3, 1)]


def test_zero_filled_bins(readings):
    bins = runs.run_bins(series(readings), ["entity"]).where("entity = 'A'").orderBy("streak")
    assert [r["count"] for r in bins.collect()] == [0, 0, 1, 0, 1]
    assert runs.run_bins(series(readings), ["entity"]).where("entity = 'B'").count() == 0


def test_tiers_keep_every_entity(spark, readings):
    universe = spark.createDataFrame([("A",), ("B",), ("C",), ("Z",)], "entity string")
    got = {r.entity: (r.max_streak, r.tier, r.histogram)
           for r in runs.run_tiers(universe, series(readings), ["entity"]).collect()}
    assert got == {"A": (4, "orange", "2:1,4:1"), "B": (0, "gray", ""), "C": (1, "red", "1:1"),
                   "Z": (0, "gray", "")}


def test_summary_and_overall(readings):
    ws = series(readings)
    s = runs.run_summary(ws, ["entity"]).first()
    assert (s.n_days, s.n_entities, s.n_full_window, s.n_never_good) == (7, 3, 0, 1)
    assert s.mean_max_streak == pytest.approx(5 / 3)
    assert runs.overall_max_run(ws).first()[0] == 4
    assert runs.overall_max_run(ws.where("streak = 0")).first()[0] == 22


def test_good_days_equal_sum_of_runs(readings):
    ws = series(readings)
    good = ws.where("LowIndex = 1").count()
    total = sum(r.streak * r["count"] for r in runs.run_histogram(ws).collect())
    assert good == total


def test_repartitioning_does_not_change_runs(readings):
    a = sorted(map(tuple, series(readings).collect()), key=str)
    b = sorted(map(tuple, series(readings.repartition(5)).collect()), key=str)
    assert a == b


def test_streak_tables_pair(readings):
    ws, mx = runs.streak_tables(readings, ["entity"])
    assert ws.where("entity = 'A'").count() == 7
    assert [(r.entity, r.max_streak) for r in mx.collect()] == [("A", 4), ("C", 1), ("B", 0)]
