import datetime as dt

import pytest

from airlens.operators.delta import day_over_day, latest_date, level_on_day

D = dt.date


@pytest.fixture()
def readings(spark):
    rows = [("A", D(2024, 1, 1), 4), ("A", D(2024, 1, 1), 6), ("A", D(2024, 1, 2), 3),
            ("B", D(2024, 1, 1), 4),
            ("C", D(2024, 1, 2), 6),
            ("D", D(2024, 1, 1), 2), ("D", D(2024, 1, 2), 2),
            ("E", D(2023, 12, 31), 5)]
    return spark.createDataFrame(rows, "entity string, date date, AQI int")


def test_default_scores_and_order(readings):
    got = [(r.entity, r.AQI_improvement) for r in day_over_day(readings, ["entity"]).collect()]
    assert got == [("B", 4.0), ("A", 2.0), ("D", 0.0), ("C", -6.0)]


def test_require_both_days(readings):
    got = {r.entity: r.AQI_improvement
           for r in day_over_day(readings, ["entity"], require_both_days=True).collect()}
    assert got == {"A": 2.0, "D": 0.0}


def test_explicit_as_of_and_empty_yesterday(readings):
    # as of 2023-12-31: only E is seen (today), yesterday is empty
    got = {r.entity: r.AQI_improvement
           for r in day_over_day(readings, ["entity"], as_of="2023-12-31").collect()}
    assert got == {"E": -5.0}


def test_bad_date_literal_raises(readings):
    with pytest.raises(ValueError):
        day_over_day(readings, ["entity"], as_of="2024-13-45")


def test_latest_date_and_level(readings):
    assert readings.select(latest_date(readings)).first()[0] == D(2024, 1, 2)
    got = [(r.entity, r.avg_AQI) for r in level_on_day(readings, ["entity"]).collect()]
    assert got == [("C", 6.0), ("A", 3.0), ("D", 2.0)]


def test_ties_break_on_key(spark):
    rows = [("b", D(2024, 1, 1), 5), ("a", D(2024, 1, 1), 5), ("c", D(2024, 1, 2), 1)]
    df = spark.createDataFrame(rows, "entity string, date date, AQI int")
    assert [r.entity for r in day_over_day(df, ["entity"]).collect()] == ["a", "b", "c"]


def test_explicit_previous_day(readings):
    # 2023-12-31 vs 2024-01-02: only E (previous) and A, C, D (today)
    got = {r.entity: r.AQI_improvement
           for r in day_over_day(readings, ["entity"], previous="2023-12-31").collect()}
    assert got == {"E": 5.0, "A": -3.0, "C": -6.0, "D": -2.0}
