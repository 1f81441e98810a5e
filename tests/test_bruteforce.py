"""Randomised checks of the window and aggregate operators against plain
Python on small generated inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from airlens.operators import delta, runs

BASE = dt.date(2024, 1, 1)

days = st.lists(st.tuples(st.integers(0, 3),            # entity
                          st.integers(0, 14),           # day offset
                          st.integers(1, 10)),          # index value
                min_size=1, max_size=60)


def brute_runs(rows, gap):
    by = {}
    for e, d, v in rows:
        by.setdefault(e, {}).setdefault(d, []).append(v)
    out = {}
    for e, per in by.items():
        seq = sorted((d, 1 if sum(v) / len(v) <= 3 else 0) for d, v in per.items())
        lengths, cur, prev = [], 0, None
        for d, good in seq:
            broken = prev is not None and gap == "calendar" and d != prev + 1
            if good and not broken:
                cur += 1
            else:
                if cur:
                    lengths.append(cur)
                cur = 1 if good else 0
            prev = d
        if cur:
            lengths.append(cur)
        out[e] = sorted(lengths)
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=days, gap=st.sampled_from(["rows", "calendar"]))
def test_runs_match_bruteforce(spark, rows, gap):
    df = spark.createDataFrame([(e, BASE + dt.timedelta(days=d), v) for e, d, v in rows],
                               "entity int, date date, AQI int")
    ws = runs.runs(runs.daily_flags(df, ["entity"]), ["entity"], gap=gap)
    got = {}
    for r in ws.collect():
        got.setdefault(r.entity, [])
        if r.streak > 0:
            got[r.entity].append(r.streak)
    assert {e: sorted(v) for e, v in got.items()} == brute_runs(rows, gap)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=days, both=st.booleans())
def test_day_over_day_matches_bruteforce(spark, rows, both):
    df = spark.createDataFrame([(e, BASE + dt.timedelta(days=d), v) for e, d, v in rows],
                               "entity int, date date, AQI int")
    today = max(d for _, d, _ in rows)
    means = {}
    for e, d, v in rows:
        if d in (today, today - 1):
            means.setdefault((e, d), []).append(v)
    want = {}
    for e in {e for e, _ in means}:
        y = means.get((e, today - 1))
        t = means.get((e, today))
        if both and (y is None or t is None):
            continue
        want[e] = (sum(y) / len(y) if y else 0.0) - (sum(t) / len(t) if t else 0.0)
    got = {r.entity: r.AQI_improvement
           for r in delta.day_over_day(df, ["entity"], require_both_days=both).collect()}
    assert got.keys() == want.keys()
    for e in want:
        assert abs(got[e] - want[e]) < 1e-12


readings_rows = st.lists(st.tuples(st.integers(0, 2),     # sensor
                                   st.integers(0, 2),     # day
                                   st.integers(0, 1),     # position
                                   st.integers(0, 5),     # second of the day (ties on purpose)
                                   st.integers(1, 50)),   # measure
                         min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=readings_rows)
def test_dedupe_matches_bruteforce(spark, rows):
    from airlens.operators.clean import dedupe_first
    data = [(i, dt.datetime(2024, 1, 1 + d, 7, 0, s), sen, BASE + dt.timedelta(days=d), float(pos),
             float(v)) for i, (sen, d, pos, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, ts timestamp_ntz, sensor_id long, date date, "
                                     "latitude double, P1 double")
    want = {}
    for rid, ts, sen, day, pos, v in data:
        k = (sen, day, pos)
        if k not in want or (ts, rid) < (want[k][0], want[k][1]):
            want[k] = (ts, rid)
    got = {(r.sensor_id, r.date, r.latitude): (r.ts, r.id)
           for r in dedupe_first(df.repartition(3), key=("sensor_id", "date", "latitude")).collect()}
    assert got == want
