"""The end-to-end job on a small multi-day JSON folder."""

import json

import pytest

from airlens.plans import job


# sensor: country, position, and per day the (P1, P2) of its readings
TABLE = {
    11: ("FR", 48.5, 2.5, [[(10, 8)], [(40, 20), (12, 9)], [(15, 10)], [(70, 44)], [(9, 4)]]),
    12: ("FR", 43.25, 5.5, [[(55, 30)], [(52, 31)], [], [(20, 15)], [(18, 12)]]),
    21: ("DE", 52.5, 13.5, [[(14, 9)], [(13, 9)], [(12, 8)], [(11, 7)], [(10, 6)]]),
    22: ("DE", 50.125, 8.75, [[(95, 65)], [(88, 60)], [(70, 50)], [(61, 42)], [(35, 25)]]),
    31: ("XX", -33.5, 151.25, [[(30, 20)], [(31, 21)], [(32, 22)], [], [(34, 24)]]),
    32: ("XX", -37.75, 145.0, [[(5, 3)], [(5, 3)], [(80, 55)], [(5, 3)], [(5, 3)]]),
}
N_ROWS = sum(len(day) for _, _, _, days in TABLE.values() for day in days)


def write_table(path):
    """TABLE as one JSON-lines file a day and a code array."""
    number = 0
    for d in range(5):
        lines = []
        for sensor, (country, lat, lon, days) in TABLE.items():
            for k, (p1, p2) in enumerate(days[d]):
                number += 1
                lines.append(json.dumps({
                    "id": number, "timestamp": f"2024-05-{d + 2:02d} {8 + 5 * k:02d}:30:00",
                    "location": {"id": sensor, "latitude": str(lat + k / 1000), "longitude": str(lon), "country": country},
                    "sensor": {"id": sensor},
                    "sensordatavalues": [{"value_type": "P1", "value": str(p1)}, {"value_type": "P2", "value": str(p2)}]}))
        (path / f"sensors_2024050{d + 2}.json").write_text("\n".join(lines))
    (path / "codes.json").write_text(json.dumps([
        {"alpha2Code": "FR", "alpha3Code": "FRA", "englishShortName": "France"},
        {"alpha2Code": "DE", "alpha3Code": "DEU", "englishShortName": "Germany"}]))


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    src = tmp_path_factory.mktemp("data")
    write_table(src)
    out = tmp_path_factory.mktemp("out")
    opts = job.JobOptions(out=str(out), readings=str(src), codes=str(src / "codes.json"),
                          k=4, elbow=True, elbow_ks=(2, 3), model_path=str(out / "model"))
    written = job.run(spark, opts)
    return spark, written, opts


def test_all_tables_written(ran):
    spark, written, _ = ran
    expected = {"readings", "profile", "country_improvement", "country_chart", "worst_today",
                "centroids", "region_fit", "elbow", "region_improvement", "region_chart",
                "streak_series", "max_streaks", "streak_distribution", "streak_by_region",
                "best_region_bins", "streak_summary", "streak_axis", "country_map", "region_markers",
                "zone_points", "streak_popups", "clustered"}
    assert expected <= set(written)
    for path in written.values():
        spark.read.parquet(path).limit(1).collect()


def test_values(ran):
    spark, written, _ = ran
    prof = spark.read.parquet(written["profile"]).first()
    assert prof.rows == N_ROWS            # positions differ within a day, so the dedupe keeps all
    imp = spark.read.parquet(written["country_improvement"])
    assert {r.country for r in imp.collect()} == {"FRA", "DEU", None}
    assert spark.read.parquet(written["centroids"]).count() == 4
    assert spark.read.parquet(written["streak_popups"]).count() == 4
    assert spark.read.parquet(written["elbow"]).count() == 2
    cm = {r.country: r.fill for r in spark.read.parquet(written["country_map"]).collect()}
    assert set(cm) == {"FRA", "DEU"}
    assert spark.read.parquet(written["readings"]).select("date").distinct().count() == 5


def test_rerun_reuses_model(ran):
    spark, written, opts = ran
    again = job.JobOptions(out=opts.out + "_2", readings=opts.readings, codes=opts.codes, k=4,
                           model_path=opts.model_path, maps=False)
    w2 = job.run(spark, again)
    a = spark.read.parquet(written["centroids"]).orderBy("cluster").collect()
    b = spark.read.parquet(w2["centroids"]).orderBy("cluster").collect()
    assert a == b
    assert spark.read.parquet(w2["region_fit"]).first().training_cost is None


def test_job_on_tables_equals_registered_queries(spark, tmp_path):
    """The job (curated table, literal 'today') and the registered queries
    (lazy pipeline, in-plan max(date)) give the same country results."""
    from airlens.plans import catalog
    from tests.conftest import SF_SMALL
    opts = job.JobOptions(out=str(tmp_path / "out"), tables=SF_SMALL, k=5, maps=False)
    written = job.run(spark, opts)

    def rows(df, cols):
        return sorted(map(tuple, df.select(*cols).collect()), key=str)

    cols = ["country", "country_name", "AQI_improvement"]
    assert rows(spark.read.parquet(written["country_improvement"]), cols) == \
        rows(catalog.q_improve_by_country(spark, SF_SMALL), cols)
    assert rows(spark.read.parquet(written["worst_today"]), ["country", "avg_AQI"]) == \
        rows(catalog.q_worst_today(spark, SF_SMALL), ["country", "avg_AQI"])
    assert rows(spark.read.parquet(written["profile"]), ["rows", "first_date", "last_date"]) == \
        rows(catalog.q_date_profile(spark, SF_SMALL), ["rows", "first_date", "last_date"])


def test_concurrency_does_not_change_results(spark, tmp_path):
    from tests.conftest import SF_SMALL
    outs = {}
    for c in (1, 4):
        opts = job.JobOptions(out=str(tmp_path / f"out{c}"), tables=SF_SMALL, k=5, concurrency=c)
        outs[c] = job.run(spark, opts)
    assert set(outs[1]) == set(outs[4])
    for name in outs[1]:
        a = spark.read.parquet(outs[1][name])
        b = spark.read.parquet(outs[4][name])
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str), name


def test_region_tables(ran):
    spark, written, _ = ran
    ranked = [r.AQI_improvement for r in spark.read.parquet(written["region_improvement"]).coalesce(1).collect()]
    assert ranked == sorted(ranked, reverse=True)
    # every distinct position, not a sample of them
    assert spark.read.parquet(written["zone_points"]).count() == 7


def test_empty_input_keeps_the_last_table(spark, tmp_path):
    from airlens.sources.json_readings import InputError
    good, empty = tmp_path / "good", tmp_path / "empty"
    good.mkdir()
    empty.mkdir()
    write_table(good)
    (empty / "sensors_20240501.json").write_text('{"id": 1}\n')
    run = lambda src: job.run(spark, job.JobOptions(out=str(tmp_path / "out"), readings=str(src), k=2, maps=False))
    written = run(good)
    with pytest.raises(InputError):
        run(empty)
    assert spark.read.parquet(written["readings"]).count() == N_ROWS


def test_training_on_cells(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    write_table(src)
    opts = job.JobOptions(out=str(tmp_path / "out"), readings=str(src), k=3, maps=False, train_on="cells", grid=64,
                          elbow=True, elbow_ks=(2, 3), model_path=str(tmp_path / "model"))
    written = job.run(spark, opts)
    assert 2 <= spark.read.parquet(written["centroids"]).count() <= 3      # as the start finds them
    assert [r.inertia > 0 for r in spark.read.parquet(written["elbow"]).collect()] == [True, True]
    assert spark.read.parquet(written["clustered"]).where("cluster is null").count() == 0


def test_a_failed_run_leaves_table_and_model(spark, tmp_path, monkeypatch):
    """Between write and switch: readers still get the table and the model of the run before."""
    from airlens.operators import regions
    from airlens.sources import versions
    src, out = tmp_path / "src", tmp_path / "out"
    src.mkdir()
    write_table(src)
    opts = dict(out=str(out), readings=str(src), k=3, maps=False, model_path=str(tmp_path / "model"))
    written = job.run(spark, job.JobOptions(**opts))
    centres = sorted(spark.read.parquet(written["centroids"]).collect())
    table, model = versions.current(spark, f"{out}/readings"), versions.current(spark, opts["model_path"])
    assert table == written["readings"]

    def fail(*a):
        raise OSError("lost")

    monkeypatch.setattr(versions, "switch", fail)
    with pytest.raises(OSError):
        job.run(spark, job.JobOptions(**opts, retrain=True))
    pts = regions.training_points(spark.read.parquet(table))
    with pytest.raises(OSError):
        regions.fit_regions(pts, k=2, model_path=opts["model_path"])
    monkeypatch.undo()
    assert versions.current(spark, f"{out}/readings") == table and spark.read.parquet(table).count() == N_ROWS
    assert versions.current(spark, opts["model_path"]) == model
    again = job.run(spark, job.JobOptions(**opts))
    assert sorted(spark.read.parquet(again["centroids"]).collect()) == centres
