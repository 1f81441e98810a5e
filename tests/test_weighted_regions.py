"""K-Means on weighted grid cells, and the inertia of several models from one scan."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from airlens.operators import regions

POINT = "latitude double, longitude double"


@pytest.fixture(scope="module")
def blobs(spark):
    rnd = random.Random(8)
    centres = [(rnd.uniform(-60, 60), rnd.uniform(-150, 150)) for _ in range(12)]
    rows = [(rnd.gauss(a, 2), rnd.gauss(b, 2)) for a, b in centres for _ in range(1500)]
    return spark.createDataFrame(rows + rows[:300] + [(None, 1.0), (2.0, None)], POINT).repartition(3).persist(), len(rows)


def fit(cells, k, seed=5):
    return regions.fit_regions(regions.laid_out(cells, cells.count()), k=k, seed=seed, weight="weight")


def test_cells_hold_every_distinct_point_once(spark, blobs):
    df, n = blobs
    cells = regions.weighted_points(df, grid=128).collect()
    assert sum(r.weight for r in cells) == n and len(cells) < n / 2
    mean = [sum(r[c] * r.weight for r in cells) / n for c in ("latitude", "longitude")]
    assert mean == pytest.approx(list(df.dropna().distinct().agg(F.avg("latitude"), F.avg("longitude")).first()), abs=1e-8)
    assert len({(round(r.latitude, 6), round(r.longitude, 6)) for r in cells}) == len(cells)


def test_inertia_within_a_percent(spark, blobs):
    """At the best of a few seeds, as a single start can end in a poor optimum in either form."""
    df, _ = blobs
    pts, cells = regions.training_points(df).persist(), regions.weighted_points(df, grid=256).persist()
    seeds = (1, 2, 3)
    plain = min(regions.inertia(pts, regions.centroid_table(spark, regions.fit_regions(pts, k=12, seed=s))).first().inertia for s in seeds)
    reduced = min(regions.inertia(pts, regions.centroid_table(spark, fit(cells, 12, s))).first().inertia for s in seeds)
    assert reduced <= 1.01 * plain
    pts.unpersist(), cells.unpersist()


def test_same_model_whatever_the_files(spark, blobs):
    df, _ = blobs
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for files, partitions in ((1, "5"), (7, "8"), (64, "16")):
            spark.conf.set(key, partitions)
            model = fit(regions.weighted_points(df.repartition(files), grid=64), 9)
            found.append([tuple(c) for c in model.stages[-1].clusterCenters()])
    finally:
        spark.conf.set(key, before)
    assert found[0] == found[1] == found[2]


def test_tasks_follow_the_points(spark, blobs, monkeypatch):
    df, n = blobs
    pts = regions.distinct_points(df)
    assert regions.laid_out(pts, n).rdd.getNumPartitions() == 1
    monkeypatch.setattr(regions, "POINTS_PER_TASK", 1000)
    assert regions.laid_out(pts, n).rdd.getNumPartitions() == -(-n // 1000)
    assert regions.laid_out(pts, 0).rdd.getNumPartitions() == 1


def test_one_place_no_place_and_edges(spark):
    one = spark.createDataFrame([(3.5, 4.5)] * 3, POINT)
    assert [tuple(r) for r in regions.weighted_points(one).collect()] == [(3.5, 4.5, 1.0)]
    assert regions.weighted_points(one.limit(0)).count() == 0
    line = spark.createDataFrame([(0.0, float(i)) for i in range(11)], POINT)
    assert sorted(r.weight for r in regions.weighted_points(line, grid=5).collect()) == [2, 2, 2, 2, 3]


def test_saved_model_of_other_weights_is_refitted(spark, blobs, tmp_path):
    df, _ = blobs
    cells = regions.weighted_points(df, grid=32)
    laid = regions.laid_out(cells, cells.count())
    path = str(tmp_path / "model")
    regions.fit_regions(laid, k=4, model_path=path, weight="weight")
    assert regions.training_cost(regions.fit_regions(laid, k=4, model_path=path, weight="weight")) is None      # reused
    assert regions.training_cost(regions.fit_regions(laid, k=4, model_path=path)) is not None
    doubled = laid.withColumn("weight", F.col("weight") * 2)
    regions.fit_regions(laid, k=4, model_path=path, weight="weight")
    assert regions.training_cost(regions.fit_regions(doubled, k=4, model_path=path, weight="weight")) is not None


def test_weight_counts_as_copies(spark):
    rows = [(0.0, 0.0, 5.0), (0.0, 1.0, 1.0), (9.0, 9.0, 2.0)]
    heavy = spark.createDataFrame(rows, POINT + ", weight double")
    copies = spark.createDataFrame([(a, b) for a, b, w in rows for _ in range(int(w))], POINT)
    centres = spark.createDataFrame([(0, 0.0, 0.25), (1, 9.0, 8.0)], "cluster int, centroid_lat double, centroid_lon double")
    assert regions.inertia(heavy, centres, weight="weight").first().inertia == pytest.approx(regions.inertia(copies, centres).first().inertia)


def test_inertias_of_several_models(spark, blobs):
    df, _ = blobs
    rnd = random.Random(1)
    sets = {k: [(rnd.uniform(-60, 60), rnd.uniform(-150, 150)) for _ in range(k)] for k in (1, 4, 30)}
    centres = spark.createDataFrame([(k, a, b) for k, own in sets.items() for a, b in own], "k int, centroid_lat double, centroid_lon double")
    got = regions.inertias(df, centres, [1, 4, 30, 99])
    found = {r.k: r for r in got.collect()}
    points = [tuple(r) for r in df.dropna().collect()]
    for k, own in sets.items():
        want = sum(min((a - y) ** 2 + (b - x) ** 2 for a, b in own) for y, x in points)
        assert found[k].inertia == pytest.approx(want, rel=1e-9) and found[k].n_points == len(points)
    assert found[99].inertia is None


def test_inertias_scan_once(spark, tmp_path, blobs):
    blobs[0].write.parquet(str(tmp_path / "points"))
    pts = spark.read.parquet(str(tmp_path / "points"))
    centres = spark.createDataFrame([(k, 1.0 * k, 2.0 * k) for k in (2, 3, 4)], "k int, centroid_lat double, centroid_lon double")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        regions.inertias(pts, centres, [2, 3, 4]).explain("formatted")
    assert out.getvalue().split("\n\n")[0].count("Scan parquet") == 1
