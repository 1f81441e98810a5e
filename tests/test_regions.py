import pytest
from pyspark.sql import functions as F

from airlens.operators import regions
from airlens.plans import catalog
from tests.conftest import SF_SMALL


@pytest.fixture()
def three_points(spark):
    return spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (10.0, 10.0)], "latitude double, longitude double")


@pytest.fixture()
def two_centroids(spark):
    return spark.createDataFrame([(0, 0.0, 0.0), (1, 10.0, 10.0)],
                                 "cluster int, centroid_lat double, centroid_lon double")


def test_nearest_and_inertia(spark, three_points, two_centroids):
    got = [r.cluster for r in regions.nearest_centroid(three_points, two_centroids)
           .orderBy("latitude", "longitude").collect()]
    assert got == [0, 0, 1]
    assert regions.inertia(three_points, two_centroids).first().inertia == pytest.approx(1.0)


def test_tie_goes_to_lowest_id(spark, two_centroids):
    mid = spark.createDataFrame([(5.0, 5.0)], "latitude double, longitude double")
    assert regions.nearest_centroid(mid, two_centroids).first().cluster == 0


def test_null_coordinates_get_no_region(spark, two_centroids):
    rows = spark.createDataFrame([(None, 1.0), (1.0, None), (1.0, 1.0)], "latitude double, longitude double")
    got = regions.nearest_centroid(rows, two_centroids, distance="d")
    assert sorted(((r.cluster, r.d) for r in got.collect()), key=str) == [(0, 2.0), (None, None), (None, None)]
    more = rows.union(spark.createDataFrame([(5.0, 5.0), (5.0, 5.0), (9.0, 9.0)], rows.schema))
    model = regions.fit_regions(regions.training_points(more), k=2)
    assert regions.assign_positions(more, model).count() == 4


def test_model_does_not_follow_session_or_layout(spark):
    clean = catalog.readings(spark, SF_SMALL)
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for partitions, files in (("8", 1), ("3", 5), ("40", 2)):
            spark.conf.set(key, partitions)
            model = regions.fit_regions(regions.training_points(clean.repartition(files)), k=20, seed=42)
            found.append(sorted(tuple(c) for c in model.stages[-1].clusterCenters()))
    finally:
        spark.conf.set(key, before)
    assert found[0] == found[1] == found[2]
    from airlens.plans.job import JobOptions
    assert JobOptions(out="x").training_partitions == regions.TRAINING_PARTITIONS > 1


def test_callers_cache_stays(spark, three_points):
    points = regions.training_points(three_points).persist()
    level = points.storageLevel
    regions.fit_regions(points, k=2)
    regions.elbow(spark, points, [2], concurrency=1)
    assert points.storageLevel == level
    points.unpersist()


def test_unreadable_model_is_not_overwritten(spark, three_points, tmp_path):
    path = tmp_path / "model"
    (path / "metadata").mkdir(parents=True)
    (path / "metadata" / "part-00000").write_text("broken")
    with pytest.raises(Exception):
        regions.fit_regions(regions.training_points(three_points), k=2, model_path=str(path))
    assert (path / "metadata" / "part-00000").read_text() == "broken"


def test_k_larger_than_points(spark, three_points):
    model = regions.fit_regions(regions.training_points(three_points, partitions=2), k=10, seed=42)
    assert regions.centroid_table(spark, model).count() == 3


@pytest.fixture(scope="module")
def fitted(spark):
    clean = catalog.readings(spark, SF_SMALL)
    pts = regions.training_points(clean, partitions=4)
    return clean, pts, regions.fit_regions(pts, k=20, seed=42)


def test_model_assignment_equals_nearest_centroid(spark, fitted):
    clean, pts, model = fitted
    cents = regions.centroid_table(spark, model)
    by_model = regions.assign_regions(pts, model).select("latitude", "longitude",
                                                         F.col("cluster").alias("m"))
    by_sql = regions.nearest_centroid(pts, cents).select("latitude", "longitude",
                                                         F.col("cluster").alias("s"))
    diff = by_model.join(by_sql, ["latitude", "longitude"]).where("m <> s").count()
    assert diff == 0
    assert cents.count() <= 20


def test_inertia_not_above_training_cost(spark, fitted):
    _, pts, model = fitted
    wss = regions.inertia(pts, regions.centroid_table(spark, model)).first().inertia
    assert wss <= regions.training_cost(model) * (1 + 1e-9)


def test_save_reload_and_stale_model(spark, fitted, tmp_path):
    _, pts, model = fitted
    path = str(tmp_path / "model")
    m1 = regions.fit_regions(pts, k=20, seed=42, model_path=path)
    m2 = regions.fit_regions(pts, k=20, seed=42, model_path=path)      # reused
    assert regions.training_cost(m2) is None
    a = regions.assign_regions(pts, m1).select("latitude", "longitude", "cluster")
    b = regions.assign_regions(pts, m2).select("latitude", "longitude", "cluster")
    assert a.exceptAll(b).count() == 0
    m3 = regions.fit_regions(pts, k=5, seed=42, model_path=path)       # k changed: refit
    assert regions.centroid_table(spark, m3).count() == 5


def test_same_seed_same_model_across_input_layouts(spark, fitted):
    clean, _, _ = fitted
    costs = []
    for n in (1, 3):
        pts = regions.training_points(clean.repartition(n), partitions=4)
        costs.append(regions.training_cost(regions.fit_regions(pts, k=20, seed=42)))
    assert costs[0] == pytest.approx(costs[1], rel=1e-12)


def test_elbow_one_row_per_k(spark, fitted):
    _, pts, _ = fitted
    rows = regions.elbow(spark, pts, [2, 4, 6], seed=42, max_iter=5).collect()
    assert [r.k for r in rows] == [2, 4, 6]
    assert all(r.inertia is not None and r.training_cost is not None for r in rows)


def test_sensor_points_one_per_sensor(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.0, 2.0), (2, 5.0, 5.0), (2, 5.0, 5.0)],
                               "sensor_id long, latitude double, longitude double")
    pts = sorted(map(tuple, regions.training_points(df, partitions=2, per="sensor_id").collect()))
    assert pts == [(0.0, 1.0), (5.0, 5.0)]


def test_changed_data_refits_saved_model(spark, fitted, tmp_path):
    _, pts, _ = fitted
    path = str(tmp_path / "model")
    regions.fit_regions(pts, k=5, seed=42, model_path=path)
    same = regions.fit_regions(pts, k=5, seed=42, model_path=path)
    assert regions.training_cost(same) is None                     # reused
    fewer = pts.orderBy("latitude").limit(pts.count() - 3)
    changed = regions.fit_regions(fewer, k=5, seed=42, model_path=path)
    assert regions.training_cost(changed) is not None              # refitted


def test_sphere_geometry(spark):
    # two tight groups on both sides of the antimeridian and one far away
    df = spark.createDataFrame([(10.0, 179.9), (10.1, -179.9), (10.0, -179.8), (10.1, 179.8),
                                (-40.0, 20.0), (-40.1, 20.1)], "latitude double, longitude double")
    pts = regions.training_points(df, partitions=1)
    model = regions.fit_regions(pts, k=2, seed=1, geometry="sphere")
    labels = {(r.latitude, r.longitude): r.cluster
              for r in regions.assign_regions(df, model).collect()}
    assert len({labels[(10.0, 179.9)], labels[(10.1, -179.9)], labels[(10.0, -179.8)],
                labels[(10.1, 179.8)]}) == 1
    assert labels[(-40.0, 20.0)] != labels[(10.0, 179.9)]
    cents = sorted((round(r.centroid_lat), round(abs(r.centroid_lon)))
                   for r in regions.centroid_table(spark, model).collect())
    assert cents == [(-40, 20), (10, 180)]
