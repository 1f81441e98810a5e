"""Geographic regions: K-Means over coordinates, centroids, assignment, cost.

Two ways to give every reading a region:

* ``assign_regions`` scores with a fitted ``PipelineModel`` (VectorAssembler
  + KMeans); MLlib broadcasts the k centres with the model.
* ``nearest_centroid`` takes any centroid table (k rows) and
  computes the arg-min in plain SQL functions: the centroid array is an
  in-plan scalar subquery (evaluated once, shipped to every task) and the
  arg-min is the least (distance, id) over it. No join, no cross product.
  Ties go to the lowest region id.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Iterable, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens.constants import K_REGIONS, K_SEED
from airlens.sources import versions
from airlens.sources.paths import exists

FEATURES = "geo_coordinates"
# Partitions of a K-Means training set of ordinary size: a fixed number, because the k-means||
# start (and so the model) depends on how the points fall into partitions.
TRAINING_PARTITIONS = 8
# Weighted training: cells along the longer side of the points' bounding box.
TRAINING_GRID = 1024
# Points of a task: the most, and the fewest that are worth a task of their own.
POINTS_PER_TASK, FEWEST_PER_TASK = 1 << 15, 1 << 12
WEIGHT = "weight"

CENTROID_SCHEMA = T.StructType([
    T.StructField("cluster", T.IntegerType(), False),
    T.StructField("centroid_lat", T.DoubleType(), False),
    T.StructField("centroid_lon", T.DoubleType(), False),
])


def distinct_points(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
                    extra: Sequence[str] = ()) -> DataFrame:
    """Distinct coordinate pairs (plus columns that depend on them, e.g. region)."""
    cols = [lat, lon, *extra]
    return df.select(*cols).dropna(subset=[lat, lon]).dropDuplicates([lat, lon])


def sensor_points(df: DataFrame, sensor: str = "sensor_id", lat: str = "latitude",
                  lon: str = "longitude") -> DataFrame:
    """One mean position per sensor (partial aggregation, one shuffle on the
    sensor key). Far fewer training points than distinct positions when
    positions jitter per reading. Means are rounded to 1e-9 degrees (well
    under a millimetre) so that the summation order, which depends on
    partitioning, cannot change the training set or its fingerprint."""
    return (df.dropna(subset=[lat, lon])
              .groupBy(sensor).agg(F.round(F.avg(lat), 9).alias(lat),
                                   F.round(F.avg(lon), 9).alias(lon))
              .select(lat, lon))


def training_points(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
                    partitions: int = TRAINING_PARTITIONS, per: str | None = None) -> DataFrame:
    """Distinct points, hash-partitioned into ``partitions`` partitions and sorted within them.

    The same points and seed give the same model whatever the input files, the
    data size or the session's shuffle partitions. Raise ``partitions`` for
    very many points; that is a different (equally good) model. The distinct
    runs first (map-side combine), so the second shuffle moves distinct points only.

    ``per=None`` trains on distinct positions (the original behaviour);
    ``per="sensor_id"`` trains on one mean position per sensor, the choice
    for large data: with jittered positions nearly every reading is distinct.
    """
    src = sensor_points(df, per, lat, lon) if per else df
    return distinct_points(src, lat, lon).repartition(partitions, lat, lon).sortWithinPartitions(lat, lon)


def weighted_points(df: DataFrame, lat: str = "latitude", lon: str = "longitude", grid: int = TRAINING_GRID,
                    per: str | None = None) -> DataFrame:
    """Distinct points reduced to grid cells: (lat, lon, weight) with each cell's mean position and number of points.

    The longer side of the bounding box has ``grid`` cells, so there are at most ``grid`` squared rows
    whatever the number of points, and every pass of the fit costs that much at most. A cell's mean is exact
    for centres (only points of cells on the border of two regions can move with their cell), so with cells
    much smaller than a region the inertia is that of the unreduced fit. ``per`` as in ``training_points``.
    Means are rounded to 1e-9 so that the order of summation does not show.
    """
    src = distinct_points(sensor_points(df, per, lat, lon) if per else df, lat, lon)
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    box = df.agg(F.min(y).alias("y"), F.min(x).alias("x"), F.greatest(F.max(y) - F.min(y), F.max(x) - F.min(x)).alias("side"))
    side = F.when(F.col("_box.side") > 0, F.col("_box.side")).otherwise(1.0)

    def index(value, low):
        # sensor means may lie outside by rounding
        return F.greatest(F.least(F.floor((value - low) / side * grid), F.lit(grid - 1)), F.lit(0))

    cells = (src.withColumn("_box", box.select(F.struct("y", "x", "side")).scalar())
             .groupBy(index(y, F.col("_box.y")).alias("_iy"), index(x, F.col("_box.x")).alias("_ix"))
             .agg(F.count("*").alias(WEIGHT), *[F.when(F.count("*") == 1, F.min(v)).otherwise(F.round(F.avg(v), 9)).alias(name)
                                                for v, name in ((y, lat), (x, lon))]))
    return cells.select(lat, lon, F.col(WEIGHT).cast("double").alias(WEIGHT))


def laid_out(points: DataFrame, n: int, lat: str = "latitude", lon: str = "longitude", tasks: int = 1) -> DataFrame:
    """``n`` training points hash-partitioned by position and sorted within: ``tasks`` partitions, fewer where a
    task would have less than ``FEWEST_PER_TASK`` points, more where it would have over ``POINTS_PER_TASK``.

    The layout follows from the points alone: input files and session settings do not change the model.
    """
    tasks = max(1, min(tasks, -(-n // FEWEST_PER_TASK)), -(-n // POINTS_PER_TASK))
    return points.repartition(tasks, lat, lon).sortWithinPartitions(lat, lon)


# Unit-sphere features (geometry="sphere"): distances without the pole and
# antimeridian distortion of raw degrees.
SPHERE_COLS = ("_ux", "_uy", "_uz")
FINGERPRINT_DIR = "airlens_fingerprint"


def _pipeline(k: int, seed: int, lat: str, lon: str, max_iter: int | None,
              geometry: str = "degrees", weight: str | None = None) -> Pipeline:
    km = KMeans(k=k, seed=seed, featuresCol=FEATURES, predictionCol="cluster")
    if weight:
        km = km.setWeightCol(weight)
    if max_iter is not None:
        km = km.setMaxIter(max_iter)
    if geometry == "degrees":
        va = VectorAssembler(inputCols=[lat, lon], outputCol=FEATURES, handleInvalid="skip")
        return Pipeline(stages=[va, km])
    if geometry == "sphere":
        ux, uy, uz = SPHERE_COLS
        to_xyz = SQLTransformer(statement=(
            f"SELECT *, cos(radians({lat})) * cos(radians({lon})) AS {ux}, "
            f"cos(radians({lat})) * sin(radians({lon})) AS {uy}, "
            f"sin(radians({lat})) AS {uz} FROM __THIS__"))
        va = VectorAssembler(inputCols=list(SPHERE_COLS), outputCol=FEATURES, handleInvalid="skip")
        return Pipeline(stages=[to_xyz, va, km])
    raise ValueError(f"geometry must be 'degrees' or 'sphere', not {geometry!r}")


def geometry_of(model: PipelineModel) -> str:
    return "sphere" if len(model.stages) == 3 else "degrees"


def _matches(model: PipelineModel, k: int, seed: int, lat: str, lon: str, geometry: str, weight: str | None) -> bool:
    try:
        va, km = model.stages[-2], model.stages[-1]
        if geometry_of(model) != geometry or km.getK() != k or km.getSeed() != seed:
            return False
        if (km.getWeightCol() if km.isDefined("weightCol") else None) != weight:
            return False
        if geometry == "degrees":
            return list(va.getInputCols()) == [lat, lon]
        statement = model.stages[0].getStatement()
        return f"radians({lat})" in statement and f"radians({lon})" in statement
    except (AttributeError, IndexError):  # other stages: a foreign model
        return False


def fingerprint(points: DataFrame, lat: str = "latitude", lon: str = "longitude",
                weight: str | None = None) -> tuple[int, int]:
    """(number of points, xor of their 64-bit hashes): equal for the same set
    of distinct (weighted) points however they are partitioned or ordered."""
    n, h = points.agg(F.count("*"), F.bit_xor(F.xxhash64(lat, lon, *([weight] if weight else [])))).first()
    return int(n), int(h or 0)


def _stored_fingerprint(spark: SparkSession, model_path: str):
    path = f"{model_path}/{FINGERPRINT_DIR}"
    if not exists(spark, path):
        return None
    row = spark.read.schema("n long, h long").json(path).first()
    return (int(row["n"]), int(row["h"])) if row else None


@contextmanager
def _cached(df: DataFrame):
    """``df`` persisted for the block; a caller's own cache is left as it was."""
    if df.storageLevel != StorageLevel.NONE:
        yield df
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def fit_regions(points: DataFrame, k: int = K_REGIONS, seed: int = K_SEED,
                lat: str = "latitude", lon: str = "longitude",
                max_iter: int | None = None, model_path: str | None = None,
                retrain: bool = False, geometry: str = "degrees",
                check_data: bool = True, weight: str | None = None) -> PipelineModel:
    """Fit (or load) the region model on ``points`` (see ``training_points``), or with the column
    ``weight`` on weighted ones (see ``weighted_points``).

    With ``model_path`` an existing model is reused only if it was fitted
    with the same k, seed, geometry and coordinate columns and, with
    ``check_data``, on the same set of points (a count + hash fingerprint
    stored with the model). If there is none, or it differs, or with
    ``retrain=True``, it is refitted and becomes the current version (``sources.versions``:
    readers see the old model, whole, until the new one is finished); a model that cannot be
    read is an error and stays as it is. Works on any Hadoop file system (no local path
    checks). ``geometry="sphere"`` clusters unit vectors instead of raw
    degrees; the model still takes latitude and longitude.
    """
    spark = points.sparkSession
    fp = fingerprint(points, lat, lon, weight) if (model_path and check_data) else None
    stored = _stored_model(spark, model_path) if model_path else None
    if stored and not retrain:
        # a storage fault surfaces here; it never leads to an overwrite
        model = PipelineModel.load(stored)
        if _matches(model, k, seed, lat, lon, geometry, weight) and (
                fp is None or _stored_fingerprint(spark, stored) == fp):
            return model
    with _cached(points) as cached:
        model = _pipeline(k, seed, lat, lon, max_iter, geometry, weight).fit(cached)
    if model_path:
        version = versions.new_version(model_path)
        model.write().save(version)
        if fp is not None:
            spark.createDataFrame([fp], "n long, h long").coalesce(1).write.json(f"{version}/{FINGERPRINT_DIR}")
        versions.switch(spark, model_path, version)
    return model


def _stored_model(spark: SparkSession, model_path: str) -> str | None:
    """Folder of the current model: its current version, or ``model_path`` itself if a model was saved right there."""
    return versions.current(spark, model_path) or (model_path if exists(spark, f"{model_path}/metadata") else None)


def training_cost(model: PipelineModel) -> float | None:
    """The fit summary's cost (None for a loaded model, which has no summary)."""
    km = model.stages[-1]
    return km.summary.trainingCost if km.hasSummary else None


def assign_regions(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``cluster`` (int) to every row by scoring with the model. Rows with
    a NULL coordinate are dropped, as the assembler cannot place them."""
    return (model.transform(df).drop(FEATURES, *SPHERE_COLS)
                 .withColumn("cluster", F.col("cluster").cast("int")))


def centroid_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(cluster, centroid_lat, centroid_lon): k rows from the model's centres.

    k may be smaller than requested when there are fewer distinct points.
    """
    centres = model.stages[-1].clusterCenters()
    if geometry_of(model) == "sphere":
        rows = [(i, math.degrees(math.atan2(float(c[2]), math.hypot(float(c[0]), float(c[1])))),
                 math.degrees(math.atan2(float(c[1]), float(c[0])))) for i, c in enumerate(centres)]
    else:
        rows = [(i, float(c[0]), float(c[1])) for i, c in enumerate(centres)]
    return spark.createDataFrame(rows, CENTROID_SCHEMA)


def label_centroids(df: DataFrame, label: str, lat: str = "latitude",
                    lon: str = "longitude") -> DataFrame:
    """Mean position per label: (cluster, centroid_lat, centroid_lon)."""
    return df.groupBy(F.col(label).cast("int").alias("cluster")).agg(
        F.avg(F.col(lat).cast("double")).alias("centroid_lat"),
        F.avg(F.col(lon).cast("double")).alias("centroid_lon"))


def nearest_centroid(df: DataFrame, centroids: DataFrame, lat: str = "latitude",
                     lon: str = "longitude", out: str = "cluster",
                     distance: str | None = None) -> DataFrame:
    """Add ``out`` = id of the nearest centroid (squared Euclidean distance on
    the coordinates; lowest id on ties), and optionally the squared distance.
    A row with a NULL coordinate gets NULL for both.

    ``centroids`` has (cluster, centroid_lat, centroid_lon). They are gathered
    into one array by an in-plan scalar subquery, evaluated once and shipped to every
    task. Each distance is computed once per row: call this on distinct positions.
    """
    gathered = centroids.select(
        F.collect_list(F.struct(
            F.col("cluster").cast("int").alias("id"),
            F.col("centroid_lat").cast("double").alias("cy"),
            F.col("centroid_lon").cast("double").alias("cx"))).alias("_c")).scalar()
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    scored = F.transform(F.col("_centroids"), lambda c: F.struct(
        ((y - c["cy"]) * (y - c["cy"]) + (x - c["cx"]) * (x - c["cx"])).alias("d"), c["id"].alias("id")))
    placed = y.isNotNull() & x.isNotNull()
    res = (df.withColumn("_centroids", gathered)
             .withColumn("_nearest", F.when(placed, F.array_min(scored)))
             .withColumn(out, F.col("_nearest.id")))
    if distance:
        res = res.withColumn(distance, F.col("_nearest.d"))
    return res.drop("_centroids", "_nearest")


def assign_positions(df: DataFrame, model: PipelineModel, lat: str = "latitude",
                     lon: str = "longitude") -> DataFrame:
    """``assign_regions`` with each distinct position scored once and joined back."""
    where = assign_regions(distinct_points(df, lat, lon), model)
    return df.join(where, [lat, lon]).select(*df.columns, "cluster")


def _exact_sum(value: Column) -> Column:
    """Sum of doubles as decimals of 16 places: the order of tasks does not show in the last digits."""
    return F.sum(value.cast("decimal(38,16)")).cast("double")


def inertia(df: DataFrame, centroids: DataFrame, lat: str = "latitude",
            lon: str = "longitude", weight: str | None = None) -> DataFrame:
    """Within-cluster sum of squared distances of ``df``'s points to their
    nearest centroid, computed from the data (one row: n_points, inertia).

    This is not the fit summary's cost, which belongs to the centres before
    the last update; report both under different names.
    """
    own = [lat, lon, *([weight] if weight else [])]
    scored = nearest_centroid(df.select(*own).dropna(), centroids, lat, lon, distance="_d2")
    return scored.agg(F.count("*").alias("n_points"), _exact_sum(F.col("_d2") * F.col(weight) if weight else F.col("_d2")).alias("inertia"))


def inertias(df: DataFrame, centres: DataFrame, ks: Sequence[int], lat: str = "latitude", lon: str = "longitude",
             weight: str | None = None) -> DataFrame:
    """(k, n_points, inertia) of several centre sets from one scan of the points.

    ``centres`` has (k, centroid_lat, centroid_lon); each set is gathered into an array by an in-plan scalar
    subquery and every k is one sum of the same aggregation. A set without centres has inertia null.
    """
    ks = list(ks)
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    w = F.col(weight) if weight else F.lit(1.0)
    points = df.dropna(subset=[lat, lon])
    for i, k in enumerate(ks):
        own = centres.where(F.col("k") == k).select(F.collect_list(F.struct(
            F.col("centroid_lat").cast("double").alias("cy"), F.col("centroid_lon").cast("double").alias("cx"))))
        points = points.withColumn(f"_set{i}", own.scalar())

    def squared(i: int):
        return F.array_min(F.transform(f"_set{i}", lambda c: (y - c["cy"]) * (y - c["cy"]) + (x - c["cx"]) * (x - c["cx"])))

    sums = points.agg(F.count("*").alias("n_points"), *[_exact_sum(squared(i) * w).alias(f"_{i}") for i in range(len(ks))])
    each = F.array(*[F.struct(F.lit(int(k)).alias("k"), F.col(f"_{i}").alias("inertia")) for i, k in enumerate(ks)])
    return sums.select("n_points", F.explode(each).alias("_of")).select("_of.k", "n_points", "_of.inertia")


def elbow(spark: SparkSession, points: DataFrame, ks: Iterable[int], seed: int = K_SEED,
          lat: str = "latitude", lon: str = "longitude",
          max_iter: int | None = None, concurrency: int = 4, weight: str | None = None) -> DataFrame:
    """(k, training_cost, inertia) for each k: one fit per k on the same
    persisted training set; the inertia of all models is recomputed from the data in one scan.

    The fits are independent, so up to ``concurrency`` of them are submitted
    from separate threads and Spark runs their jobs side by side.
    """
    ks = [int(k) for k in ks]
    with _cached(points) as cached:
        def one(k: int):
            model = _pipeline(k, seed, lat, lon, max_iter, weight=weight).fit(cached)
            cost = training_cost(model)
            return float(cost) if cost is not None else None, [c.tolist() for c in model.stages[-1].clusterCenters()]

        if concurrency <= 1:
            fits = [one(k) for k in ks]
        else:
            with ThreadPoolExecutor(max_workers=min(concurrency, len(ks))) as pool:
                fits = list(pool.map(one, ks))
        centres = spark.createDataFrame([(k, *c) for k, (_, own) in zip(ks, fits) for c in own],
                                        "k int, centroid_lat double, centroid_lon double")
        wss = {r["k"]: r["inertia"] for r in inertias(cached, centres, ks, lat, lon, weight).collect()}   # a row per k
    rows = [(k, cost, float(wss[k])) for k, (cost, _) in zip(ks, fits)]
    return spark.createDataFrame(rows, "k int, training_cost double, inertia double")
