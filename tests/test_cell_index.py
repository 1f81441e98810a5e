"""Nearest centre through the cell index: the comparison with all centres, and few candidates."""

import random

import pytest
from pyspark.sql import functions as F

from airlens.operators import cell_index, regions

POINT, CENTRE = "i long, latitude double, longitude double", "cluster int, centroid_lat double, centroid_lon double"


def both(spark, points, centres, levels):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], POINT).repartition(3)
    own = spark.createDataFrame(centres, CENTRE)
    got = cell_index.nearest_by_cells(df, own, levels, distance="d", candidates="c")
    want = regions.nearest_centroid(df, own, distance="d")
    return ({r.i: (r.cluster, r.d) for r in got.collect()}, {r.i: (r.cluster, r.d) for r in want.collect()},
            got.agg(F.avg("c"), F.max("c")).first())


def test_ten_thousand_centres(spark):
    rnd = random.Random(3)
    place = lambda: (rnd.gauss(0, 30), rnd.uniform(-180, 180))
    centres = [(i, *place()) for i in range(10_000)]
    points = [place() for _ in range(1500)] + [c[1:] for c in centres[:200]]
    got, want, (mean, most) = both(spark, points, centres, cell_index.levels_for(len(centres)))
    assert got == want
    assert mean < 40 and most < 1000


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_ties_and_points_on_borders(spark, levels):
    """Whole-number places: many points are equally far from several centres and lie on cell borders."""
    rnd = random.Random(levels)
    centres = [(i, float(rnd.randint(0, 8)), float(rnd.randint(0, 8))) for i in range(40)]
    centres += [(100 + i, a, b) for i, (_, a, b) in enumerate(centres[:10])]        # equal centres, higher ids
    points = [(a / 2, b / 2) for a in range(17) for b in range(17)]
    got, want, _ = both(spark, points, centres, levels)
    assert got == want


def test_centres_far_from_the_points(spark):
    rnd = random.Random(9)
    centres = [(i, 1e6 + rnd.random(), -1e6 + rnd.random() * 100) for i in range(50)] + [(77, 5.0, 1e5)]
    points = [(rnd.random(), rnd.random() * 3) for _ in range(300)]
    got, want, _ = both(spark, points, centres, 4)
    assert got == want


def test_nulls_one_place_and_no_centre(spark):
    got, want, _ = both(spark, [(None, 1.0), (1.0, None), (None, None), (2.0, 2.0), (2.0, 2.0)], [(4, 1.0, 1.0), (5, 9.0, 9.0)], 3)
    assert got == want and got[0] == (None, None) and got[3][0] == 4
    got, want, _ = both(spark, [(2.0, 2.0)], [(4, 1.0, 1.0)], 3)
    assert got == want
    df, none = spark.createDataFrame([(0, 1.0, 1.0)], POINT), spark.createDataFrame([], CENTRE)
    assert [r.cluster for r in cell_index.nearest_by_cells(df, none, 2).collect()] == [None]
    odd = spark.createDataFrame([(1, None, 2.0), (2, 50.0, 50.0)], CENTRE)
    assert [r.cluster for r in cell_index.nearest_by_cells(df, odd, 2).collect()] == [2]
    assert cell_index.nearest_by_cells(df.limit(0), odd, 2).count() == 0


def test_candidates_fall_with_levels(spark):
    rnd = random.Random(2)
    centres = [(i, rnd.random(), rnd.random()) for i in range(400)]
    points = [(rnd.random(), rnd.random()) for _ in range(400)]
    means = [both(spark, points, centres, levels)[2][0] for levels in (1, 3, 5)]
    assert means[0] > 3 * means[1] > 3 * means[2]
    assert cell_index.levels_for(1) == 1 and cell_index.levels_for(10_000) == 8


def test_no_cross_join(spark):
    import contextlib
    import io
    df = spark.createDataFrame([(0, 1.0, 1.0)], POINT)
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        cell_index.nearest_by_cells(df, spark.createDataFrame([(1, 1.0, 1.0)], CENTRE), 3).explain()
    assert "CartesianProduct" not in said.getvalue() and "NestedLoop" not in said.getvalue()
