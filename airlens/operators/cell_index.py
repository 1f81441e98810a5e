"""Nearest centre through a grid whose cells know exactly which centres can be nearest in them.

``nearest_centroid`` compares a row with all k centres. Here a square around the rows is halved ``levels`` times
in both directions. A centre can be nearest somewhere in a cell only if its least distance to the cell is no more than
the smallest of all centres' greatest distances to it; a cell hands the centres that pass to its four
quarters, so a level costs about as many comparisons as there are centres. A row then meets the
few centres of its own cell (an equi-join on the cell).

The result is that of ``regions.nearest_centroid``: the least (distance, id), from the same expression, ties
included (bounds are widened by more than rounding can take away). Centres with a null coordinate are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLACK = 1e-9     # bounds are widened by this share


def levels_for(k: int) -> int:
    """Levels that give about four cells to a centre."""
    return max(1, math.ceil(math.log(max(1, 4 * k), 4)))


def box_of(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> Column:
    """The square (y, x, side) around all rows as an in-plan scalar subquery."""
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    side = F.greatest(F.max(y) - F.min(y), F.max(x) - F.min(x))
    return df.agg(F.struct(F.min(y).alias("y"), F.min(x).alias("x"), F.when(side > 0, side).otherwise(1.0).alias("side"))).scalar()


def cell_index(centroids: DataFrame, box: Column, levels: int) -> DataFrame:
    """(_iy, _ix, _centres): every cell of the last level with the centres that can be nearest in it."""
    cells = (centroids.dropna(subset=["centroid_lat", "centroid_lon"])
             .agg(F.collect_list(F.struct(F.col("cluster").cast("int").alias("id"), F.col("centroid_lat").cast("double").alias("cy"),
                                          F.col("centroid_lon").cast("double").alias("cx"))).alias("_centres"))
             .select(F.lit(0).cast("long").alias("_iy"), F.lit(0).cast("long").alias("_ix"), "_centres").withColumn("_box", box))
    for level in range(1, levels + 1):
        half = F.col("_box.side") / F.lit(float(2 << level))
        reach = half * (1 + SLACK)
        quarters = cells.select(F.explode(F.sequence(F.lit(0), F.lit(3))).alias("_q"), "_iy", "_ix", "_centres", "_box").select(
            (F.col("_iy") * 2 + F.floor(F.col("_q") / 2)).alias("_iy"), (F.col("_ix") * 2 + F.col("_q") % 2).alias("_ix"), "_centres", "_box")
        quarters = quarters.withColumns({"_my": F.col("_box.y") + (F.col("_iy") * 2 + 1) * half,
                                         "_mx": F.col("_box.x") + (F.col("_ix") * 2 + 1) * half, "_reach": reach})

        def away(c: Column) -> tuple[Column, Column]:
            return F.abs(c["cy"] - F.col("_my")), F.abs(c["cx"] - F.col("_mx"))

        def most(c: Column) -> Column:
            dy, dx = (d + F.col("_reach") for d in away(c))
            return dy * dy + dx * dx

        def least(c: Column) -> Column:
            dy, dx = (F.greatest(d - F.col("_reach"), F.lit(0.0)) for d in away(c))
            return dy * dy + dx * dx

        # a lambda variable holds the bound, so that it is worked out once a cell and not once a centre
        bound = F.array(F.array_min(F.transform("_centres", most)) * (1 + SLACK))
        kept = F.element_at(F.transform(bound, lambda b: F.filter("_centres", lambda c: least(c) <= b)), 1)
        cells = quarters.select("_iy", "_ix", kept.alias("_centres"), "_box")
    return cells.drop("_box")


def nearest_by_cells(df: DataFrame, centroids: DataFrame, levels: int, lat: str = "latitude", lon: str = "longitude",
                     out: str = "cluster", distance: str | None = None, candidates: str | None = None) -> DataFrame:
    """``df`` with ``out``, the id of the nearest centre (null without one or without a position).

    ``levels`` as from ``levels_for``. ``candidates`` names a column for the number of centres that a row was
    compared with. The index is joined as the planner decides from its size; nothing is broadcast by hand.
    """
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    box, cells = box_of(df, lat, lon), F.lit(1 << levels)
    of = F.col("_box")
    placed = df.withColumn("_box", box).withColumns({
        name: F.greatest(F.least(F.floor((value - low) / of["side"] * cells), cells - 1), F.lit(0)).cast("long")
        for name, value, low in (("_iy", y, of["y"]), ("_ix", x, of["x"]))})
    placed = placed.withColumn("_iy", F.when(y.isNotNull() & x.isNotNull(), F.col("_iy")))
    joined = placed.join(cell_index(centroids, box, levels), ["_iy", "_ix"], "left")
    scored = F.transform("_centres", lambda c: F.struct(
        ((y - c["cy"]) * (y - c["cy"]) + (x - c["cx"]) * (x - c["cx"])).alias("d"), c["id"].alias("id")))
    res = joined.withColumn("_nearest", F.array_min(scored)).select(
        *df.columns, F.col("_nearest.id").alias(out), *([F.col("_nearest.d").alias(distance)] if distance else []),
        *([F.size("_centres").alias(candidates)] if candidates else []))
    return res
