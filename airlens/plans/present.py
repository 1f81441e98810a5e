"""Chart- and map-ready tables (the data behind each chart and map).

Each function returns a DataFrame; nothing is collected. Top-k tables are
bounded by k, so windows over them without a partition key stay small (the
limit already leaves them in one partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlens.constants import (K_REGIONS, NO_DATA_COLOUR, SAMPLE_POINTS, TOOLTIP_CENTROID,
                               TOOLTIP_IMPROVEMENT, TOOLTIP_NO_STREAK, TOOLTIP_STREAK,
                               TOP_COUNTRIES, TOP_REGIONS)
from airlens.functions.presentation import (index_colour, marker_radius, palette_slot,
                                            ramp_colour, scaled_colour, sign_colour,
                                            signed_label)
from airlens.operators.ranking import top_k
from airlens.operators.runs import run_tiers


def country_chart(improvement: DataFrame, n: int = TOP_COUNTRIES,
                  score: str = "AQI_improvement") -> DataFrame:
    """Top-n countries with bar colour (improved / worsened) and value label."""
    return (top_k(improvement, score, ["country"], n)
            .withColumn("colour", sign_colour(score))
            .withColumn("label", signed_label(score, 2)))


def region_chart(improvement: DataFrame, n: int = TOP_REGIONS,
                 score: str = "AQI_improvement") -> DataFrame:
    """Top-n regions with bar colour and the region id as text."""
    return (top_k(improvement, score, ["cluster"], n)
            .withColumn("colour", sign_colour(score))
            .withColumn("cluster_label", F.col("cluster").cast("string")))


def country_map(codes: DataFrame, level: DataFrame, value: str = "avg_AQI") -> DataFrame:
    """Every country of the dimension with today's level and fill colour;
    countries without data get the no-data colour."""
    countries = codes.select(F.col("alpha3Code").alias("country"),
                             F.col("englishShortName").alias("country_name")).distinct()
    joined = countries.join(level.select("country", value), "country", "left")
    return joined.withColumn(
        "fill", F.when(F.col(value).isNull(), F.lit(NO_DATA_COLOUR)).otherwise(index_colour(value)))


def region_markers(improvement: DataFrame, n: int = TOP_REGIONS,
                   score: str = "AQI_improvement") -> DataFrame:
    """Marker radius, ramp colour, scaled colour and tooltip of the top-n regions.

    The colour scale spans the min and max score of these n rows.
    """
    rows = top_k(improvement, score, ["cluster"], n).dropna(subset=["centroid_lat", "centroid_lon"])
    everything = Window.partitionBy()
    lo = F.min(score).over(everything)
    hi = F.max(score).over(everything)
    return (rows.withColumn("_lo", lo).withColumn("_hi", hi)
                .select("cluster", score, "centroid_lat", "centroid_lon",
                        marker_radius(score).alias("radius"),
                        ramp_colour(score, F.col("_lo"), F.col("_hi")).alias("colour"),
                        scaled_colour(score, F.col("_lo"), F.col("_hi")).alias("scaled_colour"),
                        F.format_string(TOOLTIP_IMPROVEMENT, F.col("cluster"),
                                        signed_label(score, 3)).alias("tooltip")))


def grid_key(lat: str = "latitude", lon: str = "longitude") -> Column:
    """Text key of a position on a 1e-6 degree grid (engine-independent)."""
    return F.concat_ws(",", F.floor(F.col(lat) * F.lit(1e6)).cast("long").cast("string"),
                       F.floor(F.col(lon) * F.lit(1e6)).cast("long").cast("string"))


def sample_rows(df: DataFrame, n: int, key: Column, tie: list[str]) -> DataFrame:
    """A deterministic sample of at most ``n`` rows: the ``n`` smallest
    md5(key). Independent of partitioning and reproducible anywhere."""
    return df.withColumn("_h", F.md5(key)).orderBy("_h", *tie).limit(n).drop("_h")


def zone_points(points: DataFrame, n_slots: int = K_REGIONS,
                lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Every region member with a palette slot per region."""
    return points.dropna(subset=[lat, lon, "cluster"]).withColumn("slot", palette_slot("cluster", n_slots))


def zone_sample(zone: DataFrame, n: int = SAMPLE_POINTS, lat: str = "latitude",
                lon: str = "longitude") -> DataFrame:
    """The sample of ``zone_points`` that is drawn: n of them."""
    return sample_rows(zone, n, grid_key(lat, lon), [lat, lon])


def centroid_markers(centroids: DataFrame) -> DataFrame:
    """Region centres with their marker tooltip (the centre layer of the zone map)."""
    return centroids.select("cluster", "centroid_lat", "centroid_lon",
                            F.format_string(TOOLTIP_CENTROID, F.col("cluster")).alias("tooltip"))


def streak_popups(centroids: DataFrame, with_streak: DataFrame) -> DataFrame:
    """Every region (from the centroid table) with its centre, max good run,
    marker tier and run-length histogram text; regions without good days are
    kept (tier 'gray')."""
    return (run_tiers(centroids.select("cluster", "centroid_lat", "centroid_lon"), with_streak, ["cluster"])
            .withColumn("tooltip", F.when(
                F.col("max_streak") > 0,
                F.format_string(TOOLTIP_STREAK, F.col("cluster"), F.col("max_streak")))
                .otherwise(F.format_string(TOOLTIP_NO_STREAK, F.col("cluster")))))
