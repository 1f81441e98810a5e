"""Registered queries over the driver's tables.

Every query reads the given tables (see ``airlens.sources.tables`` for the
role mapping) and runs over all of their rows. Their SQL oracles are in
``airlens.plans.oracle``.

Doubles that come out of a floating-point sum whose order is engine-specific
(centroid means, distances, inertia) are rounded, here and in the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlens.constants import (ELBOW_KS, K_REGIONS, K_SEED, PM10_THRESHOLDS, PM25_THRESHOLDS,
                               TOP_COUNTRIES, TOP_REGIONS)
from airlens.functions.bands import band, composite_index
from airlens.operators import cell_index, delta, regions, run_state, runs
from airlens.operators.clean import TIMESTAMP_KEY, dedupe_before_join
from airlens.operators.extract import extract_readings, extract_readings_sql
from airlens.operators.ranking import rank_desc
from airlens.plans import ingest, present
from airlens.sources import rejects, tables

Query = Callable[[SparkSession, str], DataFrame]

CENTROID_DIGITS = 9
DISTANCE_DIGITS = 12
MANY = 200


# ---------------------------------------------------------------- building blocks

def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Clean readings (Q0) from the driver tables."""
    return ingest.build_from_tables(spark, sf)


def label_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return regions.label_centroids(tables.positions(spark, sf), "label")


def clustered(spark: SparkSession, sf: str) -> DataFrame:
    """Clean readings with the region of their position (nearest label centroid)."""
    return regions.nearest_centroid(readings(spark, sf), label_centroids(spark, sf))


def _round(df: DataFrame, cols, digits: int) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(c, digits))
    return df


def _with_centroids(improvement: DataFrame, centroids: DataFrame) -> DataFrame:
    """Centre coordinates joined to unranked improvements, then ranked (a sort below the join would not last)."""
    joined = improvement.join(centroids, "cluster", "left").select(
        "cluster", "AQI_improvement", F.round("centroid_lat", CENTROID_DIGITS).alias("centroid_lat"),
        F.round("centroid_lon", CENTROID_DIGITS).alias("centroid_lon"))
    return rank_desc(joined, "AQI_improvement", ["cluster"])


def kmeans_model(spark: SparkSession, sf: str, k: int = K_REGIONS):
    """The K-Means region model on the readings' distinct positions."""
    return regions.fit_regions(regions.training_points(readings(spark, sf)), k=k, seed=K_SEED)


# ---------------------------------------------------------------- queries

def q_readings_clean(spark, sf):
    return readings(spark, sf)


def q_readings_from_json(spark, sf):
    raw = tables.json_readings(spark, sf)
    return ingest.build_clean(extract_readings(raw), tables.country_codes(spark, sf))


def q_improve_by_country(spark, sf):
    return delta.day_over_day(readings(spark, sf), ["country", "country_name"])


def q_improve_by_type(spark, sf):
    # the operators on another schema: events banded directly, one entity per event type
    ev = tables.load(spark, sf, "events").select(
        "event_type", F.to_date("ts").alias("day"), band("value", PM10_THRESHOLDS).alias("idx"))
    return delta.day_over_day(ev, ["event_type"], date="day", value="idx", out="improvement")


def q_improve_by_sensor(spark, sf):
    return delta.day_over_day(readings(spark, sf), ["sensor_id"])


def q_improve_by_sensor_both_days(spark, sf):
    return delta.day_over_day(readings(spark, sf), ["sensor_id"], require_both_days=True)


def q_worst_today(spark, sf):
    return delta.level_on_day(readings(spark, sf), ["country"])


def q_top10_countries(spark, sf):
    return present.country_chart(q_improve_by_country(spark, sf), TOP_COUNTRIES)


def q_country_map(spark, sf):
    return present.country_map(tables.country_codes(spark, sf), q_worst_today(spark, sf))


def _deduped(spark, sf, **kw):
    return dedupe_before_join(tables.event_readings(spark, sf), lambda df: tables.locate(df, sf), **kw)


def q_dedup_first(spark, sf):
    return _deduped(spark, sf)


def q_dedup_by_timestamp(spark, sf):
    return _deduped(spark, sf, key=TIMESTAMP_KEY)


def q_clean_validate_first(spark, sf):
    return ingest.build_from_tables(spark, sf, validate_first=True)


def q_band_pair(spark, sf):
    ex = tables.extracted_readings(spark, sf)
    b1, b2 = band("P1", PM10_THRESHOLDS), band("P2", PM25_THRESHOLDS)
    return ex.select("id", "P1", "P2", b1.alias("band_p1"), b2.alias("band_p2"),
                     composite_index(b1, b2).alias("AQI"))


def q_nested_extract(spark, sf):
    return extract_readings(tables.raw_readings(spark, sf), match="position")


def q_reject_counts(spark, sf):
    """Lines of the nested text that the ingest cannot use, by reason (their file is the event table)."""
    lines = tables.raw_lines(spark, sf).select(F.lit("events").alias("file"), "line")
    return rejects.reject_counts(rejects.checked_lines(lines))


def q_nested_extract_by_name(spark, sf):
    return extract_readings(tables.raw_readings(spark, sf), match="name")


def q_country_counts(spark, sf):
    return readings(spark, sf).groupBy("country", "country_name").agg(
        F.count("*").alias("n_readings"), F.min("date").alias("first_date"),
        F.max("date").alias("last_date"), F.avg("AQI").alias("mean_AQI"))


def q_date_profile(spark, sf):
    return ingest.profile(readings(spark, sf))


def q_region_centroids(spark, sf):
    return _round(label_centroids(spark, sf), ["centroid_lat", "centroid_lon"], CENTROID_DIGITS)


def q_nearest_centroid(spark, sf):
    pts = tables.positions(spark, sf).select("vec_id", "latitude", "longitude")
    res = regions.nearest_centroid(pts, label_centroids(spark, sf), distance="d2")
    return _round(res.select("vec_id", "cluster", "d2"), ["d2"], DISTANCE_DIGITS)


def q_nearest_centroid_cells(spark, sf):
    pts = tables.positions(spark, sf).select("vec_id", "latitude", "longitude")
    res = cell_index.nearest_by_cells(pts, label_centroids(spark, sf), 3, distance="d2")
    return _round(res.select("vec_id", "cluster", "d2"), ["d2"], DISTANCE_DIGITS)


def q_nearest_of_many(spark, sf):
    """The nearest of many centres (the mean position of each residue of vec_id), by the cells of a grid."""
    pts = tables.positions(spark, sf).select("vec_id", "latitude", "longitude")
    centres = regions.label_centroids(pts.withColumn("part", F.expr(f"pmod(vec_id, {MANY})")), "part")
    centres = _round(centres, ["centroid_lat", "centroid_lon"], CENTROID_DIGITS)
    res = cell_index.nearest_by_cells(pts, centres, cell_index.levels_for(MANY), distance="d2")
    return _round(res.select("vec_id", "cluster", "d2"), ["d2"], DISTANCE_DIGITS)


def q_region_inertia(spark, sf):
    res = regions.inertia(tables.positions(spark, sf), label_centroids(spark, sf))
    return _round(res, ["inertia"], CENTROID_DIGITS)


def q_distinct_points(spark, sf):
    # distinct first, so each position is placed once
    return regions.nearest_centroid(regions.distinct_points(readings(spark, sf)), label_centroids(spark, sf))


def q_improve_by_region(spark, sf):
    imp = delta.day_over_day(clustered(spark, sf), ["cluster"], ranked=False)
    return _with_centroids(imp, label_centroids(spark, sf))


def q_top_regions(spark, sf):
    return present.region_chart(q_improve_by_region(spark, sf), TOP_REGIONS)


def q_top3_regions(spark, sf):
    return present.region_chart(q_improve_by_region(spark, sf), 3)


def q_region_markers(spark, sf):
    return present.region_markers(q_improve_by_region(spark, sf), TOP_REGIONS)


def q_zone_points(spark, sf):
    return present.zone_points(q_distinct_points(spark, sf), K_REGIONS)


def q_zone_sample(spark, sf):
    return present.zone_sample(q_zone_points(spark, sf), 100)


def q_nested_extract_sql(spark, sf):
    return extract_readings_sql(spark, tables.raw_readings(spark, sf))


def q_zone_centroids(spark, sf):
    return _round(present.centroid_markers(label_centroids(spark, sf)),
                  ["centroid_lat", "centroid_lon"], CENTROID_DIGITS)


def _region_streaks(spark, sf, gap="rows"):
    return runs.runs(runs.daily_flags(clustered(spark, sf), ["cluster"]), ["cluster"], gap=gap)


def _sensor_daily(spark, sf):
    return runs.daily_flags(readings(spark, sf), ["sensor_id"])


def _sensor_streaks(spark, sf, gap="rows"):
    return runs.runs(_sensor_daily(spark, sf), ["sensor_id"], gap=gap)


def q_streak_series_by_region(spark, sf):
    return _region_streaks(spark, sf)


def q_streak_series_by_sensor(spark, sf):
    return _sensor_streaks(spark, sf)


def q_streak_max_by_region(spark, sf):
    return runs.max_runs(_region_streaks(spark, sf), ["cluster"])


def q_streak_max_by_sensor(spark, sf):
    return runs.max_runs(_sensor_streaks(spark, sf), ["sensor_id"])


def q_streak_max_calendar(spark, sf):
    return runs.max_runs(_sensor_streaks(spark, sf, gap="calendar"), ["sensor_id"])


def q_streak_max_calendar_by_region(spark, sf):
    return runs.max_runs(_region_streaks(spark, sf, gap="calendar"), ["cluster"])


def q_streak_max_from_summaries(spark, sf):
    """Longest runs from summaries merged span by span, without a sort of any sensor's history."""
    return run_state.max_runs(run_state.run_summaries(_sensor_daily(spark, sf), ["sensor_id"]), ["sensor_id"])


def q_streak_max_calendar_from_summaries(spark, sf):
    daily = runs.daily_flags(clustered(spark, sf), ["cluster"])
    return run_state.max_runs(run_state.run_summaries(daily, ["cluster"], gap="calendar"), ["cluster"])


def q_streak_hist(spark, sf):
    return runs.run_histogram(_sensor_streaks(spark, sf))


def q_streak_hist_by_region(spark, sf):
    return runs.run_histogram(_region_streaks(spark, sf), ["cluster"])


def q_streak_bins(spark, sf):
    return runs.run_bins(_sensor_streaks(spark, sf), ["sensor_id"])


def q_best_region_bins(spark, sf):
    return runs.best_entity_bins(_region_streaks(spark, sf), ["cluster"])


def q_streak_tiers(spark, sf):
    res = present.streak_popups(label_centroids(spark, sf), _region_streaks(spark, sf))
    return _round(res, ["centroid_lat", "centroid_lon"], CENTROID_DIGITS)


def q_streak_summary(spark, sf):
    return runs.run_summary(_sensor_streaks(spark, sf), ["sensor_id"])


def q_overall_max_streak(spark, sf):
    return runs.overall_max_run(_sensor_streaks(spark, sf))


# K-Means: SQL cannot refit a model, but it knows what must hold of any

CHECK_K = 20
CHECK_KS = (5, 10, 20)
CHECK_GRID = 16
ELBOW_SETS = (2, 3, 5)


def q_kmeans_check(spark, sf):
    """One row: distinct positions, those without a region, those whose region is not the nearest centre,
    whether there are at most k centres, and whether the inertia is no more than the training cost."""
    pts = regions.training_points(readings(spark, sf))
    model = regions.fit_regions(pts, k=CHECK_K, seed=K_SEED)
    cents = regions.centroid_table(spark, model)
    placed = regions.assign_regions(regions.distinct_points(readings(spark, sf)), model)
    both = regions.nearest_centroid(placed, cents, out="_nearest_id", distance="_d2")
    return both.agg(
        F.count("*").alias("n_points"), F.count(F.when(F.col("cluster").isNull(), 1)).alias("n_unassigned"),
        F.count(F.when(F.col("cluster") != F.col("_nearest_id"), 1)).alias("n_mismatches"),
        F.lit(len(model.stages[-1].clusterCenters()) <= CHECK_K).alias("at_most_k"),
        (F.sum("_d2") <= F.lit(regions.training_cost(model) * (1 + 1e-9))).alias("within_cost"))


def q_kmeans_elbow_check(spark, sf):
    """Per k: the inertia is no more than the training cost, and falls from one k to the next."""
    swept = regions.elbow(spark, regions.training_points(readings(spark, sf)), CHECK_KS, seed=K_SEED)
    before = F.lag("inertia").over(Window.orderBy("k"))   # one row per k
    return swept.select("k", (F.col("inertia") <= F.col("training_cost") * (1 + 1e-9)).alias("within_cost"),
                        F.coalesce(F.col("inertia") < before, F.lit(True)).alias("falls"))


def q_training_cells(spark, sf):
    """The weighted points that a K-Means fit trains on: distinct positions reduced to a grid of 16 cells a side."""
    cells = regions.weighted_points(tables.positions(spark, sf), grid=CHECK_GRID)
    return _round(cells, ["latitude", "longitude"], CENTROID_DIGITS)


def q_elbow_inertia(spark, sf):
    """Inertia of several centre sets (means of the labels modulo k) over all positions, from one scan."""
    pts = tables.positions(spark, sf)
    sets = pts.select(F.explode(F.array(*map(F.lit, ELBOW_SETS))).alias("k"), "label", "latitude", "longitude") \
        .groupBy("k", F.expr("pmod(label, k)").alias("part")).agg(F.avg("latitude").alias("centroid_lat"), F.avg("longitude").alias("centroid_lon"))
    return _round(regions.inertias(pts, sets, ELBOW_SETS), ["inertia"], CENTROID_DIGITS)


# the models themselves (checked by properties in the tests)

def q_kmeans_centroids(spark, sf):
    return regions.centroid_table(spark, kmeans_model(spark, sf))


def q_kmeans_improve_by_region(spark, sf):
    model = kmeans_model(spark, sf)
    clean = readings(spark, sf)
    # 'today' from the readings themselves: model scoring is opaque to the
    # optimizer, so the date is resolved before it.
    imp = delta.day_over_day(regions.assign_regions(clean, model), ["cluster"],
                             as_of=delta.latest_date(clean), ranked=False)
    return _with_centroids(imp, regions.centroid_table(spark, model))


def q_kmeans_streak_max(spark, sf):
    model = kmeans_model(spark, sf)
    daily = runs.daily_flags(regions.assign_regions(readings(spark, sf), model), ["cluster"])
    return runs.max_runs(runs.runs(daily, ["cluster"]), ["cluster"])


def q_kmeans_distinct_points(spark, sf):
    model = kmeans_model(spark, sf)
    return regions.assign_regions(regions.distinct_points(readings(spark, sf)), model)


def q_kmeans_streak_tiers(spark, sf):
    model = kmeans_model(spark, sf)
    daily = runs.daily_flags(regions.assign_regions(readings(spark, sf), model), ["cluster"])
    return present.streak_popups(regions.centroid_table(spark, model), runs.runs(daily, ["cluster"]))


def q_kmeans_elbow(spark, sf):
    pts = regions.training_points(readings(spark, sf))
    return regions.elbow(spark, pts, ELBOW_KS, seed=K_SEED)


QUERIES: dict[str, Query] = {
    "readings_clean": q_readings_clean,
    "readings_from_json": q_readings_from_json,
    "improve_by_country": q_improve_by_country,
    "improve_by_type": q_improve_by_type,
    "improve_by_sensor": q_improve_by_sensor,
    "improve_by_sensor_both_days": q_improve_by_sensor_both_days,
    "worst_today": q_worst_today,
    "top10_countries": q_top10_countries,
    "country_map": q_country_map,
    "dedup_first": q_dedup_first,
    "dedup_by_timestamp": q_dedup_by_timestamp,
    "clean_validate_first": q_clean_validate_first,
    "band_pair": q_band_pair,
    "nested_extract": q_nested_extract,
    "nested_extract_by_name": q_nested_extract_by_name,
    "reject_counts": q_reject_counts,
    "country_counts": q_country_counts,
    "date_profile": q_date_profile,
    "region_centroids": q_region_centroids,
    "nearest_centroid": q_nearest_centroid,
    "nearest_centroid_cells": q_nearest_centroid_cells,
    "nearest_of_many": q_nearest_of_many,
    "region_inertia": q_region_inertia,
    "distinct_points": q_distinct_points,
    "improve_by_region": q_improve_by_region,
    "top_regions": q_top_regions,
    "region_markers": q_region_markers,
    "zone_points": q_zone_points,
    "zone_centroids": q_zone_centroids,
    "streak_series_by_region": q_streak_series_by_region,
    "streak_series_by_sensor": q_streak_series_by_sensor,
    "streak_max_by_region": q_streak_max_by_region,
    "streak_max_by_sensor": q_streak_max_by_sensor,
    "streak_max_calendar": q_streak_max_calendar,
    "streak_max_calendar_by_region": q_streak_max_calendar_by_region,
    "streak_max_from_summaries": q_streak_max_from_summaries,
    "streak_max_calendar_from_summaries": q_streak_max_calendar_from_summaries,
    "streak_hist": q_streak_hist,
    "streak_hist_by_region": q_streak_hist_by_region,
    "streak_bins": q_streak_bins,
    "best_region_bins": q_best_region_bins,
    "streak_tiers": q_streak_tiers,
    "streak_summary": q_streak_summary,
    "overall_max_streak": q_overall_max_streak,
    "nested_extract_sql": q_nested_extract_sql,
    "top3_regions": q_top3_regions,
    "zone_sample": q_zone_sample,
    "kmeans_check": q_kmeans_check,
    "kmeans_elbow_check": q_kmeans_elbow_check,
    "training_cells": q_training_cells,
    "elbow_inertia": q_elbow_inertia,
    "kmeans_centroids": q_kmeans_centroids,
    "kmeans_improve_by_region": q_kmeans_improve_by_region,
    "kmeans_streak_max": q_kmeans_streak_max,
    "kmeans_distinct_points": q_kmeans_distinct_points,
    "kmeans_streak_tiers": q_kmeans_streak_tiers,
    "kmeans_elbow": q_kmeans_elbow,
}
