"""End-to-end batch job: ingest, the three analyses, chart and map tables.

    spark-submit --py-files airlens.zip run_job.py --readings <dir> --codes <file> --out <dir>
    python -m airlens.plans.job --tables /root/testdata/sf0.1 --out <dir>

Every result is written as a Parquet table under ``--out`` (``run`` returns the folders; that of the
clean readings and the model are versions behind a pointer, see ``sources.versions``). The clean
readings are written once, partitioned by day, and every analysis reads that
table back: the lineage is cut there (a lost executor recomputes from the
written table, not from the raw text), and day filters prune partitions.
"""

from __future__ import annotations

import argparse
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.constants import ELBOW_KS, K_REGIONS, K_SEED, TOP_COUNTRIES, TOP_REGIONS
from airlens.operators import delta, regions, runs
from airlens.operators.clean import DAY_KEY, TIMESTAMP_KEY
from airlens.operators.ranking import rank_desc
from airlens.plans import ingest, present
from airlens.sources import rejects, sinks, tables, versions
from airlens.sources.json_readings import READINGS_GLOB, InputError, read_country_codes
from airlens.sources.ledger import Ledger, key_of
from airlens.sources.paths import exists


@dataclass
class JobOptions:
    out: str
    readings: str | None = None          # folder of JSON-lines readings
    readings_glob: str | None = READINGS_GLOB
    codes: str | None = None             # JSON array of country codes
    tables: str | None = None            # or: folder of the driver's Parquet tables
    k: int = K_REGIONS
    seed: int = K_SEED
    model_path: str | None = None
    retrain: bool = False
    elbow: bool = False
    elbow_ks: tuple[int, ...] = ELBOW_KS
    maps: bool = True
    gap: str = "rows"
    match: str = "position"
    dedupe_on: str = "day"               # "day" (original) or "timestamp"
    validate_first: bool = False
    require_both_days: bool = False
    as_of: str | None = None
    previous: str | None = None          # comparison day (default: the day before as_of)
    top_countries: int = TOP_COUNTRIES
    top_regions: int = TOP_REGIONS
    training_partitions: int = regions.TRAINING_PARTITIONS
    train_on: str = "positions"          # "positions" (original), "sensors" or "cells" (weighted grid)
    grid: int = regions.TRAINING_GRID    # cells along the longer side, for train_on="cells"
    geometry: str = "degrees"            # "degrees" (original) or "sphere"
    rejects: bool = False                # write the bad lines of the JSON files, and their counts per file
    most_bad: float | None = None        # fail if a larger share of the lines is bad
    resume: bool = False                 # skip what an earlier run with the same options and files has finished
    concurrency: int = 4                 # independent branches submitted side by side
    timings: dict[str, float] = field(default_factory=dict)


class _Timer:
    def __init__(self, timings: dict[str, float], name: str):
        self.timings, self.name = timings, name

    def __enter__(self):
        self.t0 = time.perf_counter()

    def __exit__(self, *exc):
        self.timings[self.name] = round(time.perf_counter() - self.t0, 3)


def _clean(spark: SparkSession, o: JobOptions) -> tuple[DataFrame, DataFrame | None]:
    key = DAY_KEY if o.dedupe_on == "day" else TIMESTAMP_KEY
    if o.tables:
        return ingest.build_from_tables(spark, o.tables, key, o.validate_first), tables.country_codes(spark, o.tables)
    codes = read_country_codes(spark, o.codes)
    clean = ingest.build_from_json(spark, o.readings, o.codes, match=o.match, key=key,
                                   validate_first=o.validate_first, glob=o.readings_glob)
    return clean, codes


def _key(spark: SparkSession, o: JobOptions) -> str:
    """Digest of the input files and of every option that results depend on."""
    fixed = {k: v for k, v in vars(o).items() if k not in ("out", "concurrency", "resume", "timings")}
    return key_of(spark, fixed, [p for p in (o.readings, o.codes, o.tables) if p])


def run(spark: SparkSession, o: JobOptions) -> dict[str, str]:
    """Run the job; returns {table name: path}. Timings go to ``o.timings``.

    Independent branches (the country analysis and the region fit; the
    result tables of one stage) are submitted from separate threads, so
    Spark runs their jobs side by side instead of leaving executors idle
    during small jobs (``concurrency=1`` runs them one after another).

    With ``resume`` each finished table is noted under a digest of the options and input files, and a run
    with the same digest goes on after the last one (the model is kept under ``out`` then).
    """
    out = o.out.rstrip("/")
    written: dict[str, str] = {}
    tm = o.timings
    done = Ledger(spark, out, _key(spark, o) if o.resume else None)
    model_path = o.model_path or (f"{out}/model" if o.resume else None)

    def save(name: str, df: DataFrame) -> None:
        path = f"{out}/{name}"
        if done.has(name):
            written[name] = path
            return
        # thread-local: names the Spark jobs of this write in the event log
        spark.sparkContext.setJobDescription(f"airlens: write {name}")
        sinks.write_table(df, path)
        done.add(name)
        written[name] = path

    def together(*tasks) -> None:
        if o.concurrency <= 1 or len(tasks) == 1:
            for t in tasks:
                t()
            return
        with ThreadPoolExecutor(max_workers=min(o.concurrency, len(tasks))) as pool:
            for f in [pool.submit(t) for t in tasks]:
                f.result()

    if o.readings and (o.rejects or o.most_bad is not None):
        with _Timer(tm, "rejects"):
            checked = rejects.checked_lines(rejects.read_lines(spark, o.readings, o.readings_glob), o.match)
            save("reject_counts", rejects.reject_counts(checked))
            if o.rejects:
                save("rejected_lines", rejects.rejected(checked))
            if o.most_bad is not None:
                rejects.check_share(sinks.read_table(spark, written["reject_counts"]), o.most_bad)

    # 1. ingest -> curated readings (partitioned by day), read back
    with _Timer(tm, "ingest"):
        spark.sparkContext.setJobDescription("airlens: ingest")
        clean, codes = _clean(spark, o)
        version = done.value("readings") if done.has("readings") else None
        # a version of its own: readers keep that of an earlier run until this one is known to hold rows
        fresh = version is None or not exists(spark, version)
        if fresh:
            version = versions.new_version(f"{out}/readings")
            sinks.write_curated(clean, version)
        prof = ingest.profile(sinks.read_curated(spark, version)).first()   # one small aggregate
        if not prof["rows"]:
            raise InputError("no clean readings")
        if fresh:
            versions.switch(spark, f"{out}/readings", version)
            done.add("readings", version)
        written["readings"] = version
        clean = sinks.read_curated(spark, version)
        as_of = o.as_of or prof["last_date"]

    # 2. countries, alongside 3a. the region fit (both only read the curated table)
    def countries() -> None:
        spark.sparkContext.setJobDescription("airlens: countries")
        with _Timer(tm, "countries"):
            save("profile", spark.createDataFrame([prof], ingest.profile(clean).schema).coalesce(1))
            improvement = delta.day_over_day(clean, ["country", "country_name"], as_of=as_of,
                                             previous=o.previous,
                                             require_both_days=o.require_both_days)
            save("country_improvement", improvement)
            improvement = sinks.read_table(spark, written["country_improvement"])
            together(lambda: save("country_chart", present.country_chart(improvement, o.top_countries)),
                     lambda: save("worst_today", delta.level_on_day(clean, ["country"], as_of=as_of)))

    def fit() -> None:
        spark.sparkContext.setJobDescription("airlens: region fit")
        fitted = ["centroids", "region_fit", "clustered", *(["elbow"] if o.elbow else [])]
        if done.has(*fitted):
            written.update({name: f"{out}/{name}" for name in fitted})
            return
        with _Timer(tm, "regions_fit"):
            weight = regions.WEIGHT if o.train_on == "cells" else None
            if weight:
                source = regions.weighted_points(clean, grid=o.grid)
            else:
                source = regions.distinct_points(regions.sensor_points(clean) if o.train_on == "sensors" else clean)
            source = source.persist(StorageLevel.MEMORY_AND_DISK)
            # read by the fingerprint, the fit, the inertia and the elbow
            points = regions.laid_out(source, source.count(), tasks=o.training_partitions).persist(StorageLevel.MEMORY_AND_DISK)
            model = regions.fit_regions(points, k=o.k, seed=o.seed, model_path=model_path,
                                        retrain=o.retrain and not done.has("cost"), geometry=o.geometry, weight=weight)
            centroids = regions.centroid_table(spark, model)
            save("centroids", centroids)
            cost = regions.training_cost(model)
            if done.has("cost"):
                cost = float(done.value("cost"))      # of the fit of the run that did not finish
            elif cost is not None:
                done.add("cost", repr(float(cost)))
            fit_row = regions.inertia(points, centroids, weight=weight).withColumn(
                "training_cost", F.lit(cost).cast("double"))
            tasks = [lambda: save("region_fit", fit_row)]
            if o.elbow:
                tasks.append(lambda: save("elbow", regions.elbow(spark, points, o.elbow_ks, seed=o.seed, weight=weight)))
            # every position is scored once; all later branches read this table

            def cluster() -> None:
                sinks.write_curated(regions.assign_positions(clean, model), f"{out}/clustered")
                done.add("clustered")

            together(*tasks, *([] if done.has("clustered") else [cluster]))
            written["clustered"] = f"{out}/clustered"
            points.unpersist()
            source.unpersist()

    together(countries, fit)

    # 3b. score and rank regions, alongside 4. the runs of good days per region
    # (which need the model but not the ranking) and the zone-map tables
    clustered = sinks.read_clustered(spark, written["clustered"])
    cents = sinks.read_table(spark, written["centroids"])

    def rank() -> None:
        spark.sparkContext.setJobDescription("airlens: region rank")
        with _Timer(tm, "regions_rank"):
            region_imp = (delta.day_over_day(clustered, ["cluster"], as_of=as_of, previous=o.previous,
                                             require_both_days=o.require_both_days, ranked=False)
                          .join(cents, "cluster", "left")
                          .select("cluster", "AQI_improvement", "centroid_lat", "centroid_lon"))
            save("region_improvement", rank_desc(region_imp, "AQI_improvement", ["cluster"]))
            region_imp = sinks.read_table(spark, written["region_improvement"])
            save("region_chart", present.region_chart(region_imp, o.top_regions))
            if o.maps:
                save("region_markers", present.region_markers(region_imp, o.top_regions))

    def streaks() -> None:
        spark.sparkContext.setJobDescription("airlens: streaks")
        with _Timer(tm, "streaks"):
            daily = runs.daily_flags(clustered, ["cluster"])
            save("streak_series", runs.runs(daily, ["cluster"], gap=o.gap))
            with_streak = sinks.read_table(spark, written["streak_series"])
            save("max_streaks", runs.max_runs(with_streak, ["cluster"]))
            tasks = [
                lambda: save("streak_distribution", runs.run_histogram(with_streak)),
                lambda: save("streak_by_region", runs.run_histogram(with_streak, ["cluster"])),
                lambda: save("best_region_bins", runs.best_entity_bins(with_streak, ["cluster"])),
                lambda: save("streak_summary", runs.run_summary(with_streak, ["cluster"])),
                lambda: save("streak_axis", runs.overall_max_run(with_streak)),
            ]
            if o.maps:
                tasks.append(lambda: save("streak_popups", present.streak_popups(cents, with_streak)))
            together(*tasks)

    def maps() -> None:
        spark.sparkContext.setJobDescription("airlens: maps")
        with _Timer(tm, "maps"):
            tasks = [
                lambda: save("zone_points", present.zone_points(
                    regions.distinct_points(clustered, extra=["cluster"]), n_slots=o.k)),
                lambda: save("zone_centroids", present.centroid_markers(cents)),
            ]
            if codes is not None:
                tasks.append(lambda: save("country_map", present.country_map(
                    codes, sinks.read_table(spark, written["worst_today"]))))
            together(*tasks)

    together(rank, streaks, maps) if o.maps else together(rank, streaks)
    for kept in (f"{out}/readings", model_path):
        if kept:
            versions.clean_up(spark, kept)
    return written


def _parse(argv=None) -> JobOptions:
    p = argparse.ArgumentParser(description="Ranking and run-length analysis of readings")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--readings", help="folder of JSON-lines reading files")
    src.add_argument("--tables", help="folder of the driver's Parquet tables")
    p.add_argument("--codes", help="country-code JSON array")
    p.add_argument("--out", required=True, help="output folder (shared file system)")
    p.add_argument("--model-path")
    p.add_argument("--retrain", action="store_true")
    p.add_argument("--elbow", action="store_true")
    p.add_argument("--elbow-ks", default=",".join(map(str, ELBOW_KS)),
                   help="comma-separated k values of the elbow sweep")
    p.add_argument("--no-maps", action="store_true")
    p.add_argument("--k", type=int, default=K_REGIONS)
    p.add_argument("--seed", type=int, default=K_SEED)
    p.add_argument("--gap", choices=["rows", "calendar"], default="rows")
    p.add_argument("--match", choices=["position", "name"], default="position")
    p.add_argument("--dedupe-on", choices=["day", "timestamp"], default="day")
    p.add_argument("--validate-first", action="store_true")
    p.add_argument("--require-both-days", action="store_true")
    p.add_argument("--readings-glob", default=READINGS_GLOB, help="names of the reading files in the folder")
    p.add_argument("--top-countries", type=int, default=TOP_COUNTRIES)
    p.add_argument("--top-regions", type=int, default=TOP_REGIONS)
    p.add_argument("--training-partitions", type=int, default=regions.TRAINING_PARTITIONS,
                   help="partitions of a K-Means training set of ordinary size (part of the model's definition, like the seed)")
    p.add_argument("--grid", type=int, default=regions.TRAINING_GRID,
                   help="cells along the longer side of the positions' bounding box, for --train-on cells")
    p.add_argument("--as-of")
    p.add_argument("--previous", help="comparison day (default: the day before --as-of)")
    p.add_argument("--resume", action="store_true",
                   help="go on after a run with the same options and input files that did not finish")
    p.add_argument("--rejects", action="store_true", help="write the bad lines of the JSON files and their counts")
    p.add_argument("--most-bad", type=float, help="fail if a larger share of the lines is bad")
    p.add_argument("--concurrency", type=int, default=4,
                   help="independent branches submitted side by side (1 = one after another)")
    p.add_argument("--train-on", choices=["positions", "sensors", "cells"], default="positions",
                   help="K-Means training points: distinct positions, one mean per sensor, or weighted grid cells")
    p.add_argument("--geometry", choices=["degrees", "sphere"], default="degrees",
                   help="K-Means distance: raw degrees or unit-sphere vectors")
    a = p.parse_args(argv)
    return JobOptions(out=a.out, readings=a.readings, codes=a.codes, tables=a.tables,
                      k=a.k, seed=a.seed, model_path=a.model_path, retrain=a.retrain,
                      elbow=a.elbow, elbow_ks=tuple(int(k) for k in a.elbow_ks.split(",") if k),
                      maps=not a.no_maps, gap=a.gap, match=a.match,
                      dedupe_on=a.dedupe_on, validate_first=a.validate_first,
                      require_both_days=a.require_both_days, as_of=a.as_of, previous=a.previous,
                      readings_glob=a.readings_glob, top_countries=a.top_countries, top_regions=a.top_regions,
                      training_partitions=a.training_partitions, train_on=a.train_on, grid=a.grid, geometry=a.geometry,
                      resume=a.resume, rejects=a.rejects, most_bad=a.most_bad, concurrency=a.concurrency)


def main(argv=None) -> None:
    from airlens.session import get_session
    opts = _parse(argv)
    spark = get_session("airlens-job")
    run(spark, opts)
    print({"timings": opts.timings})


if __name__ == "__main__":
    main()
