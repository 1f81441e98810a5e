"""The curated table kept up day by day: only days whose readings changed are written.

Each version of the table (``versions``) is a small *manifest*, one row a day: the day, the number and a hash of its
rows (``xor`` of row hashes and their sum, so the order of rows does not matter), and the folder that
holds it. A run digests its clean readings by day, compares with the manifest, writes the days that are new or changed
to a folder of its own, and a manifest that names old folders for all other days. Readers follow the
manifest, so they see all of a run or nothing of it.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.schemas import CLEAN_COLUMNS, CURATED, PARTITION_MARK
from airlens.sources import versions
from airlens.sources.sinks import write_curated

MANIFEST = "date date, n long, mixed long, total decimal(38,0), folder string"


def _digest() -> list[Column]:
    # -0.0 and 0.0 are equal readings but hash apart
    h = F.xxhash64(*[F.col(c) + F.lit(0.0) if c in ("latitude", "longitude") else F.col(c) for c in CLEAN_COLUMNS if c != "date"])
    return [F.count("*").alias("n"), F.bit_xor(h).alias("mixed"), F.sum(h.cast("decimal(38,0)")).cast("decimal(38,0)").alias("total")]


def day_digests(clean: DataFrame) -> DataFrame:
    """(date, n, mixed, total): equal for the same rows of a day in any order and number of files."""
    return clean.groupBy("date").agg(*_digest())


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The days of the current version, None if there is none."""
    version = versions.current(spark, path)
    return None if version is None else spark.read.schema(MANIFEST).parquet(version)


def update(clean: DataFrame, path: str) -> list[datetime.date]:
    """Bring the table at ``path`` to the rows of ``clean`` (all days; none null); returns the days that were written.

    Days that ``clean`` no longer has leave the table. Without a change nothing is written, not even a manifest.
    The list of days, one entry each, is all that reaches the driver.
    """
    spark = clean.sparkSession
    found = day_digests(clean).select("date", "n", "mixed", "total")
    old = manifest(spark, path)
    old = spark.createDataFrame([], MANIFEST) if old is None else old
    before = old.select("date", F.struct("n", "mixed", "total").alias("before"), F.col("folder").alias("kept"))
    days = found.join(before, "date", "full").select("date", F.struct("n", "mixed", "total").alias("now"), "before", "kept", "n", "mixed", "total").collect()
    gone = [r.date for r in days if r.n is None]
    changed = sorted(r.date for r in days if r.n is not None and (r.before is None or r.now != r.before))
    if not changed and not gone:
        return []
    folder = f"{path}/days-{uuid.uuid4().hex}"
    if changed:
        write_curated(clean.where(F.col("date").isin(changed)), folder)
    rows = [(r.date, r.n, r.mixed, r.total, folder if r.date in set(changed) else r.kept) for r in days if r.n is not None]
    version = versions.new_version(path)
    spark.createDataFrame(sorted(rows), MANIFEST).coalesce(1).write.parquet(version)
    versions.switch(spark, path, version)
    return changed


def read(spark: SparkSession, path: str) -> DataFrame:
    """The clean readings of the current version, ``date`` marked as a partition; an error if there is none."""
    days = manifest(spark, path)
    if days is None:
        raise FileNotFoundError(f"no version at {path}")
    by_folder: dict[str, list[str]] = {}
    for r in days.select("date", "folder").collect():      # one row a day
        by_folder.setdefault(r.folder, []).append(f"{r.folder}/date={r.date.isoformat()}")
    parts = [spark.read.schema(CURATED).option("basePath", folder).parquet(*places) for folder, places in sorted(by_folder.items())]
    if not parts:
        parts = [spark.createDataFrame([], CURATED)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    marked = F.col("date").alias("date", metadata={PARTITION_MARK: True})
    return whole.select(*[marked if c == "date" else c for c in CLEAN_COLUMNS])


def latest_day(spark: SparkSession, path: str) -> datetime.date | None:
    """The last day, from the manifest alone."""
    days = manifest(spark, path)
    return None if days is None else days.agg(F.max("date")).first()[0]
