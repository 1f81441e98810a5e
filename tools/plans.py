"""Print the physical plans of the main query shapes (for PLANS.md).

    python tools/plans.py [sf_dir] > /tmp/plans.txt
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n")[0]
    scans = [line for line in text.split("\n")
             if line.startswith(("PushedFilters", "PartitionFilters", "ReadSchema"))]
    return head + "\n" + "\n".join(scans)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from airlens.operators import delta, regions, runs
    from airlens.plans import catalog, present
    from airlens.sources import sinks

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sinks.write_curated(catalog.readings(spark, sf), f"{scratch}/readings")
    clean = spark.read.parquet(f"{scratch}/readings")
    model = regions.fit_regions(regions.training_points(clean), k=20, seed=42)
    clustered = regions.assign_regions(clean, model)
    from airlens.plans import ingest
    from airlens.sources import tables
    tables.nested_readings(spark, sf).write.partitionBy("date").json(f"{scratch}/json")
    shapes = {
        "ingest (JSON lines -> clean readings, no code table)": ingest.build_from_json(
            spark, f"{scratch}/json", None, glob="*.json"),
        "ingest (driver tables -> clean readings)": catalog.readings(spark, sf),
        "curated write (REBALANCE by day)": catalog.readings(spark, sf).hint("rebalance", "date"),
        "day-over-day on the curated table, literal as_of": delta.day_over_day(
            clean, ["country", "country_name"], as_of="2024-01-30"),
        "day-over-day, in-plan max(date)": delta.day_over_day(clean, ["country", "country_name"]),
        "runs per region (model-scored)": runs.runs(runs.daily_flags(clustered, ["cluster"]),
                                                    ["cluster"]),
        "nearest centroid (no join)": regions.nearest_centroid(
            clean, regions.centroid_table(spark, model)),
        "top-10 countries": present.country_chart(delta.day_over_day(clean, ["country", "country_name"],
                                                                     as_of="2024-01-30")),
    }
    for name, df in shapes.items():
        print(f"### {name}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
