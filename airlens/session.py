"""Session helpers.

The library never sets ``master``: on a cluster the session comes from
spark-submit. ``get_session`` only fills in defaults for keys the cluster
configuration leaves unset, so the cluster's own settings (shuffle
partitions, time zone, checkpoint folder, ...) win.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size coalesced partitions by the advisory size, not by the core count:
    # fewer tiny tasks (the setting Spark recommends for busy clusters)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs one more shuffle
    # (e.g. a hot sensor in a sort-merge join whose output feeds the dedupe)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def get_session(app_name: str = "airlens", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one.

    ``master`` is only for local runs and tests; leave it ``None`` under
    spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    running = SparkSession.getActiveSession()
    spark = builder.getOrCreate()
    if running is None:  # a running session keeps its own settings
        given = spark.conf.getAll
        for key, value in DEFAULTS.items():
            if key not in given:
                spark.conf.set(key, value)
    return spark
