"""airlens: Spark-native ranking and run-length analytics over time-stamped readings.

Common entry points::

    from airlens import build_from_json, day_over_day, level_on_day, streak_tables
    from airlens import training_points, fit_regions, assign_regions, centroid_table
"""

__version__ = "0.1.0"

from airlens.operators.delta import day_over_day, level_on_day  # noqa: E402
from airlens.operators.regions import (assign_regions, centroid_table, fit_regions,  # noqa: E402
                                       nearest_centroid, training_points)
from airlens.operators.runs import max_runs, run_histogram, runs, streak_tables  # noqa: E402
from airlens.plans.ingest import build_clean, build_from_json  # noqa: E402

__all__ = ["day_over_day", "level_on_day", "assign_regions", "centroid_table", "fit_regions",
           "nearest_centroid", "training_points", "max_runs", "run_histogram", "runs",
           "streak_tables", "build_clean", "build_from_json"]
