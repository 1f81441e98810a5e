"""Column expressions (JVM-side, no Python UDFs)."""

from airlens.functions.bands import band, composite_index, pm_index
from airlens.functions.dates import as_date
from airlens.functions import presentation

__all__ = ["band", "composite_index", "pm_index", "as_date",
           "presentation"]
