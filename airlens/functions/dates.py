"""Date expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value) -> Column:
    """A typed date literal from a ``date``, an ISO string or a Column.

    An ill-formed string raises here, on the driver, instead of failing (or
    silently comparing as text) inside the job.
    """
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    if not isinstance(value, _dt.date):
        raise TypeError(f"not a date: {value!r}")
    return F.lit(value)
