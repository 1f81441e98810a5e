import pytest
from pyspark.sql import functions as F

from airlens.constants import PM10_THRESHOLDS, PM25_THRESHOLDS
from airlens.functions.bands import band, pm_index

# (P1, band P1, P2, band P2, index) worked by hand from the thresholds
CASES = [
    (16.0, 1, 11.0, 1, 1),
    (16.01, 2, 11.0, 1, 2),
    (16.0, 1, 11.01, 2, 2),
    (50.0, 3, 35.0, 3, 3),
    (100.0, 9, 70.0, 9, 9),
    (100.01, 10, 5.0, 1, 10),
    (5.0, 1, 70.01, 10, 10),
]


def test_band_table(spark):
    df = spark.createDataFrame([(c[0], c[2]) for c in CASES], "P1 double, P2 double")
    got = df.select(band("P1", PM10_THRESHOLDS).alias("b1"), band("P2", PM25_THRESHOLDS).alias("b2"),
                    pm_index().alias("aqi")).collect()
    assert [(r.b1, r.b2, r.aqi) for r in got] == [(c[1], c[3], c[4]) for c in CASES]


def test_null_and_nan_stay_null(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    got = [r[0] for r in df.select(band("v", PM10_THRESHOLDS)).collect()]
    assert got == [None, None]


def test_index_type_is_int(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "P1 double, P2 double")
    assert dict(df.select(pm_index().alias("a")).dtypes)["a"] == "int"


def test_thresholds_must_ascend():
    with pytest.raises(ValueError):
        band(F.col("x"), [3, 2, 1])
