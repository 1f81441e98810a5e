from airlens.session import DEFAULTS, get_session


def test_a_running_session_keeps_its_settings(spark):
    key = "spark.sql.ansi.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        s = get_session()
        assert s.sparkContext is spark.sparkContext
        assert s.conf.get(key) == "false" and DEFAULTS[key] == "true"
        assert s.conf.get("spark.sql.shuffle.partitions") == "8"
        assert s.conf.get("spark.sql.adaptive.enabled") == "true"
    finally:
        spark.conf.set(key, before)
