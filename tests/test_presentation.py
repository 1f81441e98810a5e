from pyspark.sql import functions as F

from airlens.functions import presentation as P


def one(spark, expr, value, typ="double"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("o")).first().o


def test_marker_radius(spark):
    assert [one(spark, P.marker_radius, v) for v in (0.1, -1.5, 4.0)] == [5.0, 12.0, 20.0]


def test_index_colour_slots(spark):
    from airlens.constants import INDEX_PALETTE
    assert one(spark, P.index_colour, 0.4) == INDEX_PALETTE[0]
    assert one(spark, P.index_colour, 3.9) == INDEX_PALETTE[2]
    assert one(spark, P.index_colour, 12.0) == INDEX_PALETTE[9]


def test_scaled_colour(spark):
    assert one(spark, lambda c: P.scaled_colour(c, 0.0, 2.0), 2.0) == "#00ff55"
    assert one(spark, lambda c: P.scaled_colour(c, 0.0, 2.0), 0.0) == "#ff3755"
    assert one(spark, lambda c: P.scaled_colour(c, 1.0, 1.0), 1.0) == "#808080"


def test_ramp_colour_stops(spark):
    from airlens.constants import RAMP_COLOURS
    assert one(spark, lambda c: P.ramp_colour(c, 0.0, 2.0), 0.0) == RAMP_COLOURS[0]
    assert one(spark, lambda c: P.ramp_colour(c, 0.0, 2.0), 1.0) == RAMP_COLOURS[1]
    assert one(spark, lambda c: P.ramp_colour(c, 0.0, 2.0), 2.0) == RAMP_COLOURS[2]
    assert one(spark, lambda c: P.ramp_colour(c, 3.0, 3.0), 3.0) == RAMP_COLOURS[1]


def test_labels(spark):
    assert one(spark, lambda c: P.signed_label(c, 2), 0.278) == "+0.28"
    assert one(spark, lambda c: P.signed_label(c, 3), 0.278) == "+0.278"
    assert one(spark, lambda c: P.signed_label(c, 2), -1.5) == "-1.50"


def test_tiers_and_slots(spark):
    assert [one(spark, P.streak_tier, v, "int") for v in (None, 0, 1, 3, 7)] == \
        ["gray", "gray", "red", "orange", "green"]
    assert one(spark, P.streak_saturation, 28, "int") == 1.0
    assert one(spark, lambda c: P.palette_slot(c, 100), -3, "int") == 97
    assert one(spark, P.sign_colour, 0.0) == "#2ecc71"


def test_hand_worked_values(spark):
    """Values worked out by hand for a scale from 0 to 4."""
    from pyspark.sql import functions as F

    from airlens.functions import presentation as P
    rows = [  # value, scaled colour, marker radius, colour slot, max run, tier
        (0.0, "#ff3755", 5.0, "#00e400", 0, "gray"),
        (1.0, "#bf6955", 8.0, "#00e400", 2, "red"),
        (2.0, "#7f9b55", 16.0, "#92d050", 3, "orange"),
        (4.0, "#00ff55", 20.0, "#ff7e00", 7, "green"),
        (-3.0, "#ff3755", 20.0, "#00e400", -1, "gray"),
        (12.5, "#00ff55", 20.0, "#7e0023", 100, "green")]
    df = spark.createDataFrame([(r[0], r[4]) for r in rows], "v double, m int")
    got = df.select(P.scaled_colour("v", F.lit(0.0), F.lit(4.0)), P.marker_radius("v"), P.index_colour("v"),
                    P.streak_tier("m")).collect()
    assert [tuple(g) for g in got] == [(r[1], r[2], r[3], r[5]) for r in rows]
    flat = df.select(P.scaled_colour("v", F.lit(1.0), F.lit(1.0)).alias("c")).distinct().collect()
    assert [r.c for r in flat] == ["#808080"]


def test_labels_round_halves_to_even_and_keep_the_sign(spark):
    from airlens.functions import presentation as P
    cases = [(0.125, "+0.12"), (0.375, "+0.38"), (0.625, "+0.62"), (-0.125, "-0.12"), (-0.001, "-0.00"), (0.0, "+0.00"),
             (1.005, "+1.00"), (2.5, "+2.50"), (-10.999, "-11.00"), (None, None)]
    df = spark.createDataFrame([(v,) for v, _ in cases], "v double")
    assert [r[0] for r in df.select(P.signed_label("v", 2)).collect()] == [t for _, t in cases]
