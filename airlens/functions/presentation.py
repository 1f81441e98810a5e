"""Presentation expressions for chart- and map-ready tables.

The original draws charts and maps on the driver; here the data each drawing
needs (colours, sizes, labels, tiers) is computed as columns, so any charting
tool can read the result tables directly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airlens.constants import (FLAT_RANGE_COLOUR, IMPROVED_COLOUR, INDEX_PALETTE,
                               MARKER_RADIUS_MAX, MARKER_RADIUS_MIN,
                               MARKER_RADIUS_SCALE, RAMP_COLOURS, SCALE_GREEN, SCALE_LOW, SCALE_LOW_BLUE, SCALE_RED,
                               STREAK_FULL_SATURATION, STREAK_TIER_GREEN,
                               STREAK_TIER_ORANGE, WORSENED_COLOUR)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _num(c) -> Column:
    return c if isinstance(c, Column) else F.lit(c)


def index_colour(index: Column | str, palette=INDEX_PALETTE) -> Column:
    """Colour of an index value: the palette slot of its integer part, clamped."""
    slot = F.greatest(F.lit(1), F.least(F.lit(len(palette)), _col(index).cast("int")))
    return F.element_at(F.array(*[F.lit(c) for c in palette]), slot)


def scaled_colour(value: Column | str, vmin, vmax) -> Column:
    """Min-max scaled red-to-green hex colour ``#rrgg55``; grey when the range is empty."""
    v, lo, hi = _col(value), _num(vmin), _num(vmax)
    norm = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(v - lo, hi - lo)))
    r = (F.lit(SCALE_RED) * (F.lit(1) - norm)).cast("int")
    g = (F.lit(SCALE_GREEN) * norm + F.lit(SCALE_LOW)).cast("int")
    return F.when(hi == lo, F.lit(FLAT_RANGE_COLOUR)).otherwise(
        F.format_string(f"#%02x%02x{SCALE_LOW_BLUE:02x}", r, g))


def _channels(hex_colour: str) -> tuple[int, int, int]:
    h = hex_colour.lstrip("#")
    return int(h[0:2], 16), int(h[2:4], 16), int(h[4:6], 16)


def ramp_colour(value: Column | str, vmin, vmax, stops=RAMP_COLOURS) -> Column:
    """Piecewise-linear colour ramp through evenly spaced ``stops`` over [vmin, vmax].

    Channels are interpolated linearly and truncated to integers. An empty
    range gives the middle stop.
    """
    v, lo, hi = _col(value), _num(vmin), _num(vmax)
    n = len(stops) - 1
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(v - lo, hi - lo)))
    seg = F.least(F.lit(n - 1), F.floor(t * n).cast("int"))
    u = t * n - seg
    rgb = [_channels(s) for s in stops]

    def channel(i: int) -> Column:
        expr = None
        for s in range(n):
            a, b = rgb[s][i], rgb[s + 1][i]
            val = (F.lit(float(a)) + F.lit(float(b - a)) * u).cast("int")
            expr = F.when(seg == s, val) if expr is None else expr.when(seg == s, val)
        return expr

    coloured = F.format_string("#%02x%02x%02x", channel(0), channel(1), channel(2))
    return F.when(hi == lo, F.lit(stops[len(stops) // 2])).otherwise(coloured)


def marker_radius(value: Column | str) -> Column:
    """Marker size: |value| scaled, clamped to [min, max]."""
    return F.greatest(F.lit(float(MARKER_RADIUS_MIN)),
                      F.least(F.lit(float(MARKER_RADIUS_MAX)),
                              F.abs(_col(value)) * F.lit(float(MARKER_RADIUS_SCALE))))


def sign_colour(value: Column | str) -> Column:
    """Improved (>= 0) or worsened colour."""
    return F.when(_col(value) >= 0, F.lit(IMPROVED_COLOUR)).otherwise(F.lit(WORSENED_COLOUR))


def signed_label(value: Column | str, digits: int = 2) -> Column:
    """Signed fixed-point text, e.g. ``+0.28``.

    Exact halves go to the even digit and a negative value keeps its sign when
    it rounds to zero (``-0.00``), as in C and Python formatting.
    """
    v = _col(value)
    text = F.format_string(f"%.{digits}f", F.bround(F.abs(v), digits))
    return F.when(v.isNotNull(), F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("+")), text))


def streak_tier(max_streak: Column | str) -> Column:
    """gray (no good day), green (>= 7), orange (>= 3), red otherwise."""
    m = _col(max_streak)
    return (F.when(m.isNull() | (m <= 0), F.lit("gray"))
            .when(m >= STREAK_TIER_GREEN, F.lit("green"))
            .when(m >= STREAK_TIER_ORANGE, F.lit("orange"))
            .otherwise(F.lit("red")))


def streak_saturation(max_streak: Column | str) -> Column:
    """min(1, max_streak / 14)."""
    return F.least(F.lit(1.0), _col(max_streak).cast("double") / F.lit(float(STREAK_FULL_SATURATION)))


def palette_slot(key: Column | str, n_slots: int) -> Column:
    """Non-negative palette slot of an integer key."""
    return F.pmod(_col(key), F.lit(n_slots)).cast("int")
