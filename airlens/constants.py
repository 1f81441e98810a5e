"""Fixed values.

These values must equal the ones the original pipeline uses, otherwise the
banding, the good-day test, the region model and the presentation tables give
different results. They are stated here once, in their natural order.
"""

# --- fixed values: index banding (European CAQI style, 1 = best, 10 = worst) ---
# A value is in band i when it is <= the i-th threshold; above the last one it is band 10.
PM10_THRESHOLDS = (16, 33, 50, 58, 66, 75, 83, 91, 100)
PM25_THRESHOLDS = (11, 23, 35, 41, 47, 53, 58, 64, 70)

# --- fixed values: cleaning (open intervals: low < value < high) ---
P1_BOUNDS = (0, 1000)
P2_BOUNDS = (0, 500)

# --- fixed values: analyses ---
GOOD_INDEX_LIMIT = 3          # a day is good when its mean index is <= 3
K_REGIONS = 100               # K-Means regions
K_SEED = 42
TOP_COUNTRIES = 10
TOP_REGIONS = 50
ELBOW_KS = tuple(range(10, 101, 10))
SAMPLE_POINTS = 5000          # points shown on the region-zone map
DEFAULT_MAX_STREAK = 22       # axis length used when no streak exists at all

# --- fixed values: presentation ---
INDEX_PALETTE = ("#00e400", "#92d050", "#ffff00", "#ff7e00", "#ff0000",
                 "#8f3f97", "#7e0023", "#7e0023", "#7e0023", "#7e0023")
IMPROVED_COLOUR = "#2ecc71"
WORSENED_COLOUR = "#e74c3c"
RAMP_COLOURS = ("#e74c3c", "#f39c12", "#2ecc71")   # low, middle, high
NO_DATA_COLOUR = "#ededed"
FLAT_RANGE_COLOUR = "#808080"
SCALE_RED = 255               # scaled colour: red falls from here to 0,
SCALE_GREEN, SCALE_LOW = 200, 55   # green rises by this much from there,
SCALE_LOW_BLUE = 0x55         # blue stays
MARKER_RADIUS_MIN = 5
MARKER_RADIUS_MAX = 20
MARKER_RADIUS_SCALE = 8
STREAK_TIER_GREEN = 7         # max streak >= 7 -> green
STREAK_TIER_ORANGE = 3        # max streak >= 3 -> orange, else red; none -> gray
STREAK_FULL_SATURATION = 14   # days at which the streak saturation reaches 1
# marker texts (printf-style templates: region id, then the value)
TOOLTIP_IMPROVEMENT = "Cluster %s<br>AQI improvement: %s"
TOOLTIP_STREAK = "Cluster %s \u2014 max streak: %s days"
TOOLTIP_NO_STREAK = "Cluster %s: no good air days recorded"
TOOLTIP_CENTROID = "Cluster %s centroid"
