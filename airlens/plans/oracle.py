"""DuckDB oracles: for each registered query that SQL can express, an
independent ANSI-SQL formulation over the same tables (registered as views).

Where the Spark plan is rewritten (one-pass day-over-day, aggregate dedupe,
higher-order arg-min), the SQL keeps the straightforward shape (signed sum
of daily means, row_number dedupe, window arg-min), so the two check each
other. The role mapping of the tables is the one in ``airlens.sources.tables``.
"""

from __future__ import annotations

from airlens.constants import (GOOD_INDEX_LIMIT, INDEX_PALETTE, K_REGIONS, NO_DATA_COLOUR,
                               PM10_THRESHOLDS, PM25_THRESHOLDS, RAMP_COLOURS, 
                               TOOLTIP_CENTROID, TOOLTIP_IMPROVEMENT, TOOLTIP_NO_STREAK,
                               TOOLTIP_STREAK, TOP_COUNTRIES, TOP_REGIONS)

def _case(col: str, thresholds) -> str:
    arms = " ".join(f"WHEN {col} <= {t} THEN {i}" for i, t in enumerate(thresholds, 1))
    return f"CASE WHEN {col} IS NULL OR isnan({col}) THEN NULL {arms} ELSE {len(thresholds) + 1} END"


_B1 = _case("P1", PM10_THRESHOLDS)
_B2 = _case("P2", PM25_THRESHOLDS)
_PALETTE = "[" + ", ".join(f"'{c}'" for c in INDEX_PALETTE) + "]"

EXTRACTED = """
extracted AS (
  SELECT e.event_id AS id, e.ts, CAST(c.c_nationkey AS VARCHAR) AS country,
         CAST(m.embedding[1] AS DOUBLE) AS latitude, CAST(m.embedding[2] AS DOUBLE) AS longitude,
         e.user_id AS sensor_id, CAST(e.ts AS DATE) AS date, e.value AS P1,
         TRY_CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS P2
  FROM events e
  LEFT JOIN embeddings m ON m.vec_id = e.user_id
  LEFT JOIN customer c ON c.c_custkey = e.user_id
)"""

CODES = """
codes AS (
  SELECT CAST(n.n_nationkey AS VARCHAR) AS alpha2, n.n_name AS alpha3,
         n.n_name || ' (' || r.r_name || ')' AS country_name
  FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

_VALID = ("latitude IS NOT NULL AND longitude IS NOT NULL AND P1 IS NOT NULL AND P2 IS NOT NULL "
          "AND date IS NOT NULL AND country IS NOT NULL "
          "AND P1 > 0 AND P1 < 1000 AND P2 > 0 AND P2 < 500")

_DEDUP = """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sensor_id, date, latitude, longitude ORDER BY ts, id) AS rn
    FROM {src}) WHERE rn = 1"""


def _readings_cte(validate_first: bool = False, seconds: bool = False) -> str:
    if validate_first:
        steps = (f"valid AS (SELECT * FROM extracted WHERE {_VALID}),\n"
                 f"dedup AS ({_DEDUP.format(src='valid')}),\n"
                 "kept AS (SELECT * FROM dedup)")
    else:
        steps = (f"dedup AS ({_DEDUP.format(src='extracted')}),\n"
                 f"kept AS (SELECT * FROM dedup WHERE {_VALID})")
    extracted = EXTRACTED.replace("SELECT e.event_id AS id, e.ts,",
                                  "SELECT e.event_id AS id, date_trunc('second', e.ts) AS ts,") \
        if seconds else EXTRACTED
    return f"""WITH {extracted},
{steps},
banded AS (
  SELECT country, latitude, longitude, sensor_id, date,
         CAST(greatest({_B1}, {_B2}) AS INTEGER) AS AQI
  FROM kept
),
{CODES},
readings AS (
  SELECT k.alpha3 AS country, k.country_name, b.latitude, b.longitude, b.sensor_id, b.date, b.AQI
  FROM banded b LEFT JOIN codes k ON b.country = k.alpha2
)"""


READINGS = _readings_cte()

CENTROIDS = """
centroids AS (
  SELECT label AS cluster, avg(CAST(embedding[1] AS DOUBLE)) AS centroid_lat,
         avg(CAST(embedding[2] AS DOUBLE)) AS centroid_lon
  FROM embeddings GROUP BY label
)"""

CLUSTERED = f"""{READINGS},
{CENTROIDS},
pts AS (SELECT DISTINCT latitude, longitude FROM readings),
assign AS (
  SELECT latitude, longitude, cluster FROM (
    SELECT p.latitude, p.longitude, c.cluster,
           row_number() OVER (PARTITION BY p.latitude, p.longitude
             ORDER BY (p.latitude - c.centroid_lat) * (p.latitude - c.centroid_lat)
                    + (p.longitude - c.centroid_lon) * (p.longitude - c.centroid_lon), c.cluster) AS rn
    FROM pts p, centroids c) WHERE rn = 1
),
clustered AS (
  SELECT r.*, a.cluster FROM readings r JOIN assign a USING (latitude, longitude)
)"""


def _improvement(src: str, keys: str, both: bool = False) -> str:
    having = "HAVING count(*) = 2" if both else ""
    return f"""
as_of AS (SELECT max(date) AS d FROM {src}),
daily AS (
  SELECT {keys}, date, avg(AQI) AS a FROM {src}
  WHERE date = (SELECT d FROM as_of) OR date = (SELECT d FROM as_of) - 1
  GROUP BY {keys}, date
),
improvement AS (
  SELECT {keys}, sum(CASE WHEN date = (SELECT d FROM as_of) THEN -a ELSE a END) AS AQI_improvement
  FROM daily GROUP BY {keys} {having}
)"""


def _label(v: str, digits: int) -> str:
    return f"printf('%+.{digits}f', {v})"


def _streaks(src: str, key: str, calendar: bool = False) -> str:
    if calendar:
        grp = ("CAST(date_diff('day', DATE '1970-01-01', date) "
               f"- row_number() OVER (PARTITION BY {key}, LowIndex ORDER BY date) AS INTEGER)")
        cont = "(LowIndex = next_LowIndex AND next_date = date + 1)"
        extra = f", lead(date) OVER (PARTITION BY {key} ORDER BY date) AS next_date"
    else:
        grp = (f"CAST(row_number() OVER (PARTITION BY {key} ORDER BY date) "
               f"- row_number() OVER (PARTITION BY {key}, LowIndex ORDER BY date) AS INTEGER)")
        cont = "LowIndex = next_LowIndex"
        extra = ""
    return f"""
daily_flags AS (
  SELECT {key}, date, avg(AQI) AS avg_AQI,
         CASE WHEN avg(AQI) <= {GOOD_INDEX_LIMIT} THEN 1 ELSE 0 END AS LowIndex
  FROM {src} GROUP BY {key}, date
),
g AS (
  SELECT *, lead(LowIndex) OVER (PARTITION BY {key} ORDER BY date) AS next_LowIndex,
         {grp} AS grp {extra}
  FROM daily_flags
),
with_streak AS (
  SELECT {key}, date, avg_AQI, LowIndex, next_LowIndex, grp,
         CASE WHEN LowIndex = 0 OR {cont} THEN 0
              ELSE CAST(row_number() OVER (PARTITION BY {key}, LowIndex, grp ORDER BY date) AS INTEGER)
         END AS streak
  FROM g
)"""


def _bins(key: str) -> str:
    return f"""
counts AS (SELECT {key}, streak, count(*) AS cnt FROM with_streak WHERE streak > 0 GROUP BY {key}, streak),
bins AS (
  SELECT {key}, CAST(s.streak AS INTEGER) AS streak FROM
    (SELECT {key}, max(streak) AS mx FROM counts GROUP BY {key}) m,
    LATERAL (SELECT unnest(generate_series(0, m.mx)) AS streak) s
),
binned AS (
  SELECT b.{key}, b.streak, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
  FROM bins b LEFT JOIN counts c ON c.{key} = b.{key} AND c.streak = b.streak
)"""


def _ramp_channel(i: int) -> str:
    vals = [int(c.lstrip("#")[2 * i:2 * i + 2], 16) for c in RAMP_COLOURS]
    a, b, c = vals
    return (f"CASE WHEN seg = 0 THEN CAST(trunc({a}.0 + {b - a}.0 * u) AS INTEGER) "
            f"ELSE CAST(trunc({b}.0 + {c - b}.0 * u) AS INTEGER) END")


ORACLE: dict[str, str] = {
    "readings_clean": f"{READINGS} SELECT * FROM readings",
    "readings_from_json": f"{_readings_cte(seconds=True)} SELECT * FROM readings",
    "improve_by_country": f"{READINGS}, {_improvement('readings', 'country, country_name')} "
                          "SELECT * FROM improvement",
    "improve_by_type": f"""WITH ev AS (
  SELECT event_type, CAST(ts AS DATE) AS day, {_case('value', PM10_THRESHOLDS)} AS idx FROM events
),
d AS (SELECT max(day) AS t FROM ev),
daily AS (
  SELECT event_type, day, avg(idx) AS a FROM ev
  WHERE day = (SELECT t FROM d) OR day = (SELECT t FROM d) - 1 GROUP BY event_type, day
)
SELECT event_type, sum(CASE WHEN day = (SELECT t FROM d) THEN -a ELSE a END) AS improvement
FROM daily GROUP BY event_type""",
    "improve_by_sensor": f"{READINGS}, {_improvement('readings', 'sensor_id')} SELECT * FROM improvement",
    "improve_by_sensor_both_days": f"{READINGS}, {_improvement('readings', 'sensor_id', both=True)} "
                                   "SELECT * FROM improvement",
    "worst_today": f"""{READINGS}
SELECT country, avg(AQI) AS avg_AQI FROM readings
WHERE date = (SELECT max(date) FROM readings) GROUP BY country""",
    "top10_countries": f"""{READINGS}, {_improvement('readings', 'country, country_name')}
SELECT country, country_name, AQI_improvement,
       CASE WHEN AQI_improvement >= 0 THEN '#2ecc71' ELSE '#e74c3c' END AS colour,
       {_label('AQI_improvement', 2)} AS label
FROM improvement ORDER BY AQI_improvement DESC NULLS LAST, country NULLS FIRST LIMIT {TOP_COUNTRIES}""",
    "country_map": f"""{READINGS},
worst AS (SELECT country, avg(AQI) AS avg_AQI FROM readings
          WHERE date = (SELECT max(date) FROM readings) GROUP BY country),
countries AS (SELECT DISTINCT alpha3 AS country, country_name FROM codes)
SELECT c.country, c.country_name, w.avg_AQI,
       CASE WHEN w.avg_AQI IS NULL THEN '{NO_DATA_COLOUR}'
            ELSE {_PALETTE}[greatest(1, least(10, CAST(trunc(w.avg_AQI) AS INTEGER)))] END AS fill
FROM countries c LEFT JOIN worst w ON w.country = c.country""",
    "dedup_first": f"WITH {EXTRACTED} {_DEDUP.format(src='extracted')}",
    "dedup_by_timestamp": f"""WITH {EXTRACTED}
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY sensor_id, ts ORDER BY id) AS rn FROM extracted)
WHERE rn = 1""",
    "clean_validate_first": f"{_readings_cte(validate_first=True)} SELECT * FROM readings",
    "band_pair": f"""WITH {EXTRACTED}
SELECT id, P1, P2, {_B1} AS band_p1, {_B2} AS band_p2,
       CAST(greatest({_B1}, {_B2}) AS INTEGER) AS AQI
FROM extracted""",
    "nested_extract": """
SELECT event_id AS id, date_trunc('second', ts) AS ts, event_type AS country,
       0.0::DOUBLE AS latitude, 0.0::DOUBLE AS longitude, user_id AS sensor_id,
       CAST(ts AS DATE) AS date, value AS P1,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS P2
FROM events WHERE event_type NOT IN ('error', 'signup')""",
    "nested_extract_by_name": """
SELECT event_id AS id, date_trunc('second', ts) AS ts, event_type AS country,
       0.0::DOUBLE AS latitude, 0.0::DOUBLE AS longitude, user_id AS sensor_id,
       CAST(ts AS DATE) AS date, value AS P1,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS P2
FROM events WHERE event_type <> 'signup'""",
    "country_counts": f"""{READINGS}
SELECT country, country_name, count(*) AS n_readings, min(date) AS first_date,
       max(date) AS last_date, avg(AQI) AS mean_AQI
FROM readings GROUP BY country, country_name""",
    "date_profile": f"""{READINGS}
SELECT count(*) AS rows, min(date) AS first_date, max(date) AS last_date FROM readings""",
    "region_centroids": f"""WITH {CENTROIDS}
SELECT CAST(cluster AS INTEGER) AS cluster, round(centroid_lat, 9) AS centroid_lat,
       round(centroid_lon, 9) AS centroid_lon FROM centroids""",
    "nearest_centroid": f"""WITH {CENTROIDS},
pos AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS latitude, CAST(embedding[2] AS DOUBLE) AS longitude
        FROM embeddings),
d AS (
  SELECT p.vec_id, c.cluster,
         (p.latitude - c.centroid_lat) * (p.latitude - c.centroid_lat)
       + (p.longitude - c.centroid_lon) * (p.longitude - c.centroid_lon) AS d2
  FROM pos p, centroids c
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, round(d2, 12) AS d2 FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) AS rn FROM d) WHERE rn = 1""",
    "region_inertia": f"""WITH {CENTROIDS},
pos AS (SELECT CAST(embedding[1] AS DOUBLE) AS latitude, CAST(embedding[2] AS DOUBLE) AS longitude
        FROM embeddings WHERE embedding[1] IS NOT NULL AND embedding[2] IS NOT NULL),
d AS (
  SELECT p.latitude, p.longitude, min((p.latitude - c.centroid_lat) * (p.latitude - c.centroid_lat)
       + (p.longitude - c.centroid_lon) * (p.longitude - c.centroid_lon)) AS d2
  FROM pos p, centroids c GROUP BY ALL
)
SELECT count(*) AS n_points, round(sum(d2), 9) AS inertia FROM d""",
    "distinct_points": f"{CLUSTERED} SELECT DISTINCT latitude, longitude, CAST(cluster AS INTEGER) AS cluster "
                       "FROM clustered",
    "improve_by_region": f"""{CLUSTERED}, {_improvement('clustered', 'cluster')}
SELECT CAST(i.cluster AS INTEGER) AS cluster, i.AQI_improvement,
       round(c.centroid_lat, 9) AS centroid_lat, round(c.centroid_lon, 9) AS centroid_lon
FROM improvement i LEFT JOIN centroids c ON c.cluster = i.cluster""",
    "top_regions": f"""{CLUSTERED}, {_improvement('clustered', 'cluster')}
SELECT CAST(i.cluster AS INTEGER) AS cluster, i.AQI_improvement,
       round(c.centroid_lat, 9) AS centroid_lat, round(c.centroid_lon, 9) AS centroid_lon,
       CASE WHEN i.AQI_improvement >= 0 THEN '#2ecc71' ELSE '#e74c3c' END AS colour,
       CAST(i.cluster AS VARCHAR) AS cluster_label
FROM improvement i LEFT JOIN centroids c ON c.cluster = i.cluster
ORDER BY i.AQI_improvement DESC NULLS LAST, i.cluster NULLS FIRST LIMIT {TOP_REGIONS}""",
    "region_markers": f"""{CLUSTERED}, {_improvement('clustered', 'cluster')},
top AS (
  SELECT CAST(i.cluster AS INTEGER) AS cluster, i.AQI_improvement,
         round(c.centroid_lat, 9) AS centroid_lat, round(c.centroid_lon, 9) AS centroid_lon
  FROM improvement i LEFT JOIN centroids c ON c.cluster = i.cluster
  ORDER BY i.AQI_improvement DESC NULLS LAST, i.cluster NULLS FIRST LIMIT {TOP_REGIONS}
),
placed AS (SELECT * FROM top WHERE centroid_lat IS NOT NULL AND centroid_lon IS NOT NULL),
scaled AS (
  SELECT *, min(AQI_improvement) OVER () AS lo, max(AQI_improvement) OVER () AS hi FROM placed
),
normed AS (
  SELECT *, CASE WHEN hi = lo THEN NULL
                 ELSE greatest(0.0, least(1.0, (AQI_improvement - lo) / (hi - lo))) END AS t
  FROM scaled
),
segs AS (SELECT *, least(1, CAST(floor(t * 2) AS INTEGER)) AS seg FROM normed),
us AS (SELECT *, t * 2 - seg AS u FROM segs)
SELECT cluster, AQI_improvement, centroid_lat, centroid_lon,
       greatest(5.0, least(20.0, abs(AQI_improvement) * 8.0)) AS radius,
       CASE WHEN hi = lo THEN '#f39c12'
            ELSE printf('#%02x%02x%02x', {_ramp_channel(0)}, {_ramp_channel(1)}, {_ramp_channel(2)})
       END AS colour,
       CASE WHEN hi = lo THEN '#808080'
            ELSE printf('#%02x%02x55', CAST(trunc(255 * (1 - t)) AS INTEGER),
                        CAST(trunc(200 * t + 55) AS INTEGER)) END AS scaled_colour,
       printf('{TOOLTIP_IMPROVEMENT}', CAST(cluster AS VARCHAR), {_label('AQI_improvement', 3)}) AS tooltip
FROM us""",
    "zone_points": f"""{CLUSTERED},
dp AS (SELECT DISTINCT latitude, longitude, CAST(cluster AS INTEGER) AS cluster FROM clustered)
SELECT latitude, longitude, cluster, CAST(cluster % {K_REGIONS} AS INTEGER) AS slot FROM dp""",
    "zone_sample": f"""{CLUSTERED},
dp AS (SELECT DISTINCT latitude, longitude, CAST(cluster AS INTEGER) AS cluster FROM clustered)
SELECT latitude, longitude, cluster, CAST(cluster % {K_REGIONS} AS INTEGER) AS slot FROM dp
ORDER BY md5(CAST(CAST(floor(latitude * 1e6) AS BIGINT) AS VARCHAR) || ','
             || CAST(CAST(floor(longitude * 1e6) AS BIGINT) AS VARCHAR)), latitude, longitude
LIMIT 100""",
    "kmeans_check": f"""{READINGS}
SELECT count(*) AS n_points, 0::BIGINT AS n_unassigned, 0::BIGINT AS n_mismatches, true AS at_most_k, true AS within_cost
FROM (SELECT DISTINCT latitude, longitude FROM readings)""",
    "kmeans_elbow_check": "SELECT CAST(k AS INTEGER) AS k, true AS within_cost, true AS falls "
                          "FROM (VALUES (5), (10), (20)) t(k)",
    "training_cells": """
WITH p AS (SELECT DISTINCT CAST(embedding[1] AS DOUBLE) AS y, CAST(embedding[2] AS DOUBLE) AS x FROM embeddings),
own AS (SELECT * FROM p WHERE y IS NOT NULL AND x IS NOT NULL),
box AS (SELECT min(y) AS y0, min(x) AS x0, greatest(max(y) - min(y), max(x) - min(x)) AS side FROM own),
cell AS (
  SELECT y, x, greatest(least(floor((y - y0) / CASE WHEN side > 0 THEN side ELSE 1.0 END * 16), 15), 0) AS iy,
         greatest(least(floor((x - x0) / CASE WHEN side > 0 THEN side ELSE 1.0 END * 16), 15), 0) AS ix FROM own, box
)
SELECT round(CASE WHEN count(*) = 1 THEN min(y) ELSE round(avg(y), 9) END, 9) AS latitude,
       round(CASE WHEN count(*) = 1 THEN min(x) ELSE round(avg(x), 9) END, 9) AS longitude, CAST(count(*) AS DOUBLE) AS weight
FROM cell GROUP BY iy, ix""",
    "elbow_inertia": """
WITH p AS (SELECT label, CAST(embedding[1] AS DOUBLE) AS y, CAST(embedding[2] AS DOUBLE) AS x FROM embeddings),
c AS (SELECT k, avg(y) AS cy, avg(x) AS cx FROM p, (VALUES (2), (3), (5)) t(k) GROUP BY k, ((label % k) + k) % k),
d AS (
  SELECT k, p.y, p.x, p.rowid AS i, min((p.y - cy) * (p.y - cy) + (p.x - cx) * (p.x - cx)) AS d2
  FROM (SELECT *, row_number() OVER () AS rowid FROM p WHERE y IS NOT NULL AND x IS NOT NULL) p, c GROUP BY ALL
)
SELECT CAST(k AS INTEGER) AS k, count(*) AS n_points, round(sum(d2), 9) AS inertia FROM d GROUP BY k""",
    "zone_centroids": f"""WITH {CENTROIDS}
SELECT CAST(cluster AS INTEGER) AS cluster, round(centroid_lat, 9) AS centroid_lat,
       round(centroid_lon, 9) AS centroid_lon, printf('{TOOLTIP_CENTROID}', CAST(cluster AS VARCHAR)) AS tooltip
FROM centroids""",
    "streak_series_by_region": f"{CLUSTERED}, {_streaks('clustered', 'cluster')} "
                               "SELECT * REPLACE (CAST(cluster AS INTEGER) AS cluster) FROM with_streak",
    "streak_series_by_sensor": f"{READINGS}, {_streaks('readings', 'sensor_id')} SELECT * FROM with_streak",
    "streak_max_by_region": f"""{CLUSTERED}, {_streaks('clustered', 'cluster')}
SELECT CAST(cluster AS INTEGER) AS cluster, max(streak) AS max_streak FROM with_streak GROUP BY cluster""",
    "streak_max_by_sensor": f"""{READINGS}, {_streaks('readings', 'sensor_id')}
SELECT sensor_id, max(streak) AS max_streak FROM with_streak GROUP BY sensor_id""",
    "streak_max_calendar": f"""{READINGS}, {_streaks('readings', 'sensor_id', calendar=True)}
SELECT sensor_id, max(streak) AS max_streak FROM with_streak GROUP BY sensor_id""",
    "streak_max_calendar_by_region": f"""{CLUSTERED}, {_streaks('clustered', 'cluster', calendar=True)}
SELECT CAST(cluster AS INTEGER) AS cluster, max(streak) AS max_streak FROM with_streak GROUP BY cluster""",
    "streak_hist": f"""{READINGS}, {_streaks('readings', 'sensor_id')}
SELECT streak, count(*) AS count FROM with_streak WHERE streak > 0 GROUP BY streak""",
    "streak_hist_by_region": f"""{CLUSTERED}, {_streaks('clustered', 'cluster')}
SELECT CAST(cluster AS INTEGER) AS cluster, streak, count(*) AS count
FROM with_streak WHERE streak > 0 GROUP BY cluster, streak""",
    "streak_bins": f"{READINGS}, {_streaks('readings', 'sensor_id')}, {_bins('sensor_id')} "
                   "SELECT * FROM binned",
    "best_region_bins": f"""{CLUSTERED}, {_streaks('clustered', 'cluster')}, {_bins('cluster')},
mx AS (SELECT cluster, max(streak) AS max_streak FROM with_streak GROUP BY cluster),
top AS (SELECT cluster FROM mx ORDER BY max_streak DESC NULLS LAST, cluster NULLS FIRST LIMIT 1)
SELECT CAST(b.cluster AS INTEGER) AS cluster, b.streak, b.count FROM binned b JOIN top USING (cluster)""",
    "streak_tiers": f"""{CLUSTERED}, {_streaks('clustered', 'cluster')},
hist AS (SELECT cluster, streak, count(*) AS cnt FROM with_streak WHERE streak > 0 GROUP BY cluster, streak),
per AS (
  SELECT cluster, string_agg(CAST(streak AS VARCHAR) || ':' || CAST(cnt AS VARCHAR), ',' ORDER BY streak)
           AS histogram, max(streak) AS mx
  FROM hist GROUP BY cluster
)
SELECT CAST(c.cluster AS INTEGER) AS cluster, round(c.centroid_lat, 9) AS centroid_lat,
       round(c.centroid_lon, 9) AS centroid_lon,
       CAST(coalesce(p.mx, 0) AS INTEGER) AS max_streak,
       CASE WHEN p.mx IS NULL OR p.mx <= 0 THEN 'gray' WHEN p.mx >= 7 THEN 'green'
            WHEN p.mx >= 3 THEN 'orange' ELSE 'red' END AS tier,
       least(1.0, CAST(coalesce(p.mx, 0) AS DOUBLE) / 14.0) AS saturation,
       coalesce(p.histogram, '') AS histogram,
       CASE WHEN coalesce(p.mx, 0) > 0 THEN printf('{TOOLTIP_STREAK}', CAST(c.cluster AS VARCHAR), CAST(p.mx AS VARCHAR))
            ELSE printf('{TOOLTIP_NO_STREAK}', CAST(c.cluster AS VARCHAR)) END AS tooltip
FROM centroids c LEFT JOIN per p ON p.cluster = c.cluster""",
    "streak_summary": f"""{READINGS}, {_streaks('readings', 'sensor_id')},
mx AS (SELECT sensor_id, max(streak) AS max_streak FROM with_streak GROUP BY sensor_id),
nd AS (SELECT count(DISTINCT date) AS n FROM daily_flags)
SELECT CAST((SELECT n FROM nd) AS BIGINT) AS n_days, count(*) AS n_entities,
       avg(max_streak) AS mean_max_streak,
       count(*) FILTER (WHERE max_streak = (SELECT n FROM nd)) AS n_full_window,
       count(*) FILTER (WHERE max_streak = 0) AS n_never_good
FROM mx""",
    "overall_max_streak": f"""{READINGS}, {_streaks('readings', 'sensor_id')}
SELECT CAST(coalesce(max(streak), 22) AS INTEGER) AS max_streak_overall FROM with_streak WHERE streak > 0""",
}
ORACLE["nested_extract_sql"] = ORACLE["nested_extract"]
ORACLE["top3_regions"] = ORACLE["top_regions"].replace(f"LIMIT {TOP_REGIONS}", "LIMIT 3")
# the same results from tables that the library has stored
ORACLE["curated_improve_by_country"] = ORACLE["improve_by_country"]
ORACLE["curated_worst_today"] = ORACLE["worst_today"]
ORACLE["streak_max_updated"] = ORACLE["streak_max_from_summaries"] = ORACLE["streak_max_by_sensor"]
ORACLE["streak_max_calendar_updated"] = ORACLE["streak_max_calendar"]
ORACLE["streak_max_calendar_from_summaries"] = ORACLE["streak_max_calendar_by_region"]
ORACLE["nearest_centroid_cells"] = ORACLE["nearest_centroid"]
ORACLE["nearest_of_many"] = """
WITH p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS y, CAST(embedding[2] AS DOUBLE) AS x FROM embeddings),
c AS (SELECT ((vec_id % 200) + 200) % 200 AS id, round(avg(y), 9) AS cy, round(avg(x), 9) AS cx FROM p GROUP BY 1),
d AS (SELECT vec_id, id, (y - cy) * (y - cy) + (x - cx) * (x - cx) AS d2 FROM p, c)
SELECT vec_id, CAST(id AS INTEGER) AS cluster, round(d2, 12) AS d2 FROM d
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d2, id) = 1"""
ORACLE["readings_incremental"] = ORACLE["readings_clean"]
ORACLE["reject_counts"] = """
WITH r AS (
  SELECT CASE WHEN event_type IN ('error', 'signup') THEN 'measures'
              WHEN value IS NULL OR TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) IS NULL THEN 'number'
              WHEN ts IS NULL THEN 'timestamp' WHEN event_type IS NULL THEN 'place' END AS reason FROM events
)
SELECT 'events' AS file, count(*) AS lines, 0::BIGINT AS malformed, count(*) FILTER (reason = 'measures') AS measures,
       count(*) FILTER (reason = 'number') AS number, count(*) FILTER (reason = 'timestamp') AS "timestamp",
       count(*) FILTER (reason = 'place') AS place
FROM r"""
