"""SQL for each query, over the same test tables.

Written the relational way throughout (unnest, join, window), not as a
transcript of the array expressions it checks.
"""

from __future__ import annotations


def r6(expression: str) -> str:
    return f"round_even(CAST({expression} AS DOUBLE) * 1e6, 0) / 1e6 + 0.0"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


TRACES = """
traces AS (
  SELECT label AS plane, CAST(vec_id AS INTEGER) AS roi, CAST(i AS INTEGER) AS frame,
         CAST(embedding[i + 1] AS DOUBLE) AS f,
         CAST(embedding[len(embedding) - i] AS DOUBLE) AS fneu,
         CAST(greatest(embedding[i + 1], 0) AS DOUBLE) AS spks,
         len(embedding) AS n
  FROM (SELECT *, unnest(range(len(embedding))) AS i FROM embeddings)
)"""

TRACE_FLAGS = """
flags AS (
  SELECT e.label AS plane, CAST(e.vec_id AS INTEGER) AS roi, coalesce(l.quality, 0) = 1 AS iscell
  FROM embeddings e LEFT JOIN labels l ON l.doc_id = e.vec_id
)"""

COUNTS = """
counts AS (
  SELECT plane, CAST(count(*) FILTER (WHERE iscell) AS INTEGER) AS accepted,
         CAST(count(*) FILTER (WHERE NOT iscell) AS INTEGER) AS rejected
  FROM flags GROUP BY plane
)"""

SIGNAL = """
signal AS (
  SELECT plane, avg(f) AS mean_trace, stddev_pop(f) AS std_trace FROM traces GROUP BY plane
)"""

TIMES = """
times AS (
  SELECT CAST(user_id % 10 AS INTEGER) AS plane,
         sum(value) FILTER (WHERE event_type = 'view') AS registration,
         sum(value) FILTER (WHERE event_type = 'click') AS detection,
         sum(value) FILTER (WHERE event_type = 'signup') AS extraction,
         sum(value) FILTER (WHERE event_type = 'purchase') AS classification,
         sum(value) FILTER (WHERE event_type = 'error') AS deconvolution,
         sum(value) AS total_plane_runtime
  FROM events GROUP BY 1
)"""

Z = """
z AS (
  SELECT plane, roi, frame,
         (f - avg(f) OVER (PARTITION BY plane, roi)) / stddev_pop(f) OVER (PARTITION BY plane, roi) AS z
  FROM traces
)"""

RANKED = """
active AS (SELECT plane, roi, avg(abs(z)) AS activity FROM z GROUP BY plane, roi),
ranked AS (
  SELECT plane, roi, activity,
         CAST(row_number() OVER (PARTITION BY plane ORDER BY activity DESC, roi) AS INTEGER) AS rank
  FROM active
)"""

WINDOWED = "windowed AS (SELECT * FROM traces WHERE roi >= 5 AND frame >= 8 AND frame < 56)"
Z_WINDOW = Z.replace("FROM traces", "FROM windowed")
RANKED_WINDOW = RANKED

STRIDED = """
strided AS (
  SELECT *, frame AS timepoint FROM traces WHERE frame % greatest(1, n // 10) = 0
)"""

PIXELS = """
pixels AS (
  SELECT CAST(l_orderkey // 500 AS INTEGER) AS plane, CAST(l_orderkey % 500 AS INTEGER) AS roi,
         CAST((l_orderkey % 500) * 37 % 60 + l_partkey % 4 AS INTEGER) AS y,
         CAST((l_orderkey % 500) * 23 % 59 + l_suppkey % 4 AS INTEGER) AS x,
         max(l_quantity) AS lam
  FROM lineitem GROUP BY 1, 2, 3, 4
)"""

FLAGGED = """
flagged AS (
  SELECT p.*, o.o_orderstatus <> 'O' AS iscell, o.o_orderstatus = 'F' AS painted,
         p.lam / max(p.lam) OVER (PARTITION BY p.plane, p.roi) AS weight,
         CAST(row_number() OVER (PARTITION BY p.plane, p.roi ORDER BY p.y, p.x) - 1 AS INTEGER) AS pos
  FROM pixels p JOIN orders o ON o.o_orderkey = CAST(p.plane AS BIGINT) * 500 + p.roi
)"""

LABELS = """
labels_ AS (
  SELECT plane, y, x, max(roi + 1) AS label_all,
         max(roi + 1) FILTER (WHERE NOT iscell) AS label_noncell,
         max(roi + 1) FILTER (WHERE iscell) AS label_cell
  FROM flagged GROUP BY plane, y, x
)"""

GRID = """
grid AS (
  SELECT plane, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x
  FROM (SELECT DISTINCT CAST(l_orderkey // 500 AS INTEGER) AS plane FROM lineitem),
       range(64) ys(y), range(64) xs(x)
)"""

# Red, green and blue each rise and fall over the hue circle, a third apart.
PAINTED = """
last AS (
  SELECT * REPLACE (painted AS iscell),
         row_number() OVER (PARTITION BY plane, painted, y, x ORDER BY roi DESC, pos DESC) AS turn
  FROM flagged
),
painted AS (
  SELECT plane, iscell, y, x,
         weight * least(1, greatest(0, abs(6 * h - 3) - 1)) AS r,
         weight * least(1, greatest(0, 2 - abs(6 * h - 2))) AS g,
         weight * least(1, greatest(0, 2 - abs(6 * h - 4))) AS b
  FROM (SELECT *, (roi * CAST(0.618033988749895 AS DOUBLE)) % 1 AS h FROM last WHERE turn = 1)
)"""

FILES = """
files AS (
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, strlen(html) AS n_bytes,
         rtrim('/' || regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://', ''), '/') || '/' ||
         CASE WHEN page_id % 7 = 0 THEN '_' ELSE '' END ||
         CASE WHEN page_id % 5 = 0 THEN 'plane' ELSE 'plane_' END || page_id ||
         CASE page_id % 4 WHEN 0 THEN '_reg.tif' WHEN 1 THEN '.ome.tif' WHEN 2 THEN '.b_c.tif' ELSE '.tif' END
           AS path
  FROM pages
),
named AS (SELECT *, string_split(path, '/')[-1] AS file FROM files)"""

# The extensions of these files are known, so the stem is cut by length.
STEMS = """
stems AS (
  SELECT *, left(file, length(file) - 4) AS stem,
         CASE WHEN page_id % 4 IN (1, 2) THEN left(file, length(file) - 8) ELSE left(file, length(file) - 4) END
           AS bare
  FROM named
)"""

NAME_OF_BARE = """
CASE WHEN contains({0}, '_') THEN array_to_string(list_slice(string_split({0}, '_'), 1, len(string_split({0}, '_')) - 1), '_')
     ELSE '' END"""

MOVIE = """
movie AS (
  SELECT CAST(l_orderkey // 500 AS INTEGER) AS plane, CAST(l_quantity AS BIGINT) - 1 AS frame,
         CAST(l_partkey % 64 AS INTEGER) AS y, CAST(l_suppkey % 64 AS INTEGER) AS x,
         round(l_extendedprice * 100) AS value, l_quantity
  FROM lineitem
)"""

RING = """
centers AS (SELECT plane, roi, avg(y) AS cy, avg(x) AS cx FROM pixels GROUP BY plane, roi),
disk AS (
  SELECT plane, roi, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, cy, cx
  FROM (SELECT *, unnest(range(CAST(floor(cy) AS BIGINT) - 4, CAST(floor(cy) AS BIGINT) + 6)) AS y FROM centers) c,
       range(-4, 6) d(step), LATERAL (SELECT CAST(floor(cx) AS BIGINT) + step AS x)
),
ring AS (
  SELECT plane, roi, y, x FROM disk d
  WHERE (y - cy) * (y - cy) + (x - cx) * (x - cx) > 2.25 AND (y - cy) * (y - cy) + (x - cx) * (x - cx) <= 9
    AND y BETWEEN 0 AND 63 AND x BETWEEN 0 AND 63
    AND NOT EXISTS (SELECT 1 FROM pixels p WHERE p.plane = d.plane AND p.y = d.y AND p.x = d.x)
)"""

CELL_TRACE = """
cell_trace AS (
  SELECT plane, roi, frame, sum(lam * value) / sum(lam) AS f
  FROM movie JOIN pixels USING (plane, y, x) GROUP BY ALL
)"""

RING_TRACE = """
ring_trace AS (
  SELECT plane, roi, frame, avg(value) AS fneu FROM movie JOIN ring USING (plane, y, x) GROUP BY ALL
)"""

_STATS = (
    with_(TRACES, TRACE_FLAGS, COUNTS, SIGNAL, TIMES)
    + f"""
SELECT plane, accepted, rejected, {r6("mean_trace")} AS mean_trace, {r6("std_trace")} AS std_trace,
       {r6("registration")} AS registration, {r6("detection")} AS detection, {r6("extraction")} AS extraction,
       {r6("classification")} AS classification, {r6("deconvolution")} AS deconvolution,
       {r6("total_plane_runtime")} AS total_plane_runtime, '/volume/plane_' || plane || '/plane0/ops.npy' AS filepath
FROM counts JOIN signal USING (plane) JOIN times USING (plane)"""
)

_PARAMS = {
    "tau": "'1.3'",
    "fs": "CAST(page_id % 30 AS VARCHAR)",
    "nchannels": "'1'",
    "bytes": "CAST(n_bytes AS VARCHAR)",
    "tiff_list": "file",
    "save_path0": "'/results'",
    "save_folder": "stem",
}

_FEATURES = (
    with_(TRACES)
    + f"""
, centered AS (
  SELECT *, f - avg(f) OVER (PARTITION BY plane, roi) AS d, fneu - avg(fneu) OVER (PARTITION BY plane, roi) AS e
  FROM traces
), signal AS (
  SELECT plane, roi, avg(d * d * d) / (sqrt(avg(d * d)) * avg(d * d)) AS skewness, avg(d * d) AS variance,
         sum(d * e) / (sqrt(sum(d * d)) * sqrt(sum(e * e))) AS corr
  FROM centered GROUP BY plane, roi
), shape AS (
  SELECT plane, CAST(CASE sign WHEN 1 THEN roi ELSE -1 - roi END AS INTEGER) AS roi, CAST(count(*) AS INTEGER) AS area,
         max(frame // 8) - min(frame // 8) + 1 AS height, max(frame % 8) - min(frame % 8) + 1 AS width
  FROM traces, (VALUES (1), (-1)) s(sign) WHERE f > 0 AND roi % 2 = 0 GROUP BY plane, roi, sign
)
SELECT plane, roi, {r6("skewness")} AS skewness, {r6("variance")} AS variance, {r6("corr")} AS corr, area,
       {r6("CAST(greatest(height, width) AS DOUBLE) / least(height, width)")} AS aspect
FROM signal FULL JOIN shape USING (plane, roi)"""
)

ORACLE: dict[str, str] = {
    "volume_stats": _STATS,
    "volume_stats_saved": _STATS,
    "volume_stats_cells_only": with_(TRACES, TRACE_FLAGS)
    + f"""
SELECT plane, {r6("avg(f)")} AS mean_trace, {r6("stddev_pop(f)")} AS std_trace
FROM traces JOIN flags USING (plane, roi) WHERE iscell GROUP BY plane""",
    "volume_stats_accepted": with_(TRACES, TRACE_FLAGS, TIMES)
    + f"""
, kept AS (SELECT plane, roi, iscell AND plane <> 0 AS iscell FROM flags),
counted AS (
  SELECT plane, CAST(count(*) FILTER (WHERE iscell) AS INTEGER) AS accepted,
         CAST(count(*) FILTER (WHERE NOT iscell) AS INTEGER) AS rejected
  FROM kept GROUP BY plane
), averaged AS (
  SELECT plane, avg(f) AS mean_trace, stddev_pop(f) AS std_trace
  FROM traces JOIN kept USING (plane, roi) WHERE iscell GROUP BY plane
)
SELECT plane, coalesce(accepted, 0) AS accepted, coalesce(rejected, 0) AS rejected,
       {r6("coalesce(mean_trace, -1)")} AS mean_trace, {r6("coalesce(std_trace, -1)")} AS std_trace,
       '/volume/plane_' || plane || '/plane0/ops.npy' AS filepath
FROM times LEFT JOIN counted USING (plane) LEFT JOIN averaged USING (plane)""",
    "job_bars": with_(TRACE_FLAGS, COUNTS, TIMES)
    + """
SELECT plane, coalesce(accepted, 0) AS accepted, coalesce(rejected, 0) AS rejected, coalesce(accepted, 0) AS rejected_bottom,
       CASE WHEN accepted > 0 THEN accepted / 2.0 END AS accepted_mid,
       CASE WHEN rejected > 0 THEN accepted + rejected / 2.0 END AS rejected_mid,
       CASE WHEN accepted > 0 THEN CAST(accepted AS VARCHAR) END AS accepted_label,
       CASE WHEN rejected > 0 THEN CAST(rejected AS VARCHAR) END AS rejected_label
FROM times LEFT JOIN counts USING (plane)""",
    "job_outputs": with_(TRACES, TRACE_FLAGS, COUNTS, SIGNAL, TIMES, Z, RANKED, MOVIE)
    + """
, maps AS (
  SELECT plane, y, x, min(value) AS ref, max(l_quantity) AS enhanced FROM movie
  WHERE plane IN (SELECT plane FROM times) GROUP BY plane, y, x
), pixel AS (
  SELECT plane, frame // 8 AS y, frame % 8 AS x, roi, iscell, f / max(f) OVER (PARTITION BY plane, roi) AS weight
  FROM traces JOIN flags USING (plane, roi) WHERE f > 0
), label AS (
  SELECT plane, y, x, max(roi + 1) AS label_all, max(roi + 1) FILTER (WHERE NOT iscell) AS non, max(roi + 1) FILTER (WHERE iscell) AS cell
  FROM pixel GROUP BY plane, y, x
), last AS (
  SELECT *, row_number() OVER (PARTITION BY plane, iscell, y, x ORDER BY roi DESC) AS turn FROM pixel
), hued AS (
  SELECT plane, iscell, weight, (roi * CAST(0.618033988749895 AS DOUBLE)) % 1 AS h FROM last WHERE turn = 1
), painted AS (
  SELECT plane, iscell, weight * (least(1, greatest(0, abs(6 * h - 3) - 1)) + 2 * least(1, greatest(0, 2 - abs(6 * h - 2)))
         + 3 * least(1, greatest(0, 2 - abs(6 * h - 4)))) AS rgb
  FROM hued
), ranges AS (
  SELECT plane, roi, least(min(f), min(fneu)) AS fmin, greatest(max(f), max(fneu)) AS fmax, max(spks) AS smax
  FROM traces GROUP BY plane, roi
), stats AS (
  SELECT plane, coalesce(accepted, 0) AS accepted, coalesce(rejected, 0) AS rejected, mean_trace, std_trace, times.* EXCLUDE (plane)
  FROM times LEFT JOIN counts USING (plane) LEFT JOIN signal USING (plane)
), grid AS (
  SELECT plane, row_number() OVER (ORDER BY plane) - 1 AS idx, count(*) OVER () AS n, CAST(ceil(sqrt(count(*) OVER ())) AS BIGINT) AS side
  FROM (SELECT DISTINCT plane FROM traces)
), cells AS (SELECT *, CASE WHEN n > side * (side - 1) THEN side ELSE side - 1 END AS cols FROM grid
), lines AS (
  SELECT 'registration' AS output, plane, ref * 1.0 AS v FROM maps
  UNION ALL SELECT 'registration', plane, enhanced * 4.0 FROM maps
  UNION ALL SELECT 'segmentation', plane, label_all * 3 + coalesce(cell, 0) * (y + 1) + coalesce(non, 0) * (x + 1) FROM label
  UNION ALL SELECT 'traces', plane, CASE WHEN smax > 0 THEN spks / smax * (fmax - fmin) ELSE spks END + fmin + f * frame - fneu + fmax * roi
    FROM traces JOIN ranges USING (plane, roi)
  UNION ALL SELECT 'volume_stats', plane, accepted - rejected + mean_trace + std_trace + total_plane_runtime FROM stats
  UNION ALL SELECT 'acc_rej_bar', plane, accepted / 2.0 - CASE WHEN rejected > 0 THEN accepted + rejected / 2.0 ELSE 0 END + accepted FROM stats
  UNION ALL SELECT 'mean_volume_signal', plane, mean_trace - std_trace + 2 * (mean_trace + std_trace) FROM stats
  UNION ALL SELECT 'execution_time', plane, registration FROM stats
  UNION ALL SELECT 'execution_time', plane, registration + detection - registration / 3 FROM stats
  UNION ALL SELECT 'execution_time', plane, registration + detection + extraction - (registration + detection) / 3 FROM stats
  UNION ALL SELECT 'max_cell_noncell', plane, rgb * CASE WHEN iscell THEN 1 ELSE 5 END FROM painted
  UNION ALL SELECT 'fluorescence', plane, any_value(rank) * sum(abs(z)) FROM z JOIN ranked USING (plane, roi) GROUP BY plane, roi
  UNION ALL SELECT 'fluorescence_grid', plane, (idx // cols) * 10 + idx % cols FROM cells
)
SELECT output, plane, count(v) AS n, round(sum(CAST(v AS DOUBLE)), 3) AS total FROM lines GROUP BY output, plane""",
    "images_merged": with_(MOVIE)
    + f"""
, halves AS (SELECT plane, y, x, CASE WHEN frame < 25 THEN CAST(CAST(value AS INTEGER) AS DOUBLE) ELSE value END AS value FROM movie
), maps AS (SELECT plane, y, x, max(value) AS top, avg(value) AS mean FROM halves GROUP BY plane, y, x)
SELECT plane, 'max_proj' AS kind, y, x, {r6("top")} AS value FROM maps
UNION ALL SELECT plane, 'meanImg', y, x, {r6("mean")} FROM maps""",
    "superres_merged": with_(MOVIE)
    + f"""
SELECT plane, CAST(floor((frame % 4) * 0.25 / 0.5) AS INTEGER) AS dy_bin,
       CAST(floor((frame % 2) * 0.5 / 0.5) AS INTEGER) AS dx_bin, y, x, {r6("avg(value)")} AS value
FROM movie GROUP BY 1, 2, 3, 4, 5""",
    "tables_reread": with_(TIMES, TRACES, TRACE_FLAGS, MOVIE)
    + """
, lines AS (
  SELECT plane, 'planes' AS of, total_plane_runtime AS v FROM times
  UNION ALL SELECT plane, 'rois', CASE WHEN iscell THEN total ELSE -total END FROM flags JOIN (
    SELECT plane, roi, sum(greatest(f, 0)) AS total FROM traces GROUP BY plane, roi) t USING (plane, roi)
  UNION ALL SELECT plane, 'movie', value + frame * x FROM movie
)
SELECT plane, of, count(*) AS n, round(sum(v), 3) AS total FROM lines GROUP BY plane, of""",
    "accepted_rejected_bars": with_(TRACE_FLAGS, COUNTS)
    + """
SELECT plane, accepted, rejected, accepted AS rejected_bottom,
       CASE WHEN accepted > 0 THEN accepted / 2.0 END AS accepted_mid,
       CASE WHEN rejected > 0 THEN accepted + rejected / 2.0 END AS rejected_mid,
       CASE WHEN accepted > 0 THEN CAST(accepted AS VARCHAR) END AS accepted_label,
       CASE WHEN rejected > 0 THEN CAST(rejected AS VARCHAR) END AS rejected_label
FROM counts""",
    "execution_time_stack": with_(TIMES)
    + f"""
, steps AS (
  SELECT plane, 1 AS n, 'registration' AS step, registration AS seconds, total_plane_runtime FROM times
  UNION ALL SELECT plane, 2, 'detection', detection, total_plane_runtime FROM times
  UNION ALL SELECT plane, 3, 'extraction', extraction, total_plane_runtime FROM times
), stacked AS (
  SELECT *, sum(seconds) OVER (PARTITION BY plane ORDER BY n) AS top FROM steps
)
SELECT plane, step, {r6("top - seconds")} AS bottom, {r6("top")} AS top,
       CASE WHEN n = 3 AND total_plane_runtime > 1 THEN CAST(CAST(trunc(total_plane_runtime) AS BIGINT) AS VARCHAR) END AS label,
       CASE WHEN n = 3 AND total_plane_runtime > 1 THEN {r6("top + 2")} END AS label_y
FROM stacked""",
    "volume_signal": with_(TRACES, SIGNAL)
    + f"""
SELECT plane, {r6("mean_trace")} AS mean_trace, {r6("std_trace")} AS std_trace,
       {r6("mean_trace - std_trace")} AS lower, {r6("mean_trace + std_trace")} AS upper FROM signal""",
    "trace_shape": """
SELECT label AS plane, CAST(count(*) AS INTEGER) AS n_rois, CAST(max(len(embedding)) AS INTEGER) AS n_frames
FROM embeddings GROUP BY label""",
    "trace_window": with_(TRACES)
    + f"""
SELECT plane, roi, frame, {r6("f")} AS f FROM traces WHERE roi >= 5 AND frame >= 8 AND frame < 56""",
    "trace_zscore": with_(TRACES, Z) + f"SELECT plane, roi, frame, {r6('z')} AS z FROM z",
    "activity_rank": with_(TRACES, Z, RANKED)
    + f"SELECT plane, roi, {r6('activity')} AS activity, rank FROM ranked",
    "activity_top_k": with_(TRACES, Z, RANKED)
    + f"SELECT plane, roi, {r6('activity')} AS activity, rank FROM ranked WHERE rank <= 10",
    "trace_heatmap": with_(TRACES, Z, RANKED)
    + f"""
SELECT plane, rank - 1 AS row, roi, frame, {r6("z")} AS z FROM z JOIN ranked USING (plane, roi)""",
    "trace_heatmap_window": with_(TRACES, WINDOWED, Z_WINDOW, RANKED_WINDOW)
    + f"""
SELECT plane, rank - 1 AS row, roi, frame, {r6("z")} AS z FROM z JOIN ranked USING (plane, roi)""",
    "activity_top_many": with_(TRACES, WINDOWED, Z_WINDOW, RANKED_WINDOW)
    + f"SELECT plane, roi, {r6('activity')} AS activity, rank FROM ranked WHERE rank <= 2000",
    "trace_grid_layout": """
WITH planes AS (
  SELECT plane, row_number() OVER (ORDER BY plane) - 1 AS idx, count(*) OVER () AS n
  FROM (SELECT DISTINCT label AS plane FROM embeddings)
), sided AS (SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS side FROM planes
), sized AS (SELECT *, CASE WHEN n > side * (side - 1) THEN side ELSE side - 1 END AS cols FROM sided)
SELECT plane, CAST(idx // cols AS INTEGER) AS row, CAST(idx % cols AS INTEGER) AS col,
       CASE WHEN idx % cols = 0 THEN 'Planes ' || (idx + 1) || '-' || least(idx + cols, n) END AS row_label,
       CAST(side AS INTEGER) AS grid_rows, CAST(cols AS INTEGER) AS grid_cols
FROM sized""",
    "trace_sample": """
SELECT plane, roi, sample_rank FROM (
  SELECT label AS plane, CAST(vec_id AS INTEGER) AS roi,
         CAST(row_number() OVER (PARTITION BY label ORDER BY md5('42:' || label || ':' || vec_id), vec_id) AS INTEGER) AS sample_rank
  FROM embeddings) WHERE sample_rank <= 20""",
    "trace_sample_all": """
SELECT label AS plane, CAST(vec_id AS INTEGER) AS roi,
       CAST(row_number() OVER (PARTITION BY label ORDER BY md5('42:' || label || ':' || vec_id), vec_id) AS INTEGER) AS sample_rank
FROM embeddings""",
    "trace_stride_frames": with_(TRACES)
    + f"""
SELECT plane, roi, frame AS timepoint, {r6('f')} AS f FROM traces
WHERE frame < 40 AND frame % greatest(1, least(40, n) // 10) = 0""",
    "display_labels": with_(TRACES)
    + """
SELECT plane, roi, 'ROI ' || roi AS axis_label, 'Frame Interval: 8-56, ROI Interval: 5-None' AS caption,
       printf('%.1f', least(min(f), min(fneu))) AS low_label, printf('%.1f', greatest(max(f), max(fneu))) AS high_label
FROM traces GROUP BY plane, roi""",
    "trace_stride": with_(TRACES, STRIDED) + f"SELECT plane, roi, timepoint, {r6('f')} AS f FROM strided",
    "trace_display": with_(TRACES, STRIDED)
    + f"""
, ranges AS (
  SELECT plane, roi, least(min(f), min(fneu)) AS fmin, greatest(max(f), max(fneu)) AS fmax, max(spks) AS smax
  FROM strided GROUP BY plane, roi
)
SELECT plane, roi, timepoint, {r6("fmin")} AS fmin, {r6("fmax")} AS fmax, {r6("f")} AS f, {r6("fneu")} AS fneu,
       {r6("CASE WHEN smax > 0 THEN spks / smax * (fmax - fmin) ELSE spks END + fmin")} AS spk_scaled
FROM strided JOIN ranges USING (plane, roi)""",
    "aligned_traces": with_(TRACES)
    + f"SELECT plane, roi, frame, {r6('f')} AS f, {r6('fneu')} AS fneu, {r6('spks')} AS spks FROM traces",
    "collect_traces": with_(TRACES)
    + f"""
, sources AS (
  SELECT plane, CAST(row_number() OVER (ORDER BY '/volume/' || (9 - plane), plane) AS INTEGER) AS position
  FROM (SELECT DISTINCT plane FROM traces)
)
SELECT position AS plane, roi, frame, {r6("f")} AS f FROM traces JOIN sources USING (plane)""",
    "neuropil_corrected": with_(TRACES)
    + f"SELECT plane, roi, frame, {r6('f - CAST(0.7 AS DOUBLE) * fneu')} AS f FROM traces",
    "roi_features": _FEATURES,
    "bucketed_features": _FEATURES,
    "chunked_features": _FEATURES,
    "chunked_zscore": with_(TRACES, Z) + f"SELECT plane, roi, frame, {r6('z')} AS z FROM z",
    "chunked_activity": with_(TRACES, Z, RANKED)
    + f"SELECT plane, roi, {r6('activity')} AS activity, rank FROM ranked",
    "chunked_signal": with_(TRACES, SIGNAL)
    + f"""
SELECT plane, {r6("mean_trace")} AS mean_trace, {r6("std_trace")} AS std_trace,
       {r6("mean_trace - std_trace")} AS lower, {r6("mean_trace + std_trace")} AS upper FROM signal""",
    "movie_activity": with_(MOVIE, PIXELS, CELL_TRACE)
    + f"""
, scaled AS (
  SELECT plane, roi, abs(f - avg(f) OVER w) AS far, stddev_pop(f) OVER w AS sd FROM cell_trace WINDOW w AS (PARTITION BY plane, roi)
)
SELECT plane, roi, {r6("coalesce(avg(far) / nullif(max(sd), 0), -1)")} AS activity FROM scaled GROUP BY plane, roi""",
    "cell_split": with_(PIXELS, FLAGGED)
    + """
SELECT plane, roi, CASE WHEN iscell THEN 'cell' ELSE 'non_cell' END AS kind, CAST(count(*) AS INTEGER) AS n_pixels
FROM flagged GROUP BY ALL""",
    "roi_label_map": with_(PIXELS, FLAGGED, LABELS) + "SELECT * FROM labels_",
    "roi_paint_map": with_(PIXELS, FLAGGED, PAINTED)
    + f"SELECT plane, iscell, y, x, {r6('r')} AS r, {r6('g')} AS g, {r6('b')} AS b FROM painted",
    "roi_raster": with_(PIXELS, FLAGGED, LABELS, GRID)
    + "SELECT plane, y, x, label_all, label_noncell, label_cell FROM grid LEFT JOIN labels_ USING (plane, y, x)",
    "roi_paint_raster": with_(PIXELS, FLAGGED, PAINTED, GRID)
    + f"""
SELECT plane, iscell, y, x, {r6("coalesce(r, 0)")} AS r, {r6("coalesce(g, 0)")} AS g, {r6("coalesce(b, 0)")} AS b
FROM grid CROSS JOIN (VALUES (true), (false)) c(iscell) LEFT JOIN painted USING (plane, iscell, y, x)""",
    "roi_raster_nan": with_(PIXELS, FLAGGED, LABELS, GRID)
    + """
SELECT plane, count(*) FILTER (WHERE label_all IS NULL) AS absent, count(*) FILTER (WHERE label_cell IS NULL) AS no_cell,
       CAST(sum(label_all) AS DOUBLE) AS labels, CAST(max(label_cell) AS DOUBLE) AS last_cell
FROM grid LEFT JOIN labels_ USING (plane, y, x) GROUP BY plane""",
    "roi_weights": with_(PIXELS, FLAGGED)
    + f"SELECT plane, roi, iscell, pos, y, x, {r6('weight')} AS weight FROM flagged",
    "plane_name": with_(FILES, STEMS)
    + f"SELECT page_id, path, stem, {NAME_OF_BARE.format('bare')} AS plane_name FROM stems",
    "files_by_plane_name": with_(FILES, STEMS)
    + f"SELECT page_id, {NAME_OF_BARE.format('bare')} AS plane_name FROM stems",
    "planes_kept_or_replaced": with_(FILES, STEMS)
    + f"""
SELECT page_id, host, {NAME_OF_BARE.format('bare')} AS plane_name,
       CASE WHEN host IN (SELECT host FROM files WHERE page_id % 3 = 0) THEN 1 ELSE 2 END AS run
FROM stems WHERE page_id % 3 = 0 OR host NOT IN (SELECT host FROM files WHERE page_id % 3 = 0)""",
    "common_root": with_(FILES)
    + """
, segments AS (
  SELECT host, page_id, unnest(range(len(parts) - 1)) AS i, unnest(list_slice(parts, 1, len(parts) - 1)) AS part
  FROM (SELECT host, page_id, string_split(path, '/') AS parts FROM files)
), agreed AS (
  SELECT host, i, min(part) AS part, count(*) = (SELECT count(*) FROM files f WHERE f.host = s.host)
                                     AND min(part) = max(part) AS same
  FROM segments s GROUP BY host, i
), shared AS (
  SELECT a.host, a.i, a.part FROM agreed a
  WHERE NOT EXISTS (SELECT 1 FROM agreed b WHERE b.host = a.host AND b.i <= a.i AND NOT b.same)
)
SELECT host, string_agg(part, '/' ORDER BY i) AS root FROM shared GROUP BY host""",
    "pending_planes": """
SELECT 'plane_' || d.doc_id AS plane_name, d.source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1 AND l.toxic = 0)""",
    "param_resolution": with_(FILES, STEMS)
    + "\nUNION ALL\n".join(f"SELECT page_id, '{key}' AS key, {value} AS value FROM stems" for key, value in _PARAMS.items()),
    "param_lookup": with_(FILES)
    + """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN (page_id % 9) / 10.0 ELSE 1.3 END::DOUBLE AS tau, 'all' AS save_folder,
       CASE WHEN page_id % 3 = 0 THEN CAST(n_bytes AS VARCHAR) END AS bytes
FROM files""",
    "planned_inputs": with_(FILES, STEMS)
    + f"""
, named_planes AS (SELECT page_id, stem, {NAME_OF_BARE.format('bare')} AS plane_name FROM stems)
SELECT page_id, plane_name, stem AS save_folder FROM named_planes
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE 'plane_' || l.doc_id = plane_name AND l.quality = 1 AND l.toxic = 0)""",
    "movie_union": with_(MOVIE)
    + """
SELECT plane, frame, count(*) AS n, CAST(sum(CAST(value AS BIGINT)) AS BIGINT) AS total FROM movie GROUP BY plane, frame""",
    "movie_signal": with_(MOVIE, PIXELS, CELL_TRACE)
    + f"SELECT plane, {r6('avg(f)')} AS mean_trace, {r6('stddev_pop(f)')} AS std_trace FROM cell_trace GROUP BY plane",
    "movie_concat": """
WITH frames AS (
  SELECT o_orderpriority AS file, o_orderkey,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS frame
  FROM orders
), starts AS (
  SELECT a.file, (SELECT count(*) FROM orders b WHERE b.o_orderpriority < a.file) AS first_frame
  FROM (SELECT DISTINCT file FROM frames) a
)
SELECT file, o_orderkey, frame, CAST(first_frame + frame AS BIGINT) AS global_frame FROM frames JOIN starts USING (file)""",
    "movie_shape": with_(MOVIE)
    + """
SELECT plane, 'movie' AS file, max(frame) + 1 AS n_frames, CAST(max(y) + 1 AS BIGINT) AS height,
       CAST(max(x) + 1 AS BIGINT) AS width
FROM movie GROUP BY plane""",
    "registration_images": with_(MOVIE)
    + f"""
, maps AS (
  SELECT plane, y, x, min(value) AS ref, max(value) AS top, avg(value) AS mean, max(l_quantity) AS enhanced
  FROM movie GROUP BY plane, y, x
)
SELECT plane, 1 AS panel, 'refImg' AS kind, y, x, {r6("ref")} AS value FROM maps
UNION ALL SELECT plane, 2, 'max_proj', y, x, {r6("top")} FROM maps
UNION ALL SELECT plane, 3, 'meanImg', y, x, {r6("mean")} FROM maps
UNION ALL SELECT plane, 4, 'meanImgE', y, x, {r6("enhanced")} FROM maps""",
    "roi_trace_extract": with_(MOVIE, PIXELS, CELL_TRACE)
    + f"SELECT plane, roi, frame, {r6('f')} AS f FROM cell_trace",
    "neuropil_trace": with_(MOVIE, PIXELS, RING, RING_TRACE)
    + f"SELECT plane, roi, frame, {r6('fneu')} AS fneu FROM ring_trace",
    "extracted_traces": with_(MOVIE, PIXELS, RING, CELL_TRACE, RING_TRACE)
    + f"""
SELECT plane, roi, frame, {r6("f")} AS f, {r6("fneu")} AS fneu
FROM cell_trace FULL JOIN ring_trace USING (plane, roi, frame)""",
    "extracted_traces_shuffled": with_(MOVIE, PIXELS, RING, CELL_TRACE, RING_TRACE)
    + f"""
SELECT plane, roi, frame, {r6("f")} AS f, {r6("fneu")} AS fneu
FROM cell_trace FULL JOIN ring_trace USING (plane, roi, frame)""",
    "superres_mean": with_(MOVIE)
    + f"""
SELECT plane, CAST(floor((frame % 4) * 0.25 / 0.5) AS INTEGER) AS dy_bin,
       CAST(floor((frame % 2) * 0.5 / 0.5) AS INTEGER) AS dx_bin, y, x, {r6("avg(value)")} AS value
FROM movie GROUP BY 1, 2, 3, 4, 5""",
}
