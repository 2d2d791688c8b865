"""Queries over trajectories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CropConfig, FrameSize, TrackConfig
from ..operators import tracks as T
from ..sources.views import detections

C = TrackConfig(min_track_frames=60, min_ankle_variance=400.0)
# a small frame, so that the views' points meet its borders
CROP = TrackConfig(frame=FrameSize(400, 300))
FEET = CropConfig(width=120, height=90, frame=FrameSize(400, 300))
KEY = list(T.KEY)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def stats(spark, d) -> DataFrame:
    return T.motion_stats(T.without_ghosts(detections(spark, d), C.min_track_frames))


def shown(df: DataFrame) -> DataFrame:
    return rounded(df, "avg_speed").withColumns({n: F.round(n, 4) for n in ("ankle_variance", "vertical_oscillation")}).drop("first_seen")


def body(spark, d) -> DataFrame:
    """detections with a body's box made of the track and the height"""
    side = F.col("track_id") % 200
    return detections(spark, d).withColumns({"bx1": side, "by1": side, "bx2": side + 80, "by2": side + F.col("bbox_height").cast("int")})


QUERIES = {
    "f1_motion_stats": lambda s, d: shown(T.select_runners(stats(s, d), C)),
    "f1_ghost_filter": lambda s, d: T.without_ghosts(detections(s, d), 65).groupBy("video_id").agg(F.count_distinct("track_id").alias("tracks"), F.count("*").alias("frames")),
    "f1_runner_ratio": lambda s, d: T.select_runners(stats(s, d), TrackConfig(min_speed_ratio=0.9)).select(*KEY, "frame_count"),
    "f1_runner_topn": lambda s, d: T.of_tracks(detections(s, d), T.select_runners(stats(s, d), TrackConfig(top_n=5, min_ankle_variance=400.0))).groupBy(*KEY).agg(F.count("*").alias("frames")),
    "f1_interpolate_centers": lambda s, d: rounded(T.fill_centres(detections(s, d), C.frame).select(*KEY, "frame_idx", "cx", "cy"), "cx", "cy"),
    "f1_interpolate_heights": lambda s, d: rounded(T.fill_sizes(detections(s, d), C.frame).select(*KEY, "frame_idx", "height", "stride_width"), "height", "stride_width"),
    "f1_smooth": lambda s, d: rounded(
        T.fill_centres(detections(s, d), C.frame).select(*KEY, "frame_idx", "det_seq", T.smoothed(F.col("cx"), 5).alias("sx"), T.smoothed(F.col("cy"), 75).alias("sy")).drop("det_seq"), "sx", "sy"
    ),
    "f1_roi": lambda s, d: rounded(T.regions(detections(s, d), CROP).select(*KEY, "frame_idx", "roi_size", "cx", "cy", "x1", "y1", "x2", "y2", "stride_dominant"), "cx", "cy"),
    "f1_roi_stats": lambda s, d: rounded(T.region_stats(T.regions(detections(s, d), CROP)), "avg_roi"),
    "f1_crop_bounds_valid": lambda s, d: rounded(T.regions(detections(s, d), CROP).select(*KEY, "frame_idx", "crop_valid", "padding", *(v.alias(k) for k, v in T.paste_rectangle(CROP.frame).items())), "padding"),
    "f1_slice_clips": lambda s, d: clips(s, d, 16, 8),
    "f1_renumber_clips": lambda s, d: T.renumbered(clips(s, d, 16, 16)).select("video_id", "clip_name", F.format_string("CUT_%03d", "cut").alias("cut")),
    "f1_locf": lambda s, d: rounded(T.carried(detections(s, d), FEET).select(*KEY, "frame_idx", "seen", "cx", "cy"), "cx", "cy"),
    "f1_ghost_counts": lambda s, d: T.ghost_counts(detections(s, d), 65),
    "f1_ema": lambda s, d: T.exponential_mean(detections(s, d), FEET).withColumns({n: F.col(n).cast("float").cast("double") for n in ("sx", "sy")}),
    "f1_feet_bbox": lambda s, d: body(s, d).select(*KEY, "frame_idx", *(v.alias(k) for k, v in T.feet_box(("bx1", "by1", "bx2", "by2"), FEET).items())),
    "f1_feet_crop": lambda s, d: T.feet_crop(body(s, d).select(*KEY, "frame_idx", *(v.alias(k) for k, v in T.feet_box(("bx1", "by1", "bx2", "by2"), FEET).items())), FEET).select(*KEY, "frame_idx", "x1", "y1", "x2", "y2"),
    "f1_fixed_crop": lambda s, d: T.carried(detections(s, d), FEET).select(*KEY, "frame_idx", *(v.alias(k) for k, v in T.fixed_crop(F.col("cx"), F.col("cy"), FEET).items())),
    "f1_largest_detection": lambda s, d: T.largest_detection(detections(s, d), F.col("bbox_height") * F.col("bbox_height")).select("video_id", "frame_idx", "track_id", "bbox_height"),
}


def clips(spark, d, length: int, step: int) -> DataFrame:
    cut = T.clips(T.regions(detections(spark, d), CROP), length, step)
    name = T.clip_name(F.col("video_id"), F.col("track_id"), F.col("clip_no"))
    return cut.select(*KEY, "clip_no", name.alias("clip_name"), F.array_join(F.transform("frame_idxs", lambda x: x.cast("string")), ",").alias("frame_idxs"))


DET = """
det AS (SELECT 'video_' || (user_id % 4) AS video_id, user_id::INT AS track_id, event_type AS ev, value AS v, json_extract_string(props, '$.k')::INT AS k, event_id,
    (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id))::INT AS frame_idx FROM events),
pt AS (SELECT video_id, track_id, frame_idx,
    CASE WHEN ev IN ('purchase', 'signup', 'click') AND v > 0 THEN v END AS lx, CASE WHEN ev IN ('purchase', 'signup', 'click') AND v > 0 THEN (100 + k)::DOUBLE END AS ly,
    CASE WHEN ev IN ('purchase', 'signup', 'view') AND v > 0 THEN 2 * v END AS rx, CASE WHEN ev IN ('purchase', 'signup', 'view') AND v > 0 THEN (100 + 2 * k)::DOUBLE END AS ry,
    CASE WHEN event_id % 10 = 0 THEN 0.0::DOUBLE ELSE (100 + k)::DOUBLE END AS bh FROM det),
c AS (SELECT *, CASE WHEN lx IS NOT NULL AND rx IS NOT NULL THEN (lx + rx) / 2 ELSE coalesce(lx, rx) END AS cx, CASE WHEN lx IS NOT NULL AND rx IS NOT NULL THEN (ly + ry) / 2 ELSE coalesce(ly, ry) END AS cy,
    CASE WHEN lx IS NOT NULL AND rx IS NOT NULL THEN abs(lx - rx) END AS st, count(*) OVER (PARTITION BY track_id) AS n, row_number() OVER (PARTITION BY track_id ORDER BY frame_idx) AS rn FROM pt)
"""
STATS = """
big AS (SELECT * FROM c WHERE n >= 60),
mv AS (SELECT video_id, track_id, sqrt((cx - lag(cx) OVER w) ** 2 + (cy - lag(cy) OVER w) ** 2) AS step FROM big WHERE cx IS NOT NULL WINDOW w AS (PARTITION BY track_id ORDER BY frame_idx)),
sp AS (SELECT track_id, avg(step) AS avg_speed FROM mv GROUP BY track_id),
st AS (SELECT video_id, track_id, coalesce(any_value(avg_speed), 0) AS avg_speed, coalesce(var_pop(st), 0) AS ankle_variance, coalesce(var_pop(cy), 0) AS vertical_oscillation, count(*) AS frame_count, max(coalesce(any_value(avg_speed), 0)) OVER (PARTITION BY video_id) AS mx
    FROM big LEFT JOIN sp USING (track_id) GROUP BY video_id, track_id)
"""


def fill_sql(x: str, other: str, name: str) -> str:
    """SQL of filled() over the window names past and ahead."""
    known = f"CASE WHEN {x} IS NOT NULL THEN rn END"
    a, b, p, q = f"last_value({x} IGNORE NULLS) OVER past", f"first_value({x} IGNORE NULLS) OVER ahead", f"last_value({known} IGNORE NULLS) OVER past", f"first_value({known} IGNORE NULLS) OVER ahead"
    return f"CASE WHEN {x} IS NOT NULL THEN {x} WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} + (rn - {p}) / ({q} - {p})::DOUBLE * ({b} - {a}) ELSE coalesce({a}, {b}, {other}::DOUBLE) END AS {name}"


WINDOWS = "WINDOW past AS (PARTITION BY track_id ORDER BY frame_idx ROWS UNBOUNDED PRECEDING), ahead AS (PARTITION BY track_id ORDER BY frame_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def mean_sql(x: str, w: int) -> str:
    return f"CASE WHEN n < {w} THEN {x} ELSE avg({x}) OVER (PARTITION BY track_id ORDER BY frame_idx ROWS BETWEEN {w // 2} PRECEDING AND {w // 2} FOLLOWING) END"


def filled_sql(width: int, height: int) -> str:
    heights = "SELECT *, CASE WHEN bh > 0 THEN bh END AS h0, CASE WHEN st > 0 THEN st END AS s0 FROM c"
    return f"f AS (SELECT video_id, track_id, frame_idx, n, rn, {fill_sql('cx', str(width / 2), 'cx')}, {fill_sql('cy', f'{0.8 * height}', 'cy')}, {fill_sql('h0', f'{0.3 * height}', 'height')}, {fill_sql('s0', f'{0.3 * height}', 'stride_width')} FROM ({heights}) {WINDOWS})"


ROI = f"""{filled_sql(400, 300)},
sm AS (SELECT video_id, track_id, frame_idx, n, rn, {mean_sql('cx', 5)} AS cx, {mean_sql('cy', 5)} AS cy0, {mean_sql('height', 15)} AS h, {mean_sql('stride_width', 15)} AS s FROM f),
sz AS (SELECT *, h * 0.40::DOUBLE AS hb, s + 2 * h * 0.15::DOUBLE AS sb FROM sm),
ro AS (SELECT *, greatest(hb, sb, 128.0) AS roi0, sb > hb AND sb > 128 AS stride_dominant FROM sz),
rs AS (SELECT *, trunc({mean_sql('roi0', 15)})::INT AS roi_size FROM ro),
pl AS (SELECT *, cy0 - 0.15::DOUBLE * roi_size + roi_size * 0.1::DOUBLE AS cy, roi_size // 2 AS half FROM rs),
bd AS (SELECT *, trunc(cx - half)::INT AS x1, trunc(cy - half)::INT AS y1, trunc(cx + half)::INT AS x2, trunc(cy + half)::INT AS y2 FROM pl),
pad AS (SELECT *, (greatest(-x1, 0) + greatest(-y1, 0) + greatest(x2 - 400, 0) + greatest(y2 - 300, 0)) * roi_size / (roi_size * roi_size)::DOUBLE AS padding FROM bd),
ok AS (SELECT *, padding <= 0.25 AS crop_valid FROM pad)"""
CARRIED = "ca AS (SELECT video_id, track_id, frame_idx, cx IS NOT NULL AS seen, coalesce(last_value(cx IGNORE NULLS) OVER w, 200.0::DOUBLE) AS cx, coalesce(last_value(cy IGNORE NULLS) OVER w, 255.0::DOUBLE) AS cy FROM c WINDOW w AS (PARTITION BY track_id ORDER BY frame_idx ROWS UNBOUNDED PRECEDING))"
FEET_SQL = """bo AS (SELECT *, track_id % 200 AS bx1, track_id % 200 AS by1, track_id % 200 + 80 AS bx2, track_id % 200 + trunc(bh)::INT AS by2, trunc(least(lx, rx))::INT AS lo, trunc(greatest(lx, rx))::INT AS hi, trunc(least(ly, ry))::INT AS top FROM c),
fe AS (SELECT video_id, track_id, frame_idx, CASE WHEN lo IS NULL THEN bx1 ELSE trunc((lo + hi) / 2 - greatest(hi - lo, 50) / 2)::INT END AS fx1, CASE WHEN lo IS NULL THEN by2 - trunc((by2 - by1) * 0.25)::INT ELSE top - 20 END AS fy1,
    CASE WHEN lo IS NULL THEN bx2 ELSE trunc((lo + hi) / 2 + greatest(hi - lo, 50) / 2)::INT END AS fx2, by2 AS fy2 FROM bo)"""
A43 = "(120 / 90::DOUBLE)"


def clip_sql(step: int) -> str:
    return f"""{ROI}, va AS (SELECT video_id, track_id, frame_idx, row_number() OVER w - 1 AS r, count(*) OVER (PARTITION BY track_id) AS m FROM ok WHERE crop_valid WINDOW w AS (PARTITION BY track_id ORDER BY frame_idx)),
    ks AS (SELECT DISTINCT video_id, track_id, unnest(range((m - 16) // {step} + 1)) AS k FROM va WHERE m >= 16),
    cl AS (SELECT video_id, track_id, (k + 1)::INT AS clip_no, printf('%s_ID_%d_clip_%03d', video_id, track_id, k + 1) AS clip_name, string_agg(frame_idx, ',' ORDER BY r) AS frame_idxs FROM va JOIN ks USING (video_id, track_id) WHERE r BETWEEN k * {step} AND k * {step} + 15 GROUP BY ALL)"""


def clamp_sql(v: str, most: int) -> str:
    return f"least(greatest({v}, 0), {most})"


def sides_sql(v: str, size: int, most: int, name: str) -> str:
    lo, hi = f"trunc({v} - {size // 2})::INT", f"trunc({v} + {size // 2})::INT"
    return f"CASE WHEN {lo} < 0 THEN 0 WHEN {hi} > {most} THEN {max(0, most - size)} ELSE {lo} END AS {name}1, CASE WHEN {lo} < 0 THEN {min(size, most)} WHEN {hi} > {most} THEN {most} ELSE {hi} END AS {name}2"


SHOWN = "video_id, track_id, round(avg_speed, 6) AS avg_speed, round(ankle_variance, 4) AS ankle_variance, round(vertical_oscillation, 4) AS vertical_oscillation, frame_count"
SQL = {
    "f1_motion_stats": f"WITH {DET}, {STATS} SELECT {SHOWN} FROM st WHERE mx = 0 OR (avg_speed >= 0.5::DOUBLE * mx AND ankle_variance >= 400)",
    "f1_ghost_counts": f"WITH {DET} SELECT count(DISTINCT track_id) FILTER (n >= 65) AS kept, count(DISTINCT track_id) FILTER (n < 65) AS removed FROM c",
    "f1_ghost_filter": f"WITH {DET} SELECT video_id, count(DISTINCT track_id) AS tracks, count(*) AS frames FROM c WHERE n >= 65 GROUP BY video_id",
    "f1_runner_ratio": f"WITH {DET}, {STATS} SELECT video_id, track_id, frame_count FROM st WHERE mx = 0 OR avg_speed >= 0.9::DOUBLE * mx",
    "f1_runner_topn": f"WITH {DET}, {STATS}, rk AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY avg_speed DESC, track_id) AS r FROM st) SELECT video_id, track_id, frame_count AS frames FROM rk WHERE mx = 0 OR (r <= 5 AND ankle_variance >= 400)",
    "f1_interpolate_centers": f"WITH {DET}, {filled_sql(1920, 1080)} SELECT video_id, track_id, frame_idx, round(cx, 6) AS cx, round(cy, 6) AS cy FROM f",
    "f1_interpolate_heights": f"WITH {DET}, {filled_sql(1920, 1080)} SELECT video_id, track_id, frame_idx, round(height, 6) AS height, round(stride_width, 6) AS stride_width FROM f",
    "f1_smooth": f"WITH {DET}, {filled_sql(1920, 1080)} SELECT video_id, track_id, frame_idx, round({mean_sql('cx', 5)}, 6) AS sx, round({mean_sql('cy', 75)}, 6) AS sy FROM f",
    "f1_roi": f"WITH {DET}, {ROI} SELECT video_id, track_id, frame_idx, roi_size, round(cx, 6) AS cx, round(cy, 6) AS cy, x1, y1, x2, y2, stride_dominant FROM ok",
    "f1_roi_stats": f"WITH {DET}, {ROI} SELECT video_id, track_id, min(roi_size) AS min_roi, max(roi_size) AS max_roi, round(avg(roi_size), 6) AS avg_roi, count(*) FILTER (stride_dominant) AS stride_dominant FROM ok GROUP BY ALL",
    "f1_crop_bounds_valid": f"WITH {DET}, {ROI} SELECT video_id, track_id, frame_idx, crop_valid, round(padding, 6) AS padding, {clamp_sql('x1', 400)} AS sx, {clamp_sql('y1', 300)} AS sy, {clamp_sql('x1', 400)} - x1 AS dx, {clamp_sql('y1', 300)} - y1 AS dy, greatest({clamp_sql('x2', 400)} - {clamp_sql('x1', 400)}, 0) AS w, greatest({clamp_sql('y2', 300)} - {clamp_sql('y1', 300)}, 0) AS h FROM ok",
    "f1_slice_clips": f"WITH {DET}, {clip_sql(8)} SELECT * FROM cl",
    "f1_renumber_clips": f"WITH {DET}, {clip_sql(16)} SELECT video_id, clip_name, printf('CUT_%03d', row_number() OVER (PARTITION BY video_id ORDER BY clip_name)) AS cut FROM cl",
    "f1_locf": f"WITH {DET}, {CARRIED} SELECT video_id, track_id, frame_idx, seen, round(cx, 6) AS cx, round(cy, 6) AS cy FROM ca",
    "f1_ema": f"""WITH RECURSIVE {DET}, {CARRIED}, lo AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY frame_idx) AS r FROM ca WHERE NOT seen),
        e AS (SELECT video_id, track_id, frame_idx, r, cx AS sx, cy AS sy FROM lo WHERE r = 1 UNION ALL
        SELECT lo.video_id, lo.track_id, lo.frame_idx, lo.r, 0.15::DOUBLE * cx + (1 - 0.15::DOUBLE) * sx, 0.15::DOUBLE * cy + (1 - 0.15::DOUBLE) * sy FROM e JOIN lo ON lo.track_id = e.track_id AND lo.r = e.r + 1)
        SELECT video_id, track_id, frame_idx, sx::FLOAT::DOUBLE AS sx, sy::FLOAT::DOUBLE AS sy FROM e""",
    "f1_feet_bbox": f"WITH {DET}, {FEET_SQL} SELECT * FROM fe",
    "f1_feet_crop": f"""WITH {DET}, {FEET_SQL}, pa AS (SELECT *, trunc((fx2 - fx1) * 1.5)::INT AS w, trunc((fy2 - fy1) * 1.5)::INT AS h FROM fe), ap AS (SELECT *, w / nullif(h, 0)::DOUBLE AS a FROM pa),
        fi AS (SELECT *, CASE WHEN a > {A43} THEN w WHEN a IS NOT NULL THEN trunc(h * {A43})::INT END AS w2, CASE WHEN a > {A43} THEN trunc(w / {A43})::INT WHEN a IS NOT NULL THEN h END AS h2 FROM ap)
        SELECT video_id, track_id, frame_idx, CASE WHEN w2 IS NOT NULL THEN greatest(0, trunc((fx1 + fx2) / 2 - w2 / 2)::INT) END AS x1, CASE WHEN w2 IS NOT NULL THEN greatest(0, trunc((fy1 + fy2) / 2 - h2 / 2)::INT) END AS y1,
        CASE WHEN w2 IS NOT NULL THEN least(400, trunc((fx1 + fx2) / 2 + w2 / 2)::INT) END AS x2, CASE WHEN w2 IS NOT NULL THEN least(300, trunc((fy1 + fy2) / 2 + h2 / 2)::INT) END AS y2 FROM fi""",
    "f1_fixed_crop": f"WITH {DET}, {CARRIED} SELECT video_id, track_id, frame_idx, {sides_sql('cx', 120, 400, 'x')}, {sides_sql('cy', 90, 300, 'y')} FROM ca",
    "f1_largest_detection": f"WITH {DET} SELECT video_id, frame_idx, track_id, bh AS bbox_height FROM (SELECT *, row_number() OVER (PARTITION BY video_id, frame_idx ORDER BY bh * bh DESC, track_id) AS r FROM c) WHERE r = 1",
}
