"""Trajectory operators against plain restatements and worked cases."""

import math
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from motionframe.config import CropConfig, FrameSize, TrackConfig
from motionframe.operators import tracks as T
from motionframe.sources.files import DETECTIONS

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
point = st.one_of(st.none(), st.tuples(st.integers(1, 400).map(float), st.integers(1, 400).map(float)))
track = st.lists(st.tuples(point, point, st.integers(-5, 300).map(float)), min_size=1, max_size=30)


def frame(spark, tracks):
    rows = [("v", t, 3 * i + 1, a, b, 0.5, h, 0) for t, rows in enumerate(tracks) for i, (a, b, h) in enumerate(rows)]
    return spark.createDataFrame(rows, DETECTIONS)


def centre(a, b):
    if a and b:
        return ((a[0] + b[0]) / 2, (a[1] + b[1]) / 2)
    return a or b


def fill(values, other):
    known = [i for i, v in enumerate(values) if v is not None]
    if not known:
        return [other] * len(values)
    out = []
    for i, v in enumerate(values):
        p, q = max((k for k in known if k <= i), default=None), min((k for k in known if k >= i), default=None)
        out.append(v if v is not None else values[q] if p is None else values[p] if q is None else values[p] + (i - p) / (q - p) * (values[q] - values[p]))
    return out


def smooth(values, w):
    h = w // 2
    return values if len(values) < w else [statistics.fmean(values[max(0, i - h) : i + h + 1]) for i in range(len(values))]


def close(a, b):
    assert len(a) == len(b)
    assert all(math.isclose(x, y, abs_tol=1e-6) for x, y in zip(a, b)), (a, b)


def values(df, *names):
    rows = df.select("track_id", "frame_idx", *names).orderBy("track_id", "frame_idx").collect()
    return {n: [[r[n] for r in rows if r.track_id == t] for t in sorted({r.track_id for r in rows})] for n in names}


@FEW
@given(tracks=st.lists(track, min_size=1, max_size=4))
def test_filling_and_smoothing(spark, tracks):
    f = FrameSize()
    got = values(T.fill_sizes(T.fill_centres(frame(spark, tracks), f), f).withColumns({"s5": T.smoothed(F.col("cx"), 5), "s15": T.smoothed(F.col("height"), 15)}), "cx", "cy", "height", "stride_width", "s5", "s15")
    for i, rows in enumerate(tracks):
        cs = [centre(a, b) for a, b, _ in rows]
        x = fill([c and c[0] for c in cs], 960.0)
        h = fill([h if h > 0 else None for *_, h in rows], 324.0)
        close(got["cx"][i], x)
        close(got["cy"][i], fill([c and c[1] for c in cs], 864.0))
        close(got["height"][i], h)
        close(got["stride_width"][i], fill([abs(a[0] - b[0]) or None if a and b else None for a, b, _ in rows], 324.0))
        close(got["s5"][i], smooth(x, 5))
        close(got["s15"][i], smooth(h, 15))


@FEW
@given(tracks=st.lists(track, min_size=1, max_size=4))
def test_motion_stats(spark, tracks):
    got = {r.track_id: r for r in T.motion_stats(frame(spark, tracks)).collect()}
    for i, rows in enumerate(tracks):
        cs = [c for c in (centre(a, b) for a, b, _ in rows) if c]
        speed = [math.dist(p, q) for p, q in zip(cs, cs[1:])]
        wide = [abs(a[0] - b[0]) for a, b, _ in rows if a and b]
        wanted = [statistics.fmean(speed) if speed else 0, statistics.pvariance(wide) if wide else 0, statistics.pvariance([c[1] for c in cs]) if cs else 0]
        close([got[i].avg_speed, got[i].ankle_variance, got[i].vertical_oscillation], wanted if len(rows) > 1 else [0, 0, 0])
        assert got[i].frame_count == len(rows)


def test_worked_cases(spark):
    gap = [None, 10, None, None, 40, None]
    rows = [("v", 1, i, (float(x), 5.0) if x else None, None, 0.5, 10.0, 0) for i, x in zip([0, 1, 5, 6, 7, 20], gap)]
    got = values(T.fill_centres(spark.createDataFrame(rows, DETECTIONS), FrameSize()).withColumn("s", T.smoothed(F.col("cx"), 5)), "cx", "s")
    close(got["cx"][0], [10, 10, 20, 30, 40, 40])
    close(got["s"][0], [40 / 3, 17.5, 22, 28, 32.5, 110 / 3])
    moved = frame(spark, [[((10.0, 100.0), (20.0, 100.0), 1.0), (None, None, 1.0), ((18.0, 104.0), None, 1.0), ((21.0, 100.0), (33.0, 100.0), 1.0)]])
    r = T.motion_stats(moved).first()
    close([r.avg_speed, r.ankle_variance, r.vertical_oscillation], [7.424429, 1.0, 3.555556])


def test_selection_of_runners(spark):
    stats = lambda zero=False: spark.createDataFrame([("v", t, 0.0 if zero else s, float(v), 0.0, 9, (t, 0)) for t, s, v in ((1, 5.0, 500), (2, 9.0, 100), (3, 9.0, 450), (4, 1.0, 0))], "video_id string, track_id int, avg_speed double, ankle_variance double, vertical_oscillation double, frame_count bigint, first_seen struct<frame_idx:int,det_seq:int>")
    for top, variance, wanted in ((0, 0, {1, 2, 3}), (2, 0, {2, 3}), (1, 0, {2}), (2, 400, {3}), (0, 400, {1, 3})):
        assert {r.track_id for r in T.select_runners(stats(), TrackConfig(top_n=top, min_ankle_variance=variance)).collect()} == wanted
    assert T.select_runners(stats(True), TrackConfig(top_n=1, min_ankle_variance=400)).count() == 4


def test_clip_counts(spark):
    for n, length, step, wanted in ((100, 32, 16, 5), (47, 16, 16, 2), (16, 16, 16, 1), (15, 16, 16, 0), (40, 16, 4, 7)):
        rows = spark.range(n).select(F.lit("v").alias("video_id"), F.lit(1).alias("track_id"), (F.col("id") * 2).cast("int").alias("frame_idx"), F.lit(0).alias("det_seq"), F.lit(True).alias("crop_valid"))
        got = T.clips(rows, length, step).orderBy("clip_no").collect()
        assert [r.frame_idxs for r in got] == [[2 * (k * step + i) for i in range(length)] for k in range(wanted)]


def test_bounds_cut_toward_zero_and_padding_limit(spark):
    half = F.expr("151 div 2")
    assert spark.range(1).select(T.whole(F.lit(10.5) - half), T.whole(F.lit(10.5) + half), T.whole(F.lit(5.0) - half), T.whole(F.lit(5.0) + half)).first()[:] == (-64, 85, -70, 80)


def test_bounds_that_are_whole_stay_whole(spark):
    """125.1 - 0.15 * 162 + 162 * 0.1 is 117 in doubles; with 0.5 - 0.35, which is over 0.15, it is less, and the bound one lower."""
    r = T.regions(frame(spark, [[((100.0, 125.1), (101.0, 125.1), 405.0)]]), TrackConfig()).first()
    assert (r.roi_size, r.cy, r.y1, r.y2) == (162, 117.0, 36, 198)


def test_one_exchange_for_the_whole_chain(spark):
    plan = T.regions(frame(spark, [[((1.0, 1.0), None, 9.0)] * 3]), TrackConfig())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_names_sort_as_text(spark):
    named = spark.createDataFrame([("x", "x_ID_2_clip_002"), ("x", "x_ID_10_clip_001"), ("x", "x_ID_2_clip_001")], "video_id string, clip_name string")
    assert [(r.clip_name, r.cut) for r in T.renumbered(named).orderBy("cut").collect()] == [("x_ID_10_clip_001", 1), ("x_ID_2_clip_001", 2), ("x_ID_2_clip_002", 3)]


def test_crops_without_height_and_fitted_sizes(spark):
    boxes = spark.createDataFrame([(0, 10, 50, 10), (0, 10, 50, 60)], "fx1 int, fy1 int, fx2 int, fy2 int")
    a, b = T.feet_crop(boxes, CropConfig()).orderBy("fy2").collect()
    assert a.x1 is None and b.x2 > 0
    assert T.fitted_size(CropConfig(width=400, height=300, frame=FrameSize(200, 300))) == (200, 150)


def test_empty_input(spark):
    none = spark.createDataFrame([], DETECTIONS)
    assert T.motion_stats(none).count() == 0 and T.clips(T.regions(none, TrackConfig())).count() == 0 and T.exponential_mean(none, CropConfig()).count() == 0


def test_whole_process_keeps_the_clips_of_moving_subjects(spark):
    """Of a short track, one that stands and one that moves, with frames of 40, only the last has clips: (40 - 16) // 16 + 1."""
    moving = [((100.0 + 6 * i, 300.0), (104.0 + 6 * i, 300.0), 200.0) for i in range(40)]
    standing = [((700.0, 500.0), (704.0, 500.0), 200.0)] * 40
    rows = frame(spark, [moving[:10], standing, moving])
    assert [(r.track_id, r.clip_no, r.frame_idxs[0], len(r.frame_idxs)) for r in T.process(rows, TrackConfig()).orderBy("clip_no").collect()] == [(2, 1, 1, 16), (2, 2, 49, 16)]
    assert {r.track_id for r in T.process(rows, TrackConfig(), detect=False).collect()} == {1, 2}
