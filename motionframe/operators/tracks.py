"""Trajectories of detections: gap filling, smoothing, motion statistics, selection, crop regions and clips.

Every operator takes detections as DataFrames and works on windows over
(video_id, track_id), so a plan of several of them shuffles once.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import CropConfig, FrameSize, TrackConfig

KEY = ("video_id", "track_id")


def of_track() -> WindowSpec:
    return Window.partitionBy(*KEY)


def in_order() -> WindowSpec:
    return of_track().orderBy("frame_idx", "det_seq")


def both_seen() -> Column:
    return F.col("left_ankle").isNotNull() & F.col("right_ankle").isNotNull()


def centre(axis: str) -> Column:
    """The ankles' midpoint, or the one that is seen, or null."""
    left, right = F.col(f"left_ankle.{axis}"), F.col(f"right_ankle.{axis}")
    return F.when(both_seen(), (left + right) / 2).otherwise(F.coalesce(left, right))


def stride() -> Column:
    """The distance between both ankles; 0 where it isn't known."""
    return F.when(both_seen(), F.abs(F.col("left_ankle.x") - F.col("right_ankle.x"))).otherwise(0.0)


def motion_stats(detections: DataFrame) -> DataFrame:
    """avg_speed, ankle_variance, vertical_oscillation and frame_count of each track.

    Speed is the mean distance between consecutive frames that have a centre.  A
    track of one frame has zeros.
    """
    row = detections.select(*KEY, "frame_idx", "det_seq", centre("x").alias("cx"), centre("y").alias("cy"), F.when(both_seen(), stride()).alias("width"))
    before = in_order().rowsBetween(Window.unboundedPreceding, -1)
    step = F.sqrt(F.pow(F.col("cx") - F.last("cx", True).over(before), 2) + F.pow(F.col("cy") - F.last("cy", True).over(before), 2))
    first = F.min(F.struct("frame_idx", "det_seq"))
    mean = lambda c: F.when(F.count("*") > 1, F.coalesce(c, F.lit(0.0))).otherwise(0.0)
    return row.withColumn("step", step).groupBy(*KEY).agg(
        mean(F.avg("step")).alias("avg_speed"), mean(F.var_pop("width")).alias("ankle_variance"), mean(F.var_pop("cy")).alias("vertical_oscillation"), F.count("*").alias("frame_count"), first.alias("first_seen")
    )


def without_ghosts(detections: DataFrame, min_frames: int) -> DataFrame:
    """Detections of tracks with at least min_frames of them, whether ankles are seen or not."""
    return detections.withColumn("_n", F.count("*").over(of_track())).where(F.col("_n") >= min_frames).drop("_n")


def ghost_counts(detections: DataFrame, min_frames: int) -> DataFrame:
    """One row: the tracks that without_ghosts() keeps, and those that it removes."""
    per = detections.groupBy(*KEY).agg(F.count("*").alias("_n"))
    return per.agg(F.count_if(F.col("_n") >= min_frames).alias("kept"), F.count_if(F.col("_n") < min_frames).alias("removed"))


def select_runners(stats: DataFrame, c: TrackConfig) -> DataFrame:
    """The tracks of motion_stats that move.

    The top_n fastest of a video, or without top_n those that reach
    min_speed_ratio of the fastest; of these, those with min_ankle_variance.
    Where nothing moves, all stay.  Of equally fast tracks the one seen first wins.
    """
    video = Window.partitionBy("video_id")
    fastest = F.max("avg_speed").over(video)
    if c.top_n > 0:
        quick = F.row_number().over(video.orderBy(F.desc("avg_speed"), "first_seen", "track_id")) <= c.top_n
    else:
        quick = F.col("avg_speed") >= c.min_speed_ratio * fastest
    steady = F.col("ankle_variance") >= c.min_ankle_variance if c.min_ankle_variance > 0 else F.lit(True)
    return stats.withColumn("_keep", (fastest == 0) | (quick & steady)).where("_keep").drop("_keep")


def of_tracks(detections: DataFrame, kept: DataFrame) -> DataFrame:
    return detections.join(kept.select(*KEY), list(KEY), "left_semi")


def filled(value: Column, otherwise: Column) -> Column:
    """Nulls of a track filled linearly by place in the track, the ends with the nearest value; all null: otherwise."""
    place = F.row_number().over(in_order())
    past, to_come = in_order().rowsBetween(Window.unboundedPreceding, 0), in_order().rowsBetween(0, Window.unboundedFollowing)
    known = F.when(value.isNotNull(), place)
    a, b = F.last(value, True).over(past), F.first(value, True).over(to_come)
    p, q = F.last(known, True).over(past), F.first(known, True).over(to_come)
    between = a + (place - p) / (q - p) * (b - a)
    return F.when(value.isNotNull(), value).when(a.isNotNull() & b.isNotNull(), between).otherwise(F.coalesce(a, b, otherwise))


def smoothed(value: Column, window: int) -> Column:
    """Centred moving mean, shorter at the ends; a track shorter than the window stays as it is."""
    half = window // 2
    return F.when(F.count("*").over(of_track()) < window, value).otherwise(F.avg(value).over(in_order().rowsBetween(-half, half)))


def fill_centres(detections: DataFrame, frame: FrameSize) -> DataFrame:
    """detections with cx and cy in every row."""
    raw = detections.withColumns({"cx": centre("x"), "cy": centre("y")})
    return raw.withColumns({"cx": filled(F.col("cx"), F.lit(frame.width / 2)), "cy": filled(F.col("cy"), F.lit(0.8 * frame.height))})


def fill_sizes(detections: DataFrame, frame: FrameSize) -> DataFrame:
    """detections with height and stride_width in every row; what isn't positive counts as missing, for both."""
    positive = lambda c: F.when(c > 0, c)
    raw = detections.withColumns({"height": positive(F.col("bbox_height")), "stride_width": positive(stride())})
    rest = F.lit(0.3 * frame.height)
    return raw.withColumns({"height": filled(F.col("height"), rest), "stride_width": filled(F.col("stride_width"), rest)})


def whole(c: Column) -> Column:
    """Cut toward zero."""
    return c.cast("int")


def regions(detections: DataFrame, c: TrackConfig) -> DataFrame:
    """detections with roi_size, cx, cy, x1, y1, x2, y2, stride_dominant and crop_valid: the crop of every frame.

    Its size follows the body's height and the stride, both filled and smoothed;
    its centre puts the ankles at ankle_vertical_ratio.  A crop is valid if its
    strips outside the frame are at most max_padding_ratio of it.
    """
    base = fill_sizes(fill_centres(detections, c.frame), c.frame)
    smooth = base.withColumns(
        {"cx": smoothed(F.col("cx"), c.window), "cy": smoothed(F.col("cy"), c.window), "height": smoothed(F.col("height"), c.height_window), "stride_width": smoothed(F.col("stride_width"), c.height_window)}
    )
    by_height, by_stride = F.col("height") * c.roi_height_ratio, F.col("stride_width") + 2 * F.col("height") * c.foot_length_ratio
    sized = smooth.withColumns({"_roi": F.greatest(by_height, by_stride, F.lit(float(c.min_roi))), "stride_dominant": (by_stride > by_height) & (by_stride > c.min_roi)})
    sized = sized.withColumn("roi_size", whole(smoothed(F.col("_roi"), c.height_window))).drop("_roi")
    above = float(Decimal("0.5") - Decimal(str(c.ankle_vertical_ratio)))  # 0.5 - 0.35 in doubles is over 0.15, which moves bounds that are whole
    placed = sized.withColumn("cy", F.col("cy") - above * F.col("roi_size") + F.col("roi_size") * c.side_offset_ratio)
    half = F.expr("roi_size div 2")
    bounds = placed.withColumns({"x1": whole(F.col("cx") - half), "y1": whole(F.col("cy") - half), "x2": whole(F.col("cx") + half), "y2": whole(F.col("cy") + half)})
    over = F.greatest(-F.col("x1"), F.lit(0)) + F.greatest(-F.col("y1"), F.lit(0)) + F.greatest(F.col("x2") - c.frame.width, F.lit(0)) + F.greatest(F.col("y2") - c.frame.height, F.lit(0))
    return bounds.withColumn("padding", over * F.col("roi_size") / (F.col("roi_size") * F.col("roi_size"))).withColumn("crop_valid", F.col("padding") <= c.max_padding_ratio)


def paste_rectangle(frame: FrameSize) -> dict[str, Column]:
    """Where a crop meets the frame (sx, sy) and where that lies in the crop (dx, dy), with its width and height."""
    clip = lambda v, most: F.least(F.greatest(F.col(v), F.lit(0)), F.lit(most))
    sx, sy = clip("x1", frame.width), clip("y1", frame.height)
    return {
        "sx": sx, "sy": sy, "dx": sx - F.col("x1"), "dy": sy - F.col("y1"),
        "w": F.greatest(clip("x2", frame.width) - sx, F.lit(0)), "h": F.greatest(clip("y2", frame.height) - sy, F.lit(0)),
    }


def region_stats(regions_: DataFrame) -> DataFrame:
    return regions_.groupBy(*KEY).agg(F.min("roi_size").alias("min_roi"), F.max("roi_size").alias("max_roi"), F.avg("roi_size").alias("avg_roi"), F.count_if("stride_dominant").alias("stride_dominant"))


def clips(regions_: DataFrame, length: int = 16, step: int = 16) -> DataFrame:
    """(video_id, track_id, clip_no, frame_idxs): windows of `length` valid frames of a track, every `step`.

    Frames count by their place among the valid ones.  Tracks with fewer have no
    clip, and what is left at a track's end is in none.
    """
    rn = F.row_number().over(in_order()) - 1
    row = regions_.where("crop_valid").select(*KEY, "frame_idx", "det_seq", rn.alias("rn"), F.count("*").over(of_track()).alias("n"))
    first = F.greatest(F.lit(0), F.floor((F.col("rn") - length) / step) + 1)
    last = F.least(F.floor(F.col("rn") / step), F.floor((F.col("n") - length) / step))
    inside = row.where((F.col("n") >= length) & (first <= last)).withColumn("k", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    out = inside.groupBy(*KEY, "k").agg(F.array_sort(F.collect_list(F.struct("rn", "frame_idx"))).alias("f"))
    return out.select(*KEY, (F.col("k") + 1).alias("clip_no"), F.transform("f", lambda x: x["frame_idx"]).alias("frame_idxs"))


def process(detections: DataFrame, c: TrackConfig, detect: bool = True) -> DataFrame:
    """The clips of a video's moving subjects, from its detections: short tracks go, then those that don't move, unless detect is off; the rest are cropped and cut."""
    real = without_ghosts(detections, c.min_track_frames)
    kept = of_tracks(real, select_runners(motion_stats(real), c)) if detect else real
    return clips(regions(kept, c), c.clip_length, c.clip_stride)


def clip_name(stem: Column, track: Column, number: Column) -> Column:
    return F.format_string("%s_ID_%d_clip_%03d", stem, track, number)


def renumbered(named: DataFrame) -> DataFrame:
    """named(video_id, clip_name) with cut: places from 1 in the order of the names of the whole video."""
    return named.withColumn("cut", F.row_number().over(Window.partitionBy("video_id").orderBy("clip_name")))


def carried(detections: DataFrame, c: CropConfig) -> DataFrame:
    """detections with cx, cy: the centre, else the last one, else the bottom centre of the frame."""
    past = in_order().rowsBetween(Window.unboundedPreceding, 0)
    return detections.withColumns({
        "seen": centre("x").isNotNull(), "cx": F.coalesce(F.last(centre("x"), True).over(past), F.lit(c.frame.width / 2)), "cy": F.coalesce(F.last(centre("y"), True).over(past), F.lit(0.85 * c.frame.height)),
    })


#: Places of a mean that one product of weights gives; powers of 1 - alpha beyond them would vanish.
BLOCK = 64


def running_mean(x: np.ndarray, alpha: float, start: float | None = None) -> np.ndarray:
    """The exponential mean at each place, which begins with the first value, or goes on from start."""
    out = np.empty(len(x))
    if not len(x):
        return out
    at = np.arange(min(BLOCK, len(x)))
    fall = (1 - alpha) ** np.maximum(at[:, None] - at, 0)
    weights = np.where(at[:, None] >= at, alpha * fall, 0.0)
    mean = x[0] if start is None else start  # a mean that begins with a value is moved by it nowhere
    for k in range(0, len(x), BLOCK):
        part = x[k : k + BLOCK]
        n = len(part)
        out[k : k + n] = weights[:n, :n] @ part + fall[:n, 0] * (1 - alpha) * mean
        mean = out[k + n - 1]
    return out


def exponential_mean(detections: DataFrame, c: CropConfig) -> DataFrame:
    """(video_id, track_id, frame_idx, sx, sy) of frames without detection: a mean that only such frames move.

    It recurs, so each track's frames, which its length bounds, are in one
    task, in the order of frame_idx and det_seq; rows of one place come in any.
    """
    lost = carried(detections, c).where("not seen").select(*KEY, "frame_idx", "det_seq", "cx", "cy")

    def run(track: pa.Table) -> pa.Table:
        track = track.sort_by([("frame_idx", "ascending"), ("det_seq", "ascending")])
        means = {new: pa.array(running_mean(track[old].to_numpy(), c.alpha)) for old, new in (("cx", "sx"), ("cy", "sy"))}
        return pa.table({k: track[k] for k in (*KEY, "frame_idx")} | means)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lost.schema if f.name not in ("det_seq", "cx", "cy"))
    return lost.groupBy(*KEY).applyInArrow(run, kinds + ", sx double, sy double")


def feet_box(body: tuple[str, str, str, str], c: CropConfig) -> dict[str, Column]:
    """fx1, fy1, fx2, fy2 from a body's box columns and the ankles: around the ankles, or the body's lower part."""
    bx1, by1, bx2, by2 = (F.col(x) for x in body)
    least = lambda axis: whole(F.least(F.col(f"left_ankle.{axis}"), F.col(f"right_ankle.{axis}")))
    none = F.col("left_ankle").isNull() & F.col("right_ankle").isNull()
    lo, hi, top = least("x"), whole(F.greatest("left_ankle.x", "right_ankle.x")), least("y")
    middle, half = (lo + hi) / 2, F.greatest(hi - lo, F.lit(50)) / 2
    pick = lambda without, with_: F.when(none, without).otherwise(with_)
    return {"fx1": pick(bx1, whole(middle - half)), "fy1": pick(by2 - whole((by2 - by1) * c.feet_ratio), top - 20), "fx2": pick(bx2, whole(middle + half)), "fy2": by2}


def feet_crop(boxes: DataFrame, c: CropConfig) -> DataFrame:
    """boxes(fx1, fy1, fx2, fy2) with x1, y1, x2, y2: padded, brought to the output's shape, inside the frame.

    Boxes without height after padding have nulls.
    """
    target = c.width / c.height
    wide = boxes.withColumns({"_w": whole((F.col("fx2") - F.col("fx1")) * c.padding), "_h": whole((F.col("fy2") - F.col("fy1")) * c.padding)})
    shape = F.try_divide(F.col("_w").cast("double"), F.col("_h").cast("double"))
    fit = wide.withColumn("_a", shape).withColumns(
        {"_w2": F.when(F.col("_a") > target, F.col("_w")).when(F.col("_a").isNotNull(), whole(F.col("_h") * target)), "_h2": F.when(F.col("_a") > target, whole(F.col("_w") / target)).when(F.col("_a").isNotNull(), F.col("_h"))}
    )
    cx, cy = (F.col("fx1") + F.col("fx2")) / 2, (F.col("fy1") + F.col("fy2")) / 2
    none = F.col("_a").isNull()
    edge = lambda v, most: F.when(~none, most(v))
    low, high = (lambda v: F.greatest(F.lit(0), v)), (lambda n: lambda v: F.least(F.lit(n), v))
    return fit.withColumns({
        "x1": edge(whole(cx - F.col("_w2") / 2), low), "y1": edge(whole(cy - F.col("_h2") / 2), low),
        "x2": edge(whole(cx + F.col("_w2") / 2), high(c.frame.width)), "y2": edge(whole(cy + F.col("_h2") / 2), high(c.frame.height)),
    }).drop("_w", "_h", "_a", "_w2", "_h2")


def fitted_size(c: CropConfig) -> tuple[int, int]:
    """The output's size, shrunk to fit the frame."""
    if c.width <= c.frame.width and c.height <= c.frame.height:
        return c.width, c.height
    scale = min(c.frame.width / c.width, c.frame.height / c.height)
    return int(c.width * scale), int(c.height * scale)


def fixed_crop(x: Column, y: Column, c: CropConfig) -> dict[str, Column]:
    """x1, y1, x2, y2 of a crop of fixed size around a point, shifted into the frame; the low side is looked at first."""
    out = {}
    for axis, v, size, most in zip("xy", (x, y), fitted_size(c), (c.frame.width, c.frame.height), strict=True):
        lo, hi = whole(v - size // 2), whole(v + size // 2)
        out[f"{axis}1"] = F.when(lo < 0, F.lit(0)).when(hi > most, F.lit(max(0, most - size))).otherwise(lo)
        out[f"{axis}2"] = F.when(lo < 0, F.lit(min(size, most))).when(hi > most, F.lit(most)).otherwise(hi)
    return out


def largest_detection(boxes: DataFrame, area: Column) -> DataFrame:
    """The row of each frame with the largest area, of equal ones the first."""
    rank = F.row_number().over(Window.partitionBy("video_id", "frame_idx").orderBy(area.desc(), "det_seq", "track_id"))
    return boxes.withColumn("_r", rank).where("_r = 1").drop("_r")
