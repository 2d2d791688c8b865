"""Crops, warps and both orders of kernels against loops over pixels, and tracks as a stream against tracks as a table."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionframe.config import CropConfig, FrameSize, RuntimeConfig, TrackConfig
from motionframe.functions import kernels as N
from motionframe.operators import augment as A
from motionframe.operators import crops
from motionframe.operators import tracks as T
from motionframe.streaming import trajectory

DETECTIONS = "video_id string, track_id int, frame_idx int, left_ankle struct<x:double,y:double>, right_ankle struct<x:double,y:double>, confidence double, bbox_height double, det_seq int"
PIXELS = "video_id string, frame_idx int, height int, width int, channels int, pixels binary, other int"


def reflected(i, n):
    while n > 1 and not 0 <= i < n:
        i = -i if i < 0 else 2 * n - 2 - i
    return i if n > 1 else 0


def at(frame, y, x):
    """Bilinear, pixel by pixel."""
    h, w = frame.shape[:2]
    t, l = math.floor(y), math.floor(x)
    out = np.zeros(frame.shape[2])
    for dy, wy in ((0, 1 - (y - t)), (1, y - t)):
        for dx, wx in ((0, 1 - (x - l)), (1, x - l)):
            out += wy * wx * frame[reflected(t + dy, h), reflected(l + dx, w)]
    return np.floor(out + 0.5).clip(0, 255).astype(np.uint8)


def turned(frame, degrees):
    h, w = frame.shape[:2]
    t = math.radians(degrees)
    out = np.zeros_like(frame)
    for y in range(h):
        for x in range(w):
            a, b = x - w / 2, y - h / 2
            out[y, x] = at(frame, math.sin(t) * a + math.cos(t) * b + h / 2, math.cos(t) * a - math.sin(t) * b + w / 2)
    return out


def close(a, b):
    return a.shape == b.shape and np.abs(a.astype(int) - b.astype(int)).max() <= 1 and (a != b).mean() < 0.01  # a half may fall either way


@pytest.mark.parametrize("shape", [(9, 12, 3), (7, 5, 1), (1, 6, 3), (2, 2, 3)])
def test_rotation_against_a_loop(shape):
    frame = np.random.default_rng(1).integers(0, 256, shape, np.uint8)
    for degrees in (0.0, 5.0, -3.7, 90.0, 181.0):
        assert close(N.rotated(frame, degrees), turned(frame, degrees))
    assert (N.rotated(frame, 0.0) == frame).all()


def test_a_quarter_turn_and_scaling():
    frame = np.arange(25, dtype=np.uint8).reshape(5, 5, 1)
    # about (2.5, 2.5), so the pixel at (y, x) comes from (x, 5 - y); beyond the edge it is mirrored
    assert all(N.rotated(frame, 90.0)[y, x, 0] == frame[x, reflected(5 - y, 5), 0] for y in range(5) for x in range(5))
    assert N.scale_room(10, 20, 1.1) == (1, 2) and N.scale_room(10, 20, 0.9) == (0, 0) and N.scale_room(4, 100, 1.1) == (0, 0)
    big = np.random.default_rng(2).integers(0, 256, (10, 20, 3), np.uint8)
    assert (N.scaled_crop(big, 1.1, 1, 2) == N.resized(big, 11, 22)[1:11, 2:22]).all()
    assert (N.scaled_crop(big, 0.9) == N.resized(N.resized(big, 9, 18), 10, 20)).all() and N.scaled_crop(big, 1.0).tolist() == big.tolist()
    with pytest.raises(ValueError):
        N.scaled_crop(big, 0.01)


def by_hand(frame, p, order, ratio=0.15):
    f = N.grayscale(frame)
    h, w = f.shape[:2]

    def scale(f):
        nh, nw = int(h * p["scale"]), int(w * p["scale"])
        top, left = (int(p["scale_top"] * (nh - h + 1)), int(p["scale_left"] * (nw - w + 1))) if nh > h else (0, 0)
        return N.scaled_crop(f, p["scale"], top, left)

    if p["flip"]:
        f = f[:, ::-1]
    if p["brightness"] is not None:
        f = N.brightness_contrast(f, p["brightness"], p["contrast"])
    if order == "runtime" and p["scale"] is not None:
        f = scale(f)
    if p["blur_sigma"] is not None:
        f = N.blur(f, p["blur_sigma"])
    if p["rotation"] is not None:
        f = turned(f, p["rotation"])
    if order == "offline" and p["scale"] is not None:
        f = scale(f)
    if p["cutout_top"] is not None:
        dy, dx = int(h * ratio**0.5), int(w * ratio**0.5)
        y, x = (int(p["cutout_top"] * (h - dy)), int(p["cutout_left"] * (w - dx))) if order == "offline" else (int(p["cutout_top"] * (h - dy + 1)), int(p["cutout_left"] * (w - dx + 1)))
        f = f.copy()
        f[y : y + dy, x : x + dx] = 128
    return f


def test_both_orders_against_a_loop(spark):
    rng = np.random.default_rng(5)
    clips = spark.createDataFrame([(f"clip_{k}",) for k in range(12)], "stem string")
    params = A.runtime_params(clips, RuntimeConfig(), epoch=3)
    every = {r.stem: r.asDict() for r in params.collect()}
    assert {r.stem: r.asDict() for r in A.runtime_params(clips.repartition(3), RuntimeConfig(), epoch=3).collect()} == every
    assert all(p["brightness"] is not None and 0.9 <= p["scale"] < 1.1 for p in every.values()) and 0 < sum(p["rotation"] is not None for p in every.values()) < 12
    still = A.runtime_params(clips, RuntimeConfig(brightness=0.0, contrast=0.0, scale=(1.0, 1.0), flip=0.0, blur=0.0, rotation=0.0, cutout=0.0)).first().asDict()
    assert not still["flip"] and all(still[p] is None for p in A.PARAMS)
    rows = [(f"clip_{k}", i, 12, 16, 3, rng.integers(0, 256, (12, 16, 3), np.uint8).tobytes()) for k in range(12) for i in range(2)]
    frames = spark.createDataFrame(rows, "stem string, i int, height int, width int, channels int, pixels binary").join(params, "stem")
    for order in N.ORDERS:
        got = N.augmented_frames(frames, order).collect()
        assert len(got) == len(rows) and got[0].__fields__ == frames.columns
        for r in got:
            raw = next(x[5] for x in rows if x[:2] == (r.stem, r.i))
            assert close(np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width, 3), by_hand(np.frombuffer(raw, np.uint8).reshape(12, 16, 3), every[r.stem], order))
    odd = spark.createDataFrame([(1, 2, 2, 3, None), (2, 2, 2, 3, bytearray(5)), (3, None, 2, 3, bytearray(12)), (4, 2, 2, 3, bytearray(12))], "i int, height int, width int, channels int, pixels binary")
    assert {r.i: r.pixels is not None for r in N.augmented_frames(odd).collect()} == {1: False, 2: False, 3: False, 4: True}
    with pytest.raises(ValueError):
        N.augmented_frames(odd, "none")


def test_crops_against_a_loop(spark):
    rng = np.random.default_rng(3)
    c = TrackConfig(min_roi=6, frame=FrameSize(40, 30), min_track_frames=1)
    rows, shots = [], {}
    for v in ("a", "b"):
        for k in range(8):
            shots[v, k] = rng.integers(0, 256, (30, 40, 3), np.uint8)
            for t in range(3):
                x, y = float(rng.integers(1, 42)), float(rng.integers(1, 32))
                rows.append((v, t, k, (x, y), (x + 3, y) if t else None, 0.5, float(rng.integers(5, 25)), 0))
    shots["a", 99] = shots["a", 0]  # a frame without a subject
    frames = spark.createDataFrame([(v, k, 30, 40, 3, f.tobytes(), 1) for (v, k), f in shots.items() if (v, k) != ("b", 7)] + [("b", 7, 30, 40, 3, bytes(7), 1)], PIXELS)
    regions = T.regions(spark.createDataFrame(rows, DETECTIONS), c)
    want = {}
    for r in regions.collect():
        if r.crop_valid:
            crop = np.zeros((r.roi_size, r.roi_size, 3), np.uint8)
            for y in range(max(r.y1, 0), min(r.y2, 30)):
                for x in range(max(r.x1, 0), min(r.x2, 40)):
                    crop[y - r.y1, x - r.x1] = shots[r.video_id, r.frame_idx][y, x]
            want[r.video_id, r.track_id, r.frame_idx] = crop
    assert len(want) > 20
    for side in (None, 16):
        df = crops.cropped(frames, regions, side)
        got = {(r.video_id, r.track_id, r.frame_idx): r for r in df.collect()}
        assert got.keys() == want.keys()
        for k, r in got.items():
            if k[0] == "b" and k[2] == 7:
                assert r.pixels is None and r.height is None
                continue
            crop = want[k] if side is None else N.resized(want[k], side, side)
            assert (r.height, r.width, r.channels) == crop.shape and bytes(r.pixels) == crop.tobytes()
    # the pixels meet the regions of their frame by one exchange, and aren't sorted
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = crops.cropped(frames, regions)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(video_id#\d+, frame_idx#\d+, ", plan)) == 2  # frames, and regions by frame
    assert crops.cropped(frames.limit(0), regions).count() == 0 == crops.cropped(frames, regions.limit(0)).count()


def plain_mean(x, alpha):
    out, mean = [], None
    for v in x:
        mean = v if mean is None else alpha * v + (1 - alpha) * mean
        out.append(mean)
    return out


def test_running_mean():
    x = np.random.default_rng(0).normal(500, 100, 1000)
    for alpha in (0.15, 0.9, 1.0, 0.001):
        assert np.allclose(T.running_mean(x, alpha), plain_mean(x, alpha), rtol=1e-12)
        part = T.running_mean(x[:333], alpha)
        assert np.allclose(T.running_mean(x[333:], alpha, part[-1]), plain_mean(x, alpha)[333:], rtol=1e-12)
    assert len(T.running_mean(x[:0], 0.5)) == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_a_stream_of_tracks_is_the_table(spark, tmp_path, seed):
    """However frames are cut into batches, and whether the stream stops in between."""
    rng = random.Random(seed)
    c = CropConfig(frame=FrameSize(640, 360))
    rows = []
    for v in "ab":
        for t in range(3):
            for k in range(150):
                for d in range(rng.choice([1, 1, 1, 2])):
                    see = lambda: (float(rng.randrange(600)), float(rng.randrange(300))) if rng.random() < 0.35 else None
                    rows.append((v, t, k, see(), see(), 0.5, 100.0, d))
    whole = spark.createDataFrame(rows, DETECTIONS)
    todo, cuts = tmp_path / "todo", sorted(rng.sample(range(1, 149), 4))
    trajectory.stateful(spark)
    got = []
    for n, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, 150], strict=True)):
        whole.where(f"frame_idx >= {lo} and frame_idx < {hi}").orderBy(F.rand(seed)).coalesce(1).write.mode("append").parquet(str(todo))
        if n % 2:  # two batches' files at once now and then
            continue
        stream = trajectory.carried(spark.readStream.schema(DETECTIONS).option("maxFilesPerTrigger", 1).parquet(str(todo)), c)
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
    got = {(r.video_id, r.track_id, r.frame_idx, r.det_seq): r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = T.carried(whole, c).collect()
    assert len(got) == len(want) == len(rows)
    for r in want:
        g = got[r.video_id, r.track_id, r.frame_idx, r.det_seq]
        assert (g.seen, g.cx, g.cy) == (r.seen, r.cx, r.cy) and (g.sx is None) == r.seen
    for v, t, k, sx, sy in T.exponential_mean(whole, c).dropDuplicates(["video_id", "track_id", "frame_idx"]).collect():
        of = [g for (a, b, i, _), g in got.items() if (a, b, i) == (v, t, k) and not g.seen]
        assert any(abs(g.sx - sx) < 1e-9 and abs(g.sy - sy) < 1e-9 for g in of)
    # a frame that is older than what its track has had
    whole.where("frame_idx = 3 and track_id = 1").coalesce(1).write.mode("append").parquet(str(todo))
    late = trajectory.carried(spark.readStream.schema(DETECTIONS).parquet(str(todo)), c)
    with pytest.raises(Exception, match="comes after frame"):
        late.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
