"""Queries over pixels, and a sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..config import RuntimeConfig
from ..functions import kernels as N
from ..operators import augment as A
from ..operators import crops
from ..sources.views import detections, videos


def frames(s, d):
    """Frames of 8 x 8 pixels, whose bytes come from the digest of a name."""
    bytes_ = F.unhex(F.substring(F.concat_ws("", *(F.sha2(F.concat("stem", F.lit(f"|{k}")), 512) for k in range(3))), 1, 384))
    return videos(s, d).select("doc_id", F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(3).alias("channels"), bytes_.alias("pixels"), (F.col("doc_id") % 10 / 20).alias("top"))


def gray_flip_bc(frame: np.ndarray) -> np.ndarray:
    return N.brightness_contrast(N.flip(N.grayscale(frame)), 0.1, -0.1)


def cut_and_pad(frame: np.ndarray, top: float) -> np.ndarray:
    return N.padded_crop(N.cutout(frame, top, 0.25, 0.15), -2, 3, 7, 12)


def shown(df):
    return df.select("doc_id", "height", "width", F.sha2("pixels", 256).alias("pixels_sha256"))


def shots(s, d):
    """A grey frame of 20 x 30 for each frame of the detections."""
    seen = detections(s, d).select("video_id", "frame_idx").distinct()
    value = lambda k: (F.col("frame_idx") * 7 + F.substring("video_id", 7, 9).cast("int") * 17 + F.floor(k / 30) * 13 + k % 30 * 31) % 251
    bytes_ = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(599)), lambda k: F.lpad(F.hex(value(k)), 2, "0")), ""))
    return seen.select("*", F.lit(20).alias("height"), F.lit(30).alias("width"), F.lit(1).alias("channels"), bytes_.alias("pixels"))


def crop_sums(s, d):
    """Size and sum of the pixels of a crop for each detection; some crops reach beyond the frame."""
    size, x, y = 8 + F.col("track_id") % 8, F.col("track_id") * 3 % 34 - 4, F.col("frame_idx") * 5 % 24 - 4
    boxes = detections(s, d).select("video_id", "track_id", "frame_idx", "det_seq", size.alias("roi_size"), x.alias("x1"), y.alias("y1"), (x + size).alias("x2"), (y + size).alias("y2"))
    byte = lambda k: F.conv(F.hex(F.substring(F.col("pixels"), k, F.lit(1))), 16, 10).cast("long")
    total = F.aggregate(F.sequence(F.lit(1), F.octet_length("pixels")), F.lit(0).cast("long"), lambda a, k: a + byte(k))
    return crops.cropped(shots(s, d), boxes, side=None).select("video_id", "track_id", "frame_idx", F.col("height").alias("size"), total.alias("pixel_sum"))


def augmented(s, d):
    """Digests of the frames after the kernels of training, and of making versions, with the same draws."""
    drawn = A.runtime_params(frames(s, d).withColumn("stem", F.col("doc_id").cast("string")), RuntimeConfig())
    of = lambda order: shown(N.augmented_frames(drawn, order)).select("doc_id", F.lit(order).alias("kernel_order"), "height", "width", "pixels_sha256")
    return of("offline").unionByName(of("runtime"))


QUERIES = {
    "k_crops": crop_sums,
    "k_augmented": augmented,
    "k_gray_flip_bc": lambda s, d: shown(N.on_frames(frames(s, d), gray_flip_bc)),
    "k_cutout_pad": lambda s, d: shown(N.on_frames(frames(s, d), cut_and_pad, "top")),
    "t6_sample": lambda s, d: videos(s, d).orderBy(F.rand(7)).limit(100).select("doc_id", "path"),
}
SQL = {
    "k_crops": """
        WITH det AS (SELECT 'video_' || user_id % 4 AS video_id, user_id % 4 AS v, user_id::INT AS track_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INT AS frame_idx FROM events),
        box AS (SELECT *, 8 + track_id % 8 AS size, track_id * 3 % 34 - 4 AS x1, frame_idx * 5 % 24 - 4 AS y1 FROM det)
        SELECT video_id, track_id, frame_idx, size::INT AS size, coalesce(list_sum(list_transform(range(size * size), lambda k: CASE WHEN y1 + k // size BETWEEN 0 AND 19 AND x1 + k % size BETWEEN 0 AND 29 THEN (frame_idx * 7 + v * 17 + (y1 + k // size) * 13 + (x1 + k % size) * 31) % 251 ELSE 0 END)), 0)::BIGINT AS pixel_sum FROM box
    """,
}
