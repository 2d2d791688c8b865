"""Pixels of the crops of tracks, from frames and regions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from ..functions.kernels import framed, padded_crop, resized

FRAME = ("video_id", "frame_idx")
#: Bytes of crops that are handed over at once.
MOST = 1 << 23
#: What a crop's row takes in Python beside its bytes, or a little more.
BESIDE = 1 << 10
#: Regions of a frame that are a row.
TOGETHER = 256


def square_crop(frame: np.ndarray, x1: int, y1: int, x2: int, y2: int, size: int) -> np.ndarray:
    """size x size, black but for what of the frame lies within the bounds; bounds of an odd size are a row and a column short of it."""
    out = np.zeros((size, size, *frame.shape[2:]), frame.dtype)
    part = padded_crop(frame, x1, y1, min(x2, x1 + size), min(y2, y1 + size))
    out[: part.shape[0], : part.shape[1]] = part
    return out


def cropped(frames: DataFrame, regions: DataFrame, side: int | None = 224, valid: Column | None = None) -> DataFrame:
    """(video_id, frame_idx, track_id, det_seq, height, width, channels, pixels): a crop a region whose frame is there.

    frames has video_id, frame_idx, height, width, channels and pixels; regions
    has video_id, track_id, frame_idx, det_seq, roi_size, x1, y1, x2, y2, of which
    those that aren't `valid` are left out (crop_valid, where there is such a
    column).  Crops are brought to side x side, or left as they are if it is None.
    A frame whose bytes don't fit its shape, and a region of no size, have crops of null.

    The regions of a frame are rows of TOGETHER, so that no row grows with the
    number of its tracks, and meet the frame in one exchange: its pixels cross it
    once, whatever the number of tracks, and aren't sorted, for the regions of a
    partition are the side that is hashed.  A worker gets them once a row.
    """
    if valid is None:
        valid = F.col("crop_valid") if "crop_valid" in regions.columns else F.lit(True)
    one = F.struct("track_id", "det_seq", "roi_size", "x1", "y1", "x2", "y2")
    place = F.row_number().over(Window.partitionBy(*FRAME).orderBy("track_id", "det_seq")) - 1
    few = regions.where(valid).withColumn("_row", F.floor(place / TOGETHER)).groupBy(*FRAME, "_row")
    boxes = few.agg(F.sort_array(F.collect_list(one)).alias("boxes")).drop("_row")
    met = frames.select(*FRAME, "height", "width", "channels", "pixels").join(boxes.hint("shuffle_hash"), list(FRAME))
    kinds = regions.schema
    schema = StructType([*(f for f in met.schema if f.name in FRAME), kinds["track_id"], kinds["det_seq"], *(StructField(n, IntegerType()) for n in ("height", "width", "channels")), StructField("pixels", BinaryType())])
    arrow = to_arrow_schema(schema)

    def made(frame: np.ndarray | None, box: dict) -> tuple:
        size = box["roi_size"]
        if frame is None or size is None or size <= 0 or None in (box["x1"], box["y1"], box["x2"], box["y2"]):
            return None, None, None, None
        crop = square_crop(frame, box["x1"], box["y1"], box["x2"], box["y2"], size)
        crop = crop if side is None else resized(crop, side, side)
        return *crop.shape, np.ascontiguousarray(crop).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for k in range(batch.num_rows):  # a frame at a time: the rest of the batch stays as it came
                row = {n: batch.column(n)[k] for n in batch.schema.names}
                frame = framed(row["pixels"], *(row[n].as_py() for n in ("height", "width", "channels")))
                where = tuple(row[n].as_py() for n in FRAME)
                for box in row["boxes"].as_py():
                    rows.append((*where, box["track_id"], box["det_seq"], *made(frame, box)))
                    held += len(rows[-1][-1] or b"") + BESIDE
                    if held >= MOST:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return met.mapInArrow(run, schema)
