"""A network's part: clips as tensors, the model that a caller brings, and batches for training."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..functions.kernels import item
from .predict import percents, predicted

#: Clips that a model is given at once.
BATCH = 8


def clip_frames(pixels: bytes | None, n: int, height: int, width: int, channels: int) -> list[np.ndarray] | None:
    """The frames of a clip, whose bytes follow each other; None if they don't fit the shape."""
    if pixels is None or min(n, height, width, channels) <= 0 or len(pixels) != n * height * width * channels:
        return None
    return list(np.frombuffer(pixels, np.uint8).reshape(n, height, width, channels))


def taken(n: int, how: str = "uniform", length: int = 16, share: float = 0.0) -> list[int]:
    """Which of n frames a clip's tensor takes, as predict.sampled_frames() has it."""
    if n < length:
        return [i % n for i in range(length)]
    first = {"uniform": 0, "centre": (n - length) // 2, "offset": int(share * (n - length + 1))}[how]
    return [int(i * (n - 1) / (length - 1)) for i in range(length)] if how == "uniform" else list(range(first, first + length))


def tensor(pixels, n, height, width, channels, length: int, side: int) -> np.ndarray | None:
    frames = clip_frames(pixels, *(int(v or 0) for v in (n, height, width, channels)))
    return None if frames is None else item([frames[i] for i in taken(len(frames), length=length)], length, side)


SHAPE = ("frames", "height", "width", "channels")


def with_logits(clips: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]], length: int = 16, side: int = 224, batch: int = BATCH) -> DataFrame:
    """clips(pixels, frames, height, width, channels) with logits, null for a clip that can't be read.

    load gives a function from (N, length, channels, side, side) floats to
    (N, classes).  It is called once in each Python worker, which keeps what it
    gives for all batches and tasks; at most `batch` clips are tensors at once.
    """

    def make() -> Callable[..., np.ndarray]:
        model = load()

        def run(pixels: np.ndarray, frames: np.ndarray, height: np.ndarray, width: np.ndarray, channels: np.ndarray) -> np.ndarray:
            made = [tensor(*row, length, side) for row in zip(pixels, frames, height, width, channels, strict=True)]
            none = next((np.zeros_like(m) for m in made if m is not None), np.zeros((length, 3, side, side), np.float32))
            return np.asarray(model(np.stack([none if m is None else m for m in made])), np.float64)

        return run

    logits = predict_batch_udf(make, return_type=ArrayType(DoubleType()), batch_size=batch)
    fits = F.coalesce(F.octet_length("pixels") == F.col("frames").cast("bigint") * F.col("height") * F.col("width") * F.col("channels"), F.lit(False)) & (F.col("frames") > 0)
    shape = [F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in SHAPE]
    return clips.withColumn("logits", logits(F.coalesce(F.col("pixels"), F.lit(b"")), *shape)).withColumn("logits", F.when(fits, F.col("logits")))


def predict_clips(clips: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]], names: Column, length: int = 16, side: int = 224, batch: int = BATCH) -> DataFrame:
    """clips without their pixels, with probability_vector, predicted_idx, predicted_label, confidence and probabilities in percent by label."""
    out = predicted(with_logits(clips, load, length, side, batch).drop("pixels"), names)
    return out.withColumn("probabilities", percents(F.col("probability_vector"), names)).drop("logits")


def training_batches(clips: DataFrame, size: int = BATCH, length: int = 16, side: int = 224) -> DataFrame:
    """(batch, n, pixel_values, labels, filenames) of clips(place, path, label, pixels, frames, height, width, channels).

    Batch k has the clips of the places from k * size on, in order; the last one
    may be shorter, and its n says by how much.  pixel_values are (n, length, 3,
    side, side) floats, little-endian; a clip that can't be read is zeros.
    Places number the clips from 0, as a split or a shuffle of it does.  A batch
    is put together in one task, which holds no other.
    """
    at = F.col("place").cast("bigint")
    read = clips.select(F.floor(at / size).alias("batch"), at.alias("place"), F.element_at(F.split(F.regexp_replace("path", "/+$", ""), "/"), -1).alias("name"), F.col("label").cast("int").alias("label"), "pixels", *SHAPE)
    ordered = read.repartition("batch").sortWithinPartitions("batch", "place")
    kinds = {"batch": pa.int64(), "n": pa.int32(), "pixel_values": pa.binary(), "labels": pa.list_(pa.int32()), "filenames": pa.list_(pa.string())}

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        now = None

        def full() -> pa.RecordBatch:
            values = [(np.zeros((length, 3, side, side), np.float32) if t is None else t) for t, _, _ in rows]
            row = (now, len(rows), np.stack(values).astype("<f4").tobytes(), [r[1] for r in rows], [r[2] for r in rows])
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds.values(), strict=True)], list(kinds))

        for part in stream:
            for k in range(part.num_rows):
                row = {c: part.column(c)[k].as_py() for c in part.schema.names}
                if rows and row["batch"] != now:
                    yield full()
                    rows.clear()
                now = row["batch"]
                rows.append((tensor(row["pixels"], *(row[c] for c in SHAPE), length, side), row["label"], row["name"]))
        if rows:
            yield full()

    return ordered.mapInArrow(run, "batch bigint, n int, pixel_values binary, labels array<int>, filenames array<string>")
