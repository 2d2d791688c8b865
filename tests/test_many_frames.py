"""Frames that are handled together."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from motionframe.functions import kernels as N
from motionframe.functions import stacks


@pytest.mark.parametrize("shape", [(8, 8, 3), (9, 13, 3), (1, 6, 3), (30, 41, 4)])
def test_stacks_are_byte_for_byte_the_kernels_of_each_frame(shape):
    rng = np.random.default_rng(3)
    frames = rng.integers(0, 256, (300, *shape), np.uint8)
    some = lambda p, v: v if rng.random() < p else None
    rows = []
    for _ in frames:
        u = rng.random(9).tolist()
        scale = some(0.8, 1 + 0.2 * u[4] if shape[0] == 1 else 0.9 + 0.2 * u[4])
        row = {
            "flip": u[0] < 0.5, "brightness": some(0.8, u[1] / 2 - 0.25), "contrast": some(0.8, u[2] / 2 - 0.25), "blur_sigma": some(0.5, 0.1 + 0.9 * u[3]) if shape[0] > 1 else None, "rotation": some(0.5, 20 * u[5] - 10),
            "scale": scale, "scale_top": some(0.9, u[6]), "scale_left": some(0.9, u[7]), "cutout_top": some(0.5, u[8]), "cutout_left": some(0.8, u[0]),
        }
        rows.append(tuple(row[p] for p in N.PARAMETERS))
    for order in N.ORDERS:
        for frame, row, got in zip(frames, rows, stacks.augmented(frames, rows, order, 0.15), strict=True):
            for step in N.compiled(row, order, 0.15):
                frame = step(frame)
            assert got.tobytes() == np.ascontiguousarray(frame).tobytes() and got.shape == frame.shape


def test_frames_of_a_batch_are_handed_over_together(spark):
    """Not a batch a frame, and no more bytes at once than MOST; every column goes along."""
    frames = spark.range(3000).select("id", *(F.when(F.col("id") >= 0, v).alias(n) for n, v in (("height", 8), ("width", 8), ("channels", 3))), F.when(F.col("id") % 100 != 7, F.unhex(F.repeat(F.sha2(F.col("id").cast("string"), 256), 6))).alias("pixels"))
    got = N.augmented_frames(frames.coalesce(1)).collect()
    assert [r.id for r in got] == list(range(3000)) and all((r.pixels is None) == (r.id % 100 == 7) for r in got)
    run = _function_of(lambda df: N.augmented_frames(df))
    batch = pa.RecordBatch.from_pydict({"height": [8] * 9000, "width": [8] * 9000, "channels": [3] * 9000, "pixels": [bytes(192)] * 9000})
    calls = [b.num_rows for b in run([batch])]
    assert sum(calls) == 9000 and 1 < len(calls) < 5


def _function_of(operator):
    """The function that an operator hands to mapInArrow."""

    class Frames:
        columns, schema = ["height", "width", "channels", "pixels"], None

        def mapInArrow(self, run, schema):
            return run

    return operator(Frames())
