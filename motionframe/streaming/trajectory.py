"""The centre of each track, carried over frames without a detection, as a stream of detections comes in.

Each track has a state of its own: the last centre that was seen, the mean that
frames without one move, and the last frame.  It goes on from micro-batch to
micro-batch and from one run to the next, so the result is that of the whole
table, however it is cut.  A track's frames must come in order over batches;
within a batch they may come in any.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import CropConfig
from ..operators.tracks import KEY, centre, running_mean

STATE = "cx double, cy double, sx double, sy double, frame_idx bigint, det_seq bigint"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Carry(StatefulProcessor):
    def __init__(self, c: CropConfig):
        self.alpha, self.none = c.alpha, (c.frame.width / 2, 0.85 * c.frame.height)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("track", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        rows = [r for r in rows if len(r)]
        if not rows:
            return
        frames = pd.concat(rows, ignore_index=True).sort_values(["frame_idx", "det_seq"], kind="stable", ignore_index=True)
        old = self.kept.get() if self.kept.exists() else (None,) * 6
        first, last = (tuple(int(v) for v in frames[["frame_idx", "det_seq"]].iloc[k]) for k in (0, -1))
        if old[4] is not None and first < (old[4], old[5]):
            raise ValueError(f"frame {first[0]} of track {key} comes after frame {old[4]}")
        seen = frames["cx"].notna().to_numpy()
        out, state = {"video_id": key[0], "track_id": key[1], "frame_idx": frames["frame_idx"], "det_seq": frames["det_seq"], "seen": seen}, []
        at = np.maximum.accumulate(np.where(seen, np.arange(len(seen)), -1))
        for axis, (name, none) in enumerate(zip(("cx", "cy"), self.none, strict=True)):
            values = frames[name].to_numpy(np.float64)
            carried = np.where(at >= 0, values[np.maximum(at, 0)], none if old[axis] is None else old[axis])
            mean = np.full(len(seen), np.nan)
            mean[~seen] = running_mean(carried[~seen], self.alpha, old[2 + axis])
            out |= {name: carried, f"s{name[1]}": mean}
            state.append((float(values[at[-1]]) if at[-1] >= 0 else old[axis], float(mean[~seen][-1]) if (~seen).any() else old[2 + axis]))
        self.kept.update((state[0][0], state[1][0], state[0][1], state[1][1], *last))
        yield pd.DataFrame(out)[[*KEY, "frame_idx", "det_seq", "seen", "cx", "cy", "sx", "sy"]]

    def close(self) -> None:
        pass


def stateful(spark: SparkSession) -> None:
    """Sets the state store that keyed state needs; it keeps on disk what doesn't fit in memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def carried(detections: DataFrame, c: CropConfig) -> DataFrame:
    """(video_id, track_id, frame_idx, det_seq, seen, cx, cy, sx, sy) of a stream of detections.

    cx, cy are the centre, else the last one, else the bottom centre of the
    frame; sx, sy the exponential mean of those of frames without a centre, null
    in other frames.  A frame that is older than what its track has had is an
    error: its place in the mean is past.  Works on tables too, as one batch.
    """
    rows = detections.select(*KEY, detections["frame_idx"].cast("bigint").alias("frame_idx"), detections["det_seq"].cast("bigint").alias("det_seq"), centre("x").alias("cx"), centre("y").alias("cy"))
    kinds = {f.name: f.dataType.simpleString() for f in detections.schema}
    out = ", ".join(f"{k} {kinds[k]}" for k in KEY) + ", frame_idx bigint, det_seq bigint, seen boolean, cx double, cy double, sx double, sy double"
    return rows.groupBy(*KEY).transformWithStateInPandas(Carry(c), outputStructType=out, outputMode="Append", timeMode="None")
