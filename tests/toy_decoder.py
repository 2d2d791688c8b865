"""A decoder for tests: a frame has one detection, whose place is the frame's number."""

from motionframe.sources.containers import properties
from motionframe.sources.remote import Ranges


def decode(path, first, last):
    with Ranges(path) as file:
        n = properties(file, file.size).frames
    for k in range(first, n if last is None else last):
        yield {"video_id": path.rsplit("/", 1)[-1], "track_id": 1, "frame_idx": k, "left_ankle": {"x": float(k), "y": 5.0}, "right_ankle": None, "confidence": 0.5, "bbox_height": 100.0, "det_seq": 0}
