"""Frame rate, frame count and size of videos in ISO containers, from their headers alone.

Boxes are walked by ranged reads: media data is skipped, and of the sample
tables only counts and durations are read.  Fragmented files keep these with
their fragments, which are walked likewise.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .remote import Ranges

Read = Callable[[int, int], bytes]
#: Frames a second of a video that doesn't say.
USUAL_FPS = 30.0
#: Bytes of a table read at once.
PIECE = 1 << 16
PROPERTIES = "path string, fps double, frames bigint, width int, height int, error string"


class Video(NamedTuple):
    fps: float
    frames: int
    width: int
    height: int


class Box(NamedTuple):
    kind: bytes
    start: int
    end: int


def boxes(read: Read, start: int, end: int) -> Iterator[Box]:
    """The boxes of a range, by what they hold; one that reaches beyond the range is an error."""
    at = start
    while at + 8 <= end:
        size, kind = struct.unpack(">I4s", read(at, 8))
        body = at + 8
        if size == 1:
            size, body = struct.unpack(">Q", read(body, 8))[0], body + 8
        elif size == 0:
            size = end - at
        if at + size > end or at + size < body:
            raise ValueError(f"box {kind!r} at {at} reaches beyond its place")
        yield Box(kind, body, at + size)
        at += size


def _inside(read: Read, box: Box, *kinds: bytes) -> Box | None:
    """The first box of a path of kinds below a box."""
    for kind in kinds:
        box = next((b for b in boxes(read, box.start, box.end) if b.kind == kind), None)
        if box is None:
            return None
    return box


def _numbers(read: Read, box: Box, at: int, code: str) -> tuple:
    size = struct.calcsize(code)
    if box.start + at + size > box.end:
        raise ValueError(f"box {box.kind!r} is too short")
    return struct.unpack(code, read(box.start + at, size))


def _runs(read: Read, box: Box) -> tuple[int, int]:
    """Samples and their whole duration, of a table of runs."""
    (n,) = _numbers(read, box, 4, ">I")
    if box.start + 8 + 8 * n > box.end:
        raise ValueError("the table of durations is too short")
    count = length = 0
    for at in range(0, 8 * n, PIECE):
        piece = read(box.start + 8 + at, min(PIECE, 8 * n - at))
        for k, each in struct.iter_unpack(">II", piece):
            count, length = count + k, length + k * each
    return count, length


def _fragment(read: Read, moof: Box, track: int, usual: int) -> tuple[int, int]:
    """Samples of a track in a fragment, and their duration."""
    count = length = 0
    for traf in (b for b in boxes(read, moof.start, moof.end) if b.kind == b"traf"):
        head = _inside(read, traf, b"tfhd")
        if head is None:
            continue
        flags, whose = _numbers(read, head, 0, ">II")
        if whose != track:
            continue
        each, at = usual, 8 + 8 * bool(flags & 1) + 4 * bool(flags & 2)
        if flags & 8:
            (each,) = _numbers(read, head, at, ">I")
        for run in (b for b in boxes(read, traf.start, traf.end) if b.kind == b"trun"):
            flags, n = _numbers(read, run, 0, ">II")
            count += n
            if not flags & 0x100:
                length += n * each
                continue
            step = 4 * sum(bool(flags & f) for f in (0x100, 0x200, 0x400, 0x800))
            first = 8 + 4 * bool(flags & 1) + 4 * bool(flags & 4)
            if run.start + first + n * step > run.end:
                raise ValueError("a run of samples is too short")
            rows = max(1, PIECE // step)
            for k in range(0, n, rows):
                piece = read(run.start + first + k * step, min(rows, n - k) * step)
                length += sum(struct.unpack_from(">I", piece, j)[0] for j in range(0, len(piece), step))
    return count, length


def _track(read: Read, trak: Box, moov: Box, fragments: list[Box]) -> Video | None:
    kind = _inside(read, trak, b"mdia", b"hdlr")
    if kind is None or read(kind.start + 8, 4) != b"vide":
        return None
    head, place = _inside(read, trak, b"mdia", b"mdhd"), _inside(read, trak, b"tkhd")
    table = _inside(read, trak, b"mdia", b"minf", b"stbl")
    entry = table and _inside(read, table, b"stsd")
    if head is None or place is None or entry is None:
        raise ValueError("a video track lacks its headers")
    long = read(head.start, 1) == b"\x01"
    (scale,) = _numbers(read, head, 20 if long else 12, ">I")
    durations, sizes = _inside(read, table, b"stts"), _inside(read, table, b"stsz")
    frames, length = _runs(read, durations) if durations else (0, 0)
    if sizes is not None:
        frames = max(frames, _numbers(read, sizes, 8, ">I")[0])
    long = read(place.start, 1) == b"\x01"
    (track,) = _numbers(read, place, 20 if long else 12, ">I")
    usual = 0
    more = _inside(read, moov, b"mvex")
    for box in boxes(read, more.start, more.end) if more else ():
        if box.kind == b"trex" and _numbers(read, box, 4, ">I")[0] == track:
            (usual,) = _numbers(read, box, 12, ">I")
    for moof in fragments:
        k, n = _fragment(read, moof, track, usual)
        frames, length = frames + k, length + n
    first = next(boxes(read, entry.start + 8, entry.end), None)
    if first is None:
        raise ValueError("no sample entry")
    width, height = _numbers(read, first, 24, ">HH")
    a, b, _, c, d = _numbers(read, place, 52 if long else 40, ">iiiii")
    if a == d == 0 and b and c:  # shown on its side
        width, height = height, width
    return Video(frames * scale / length if length else 0.0, frames, width, height)


def properties(read: Read, size: int) -> Video:
    """The first video track's properties; a file that isn't such a container, or has no video, is an error.

    The rate is that of all frames over their duration, 0 where there is none.
    A track that is shown turned by a quarter has width and height exchanged.
    """
    top = list(boxes(read, 0, size))
    moov = next((b for b in top if b.kind == b"moov"), None)
    if moov is None:
        raise ValueError("no movie header")
    fragments = [b for b in top if b.kind == b"moof"]
    for trak in (b for b in boxes(read, moov.start, moov.end) if b.kind == b"trak"):
        found = _track(read, trak, moov, fragments)
        if found is not None:
            return found
    raise ValueError("no video track")


def video_properties(paths: DataFrame, strict: bool = True) -> DataFrame:
    """(path, fps, frames, width, height, error) of the videos of paths(path).

    A video that can't be read is an error, or, if not strict, a row with its
    text and nothing else.  A null path is such a row.  Only headers are read,
    from wherever the file lies; no video passes through Spark.
    """

    def one(path: str | None) -> tuple:
        try:
            if path is None:
                raise ValueError("no path")
            with Ranges(path) as file:
                return path, *properties(file, file.size), None
        except (OSError, ValueError, struct.error) as e:
            if strict:
                raise RuntimeError(f"{path} can't be read: {e}") from e
            return path, None, None, None, None, str(e) or type(e).__name__

    kinds = (pa.string(), pa.float64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
    names = [f.split()[0] for f in PROPERTIES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = zip(*(one(p) for p in batch.column(0).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return paths.select("path").mapInArrow(run, PROPERTIES)


def whole_fps(fps: Column) -> Column:
    """Frames a second as clips are cut by: cut to a whole number."""
    return fps.cast("int")


def usual_fps(fps: Column) -> Column:
    """Frames a second as videos are written with: the usual rate where there is none."""
    return F.when(fps != 0, fps).otherwise(F.lit(USUAL_FPS))
