"""ISO media containers: byte payloads kept as 8-bit samples, and what can be told of a file from its boxes alone."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from .frames import beside, slices

#: Bytes of one stored sample: a frame of so many 8-bit PCM values.
FRAME = 64
RATE = 8000
FRAMES_A_CHUNK = 1024
#: Each so many frames, one is marked as a sync sample.
FRAMES_A_KEY = 256
# Boxes that hold boxes.
CONTAINERS = (b"moov", b"trak", b"edts", b"mdia", b"minf", b"dinf", b"stbl", b"udta", b"mvex", b"moof", b"traf")
MATRIX = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def box(kind: bytes, *body: bytes) -> bytes:
    data = b"".join(body)
    if len(data) + 8 < 1 << 32:
        return struct.pack(">I4s", len(data) + 8, kind) + data
    return struct.pack(">I4sQ", 1, kind, len(data) + 16) + data


def full(kind: bytes, *body: bytes, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", flags), *body)


def write(payload: bytes) -> bytes:
    """A file with one track of 8-bit mono PCM, whose media data are the payload.  Its size must be a multiple of FRAME."""
    frames = len(payload) // FRAME
    chunks = -(-frames // FRAMES_A_CHUNK)
    last = frames - (chunks - 1) * FRAMES_A_CHUNK
    ticks = frames * FRAME
    keys = np.arange(1, frames + 1, FRAMES_A_KEY, dtype=">u4")
    runs = [(1, FRAMES_A_CHUNK, 1)] if chunks > 1 else []
    if last != FRAMES_A_CHUNK or chunks == 1:
        runs.append((chunks, last, 1))
    large = len(payload) >= 1 << 31

    def moov(first: int) -> bytes:
        offsets = first + np.arange(chunks, dtype=np.int64) * FRAMES_A_CHUNK * FRAME
        entry = box(b"ipcm", struct.pack(">6xH8xHHHHI", 1, 1, 8, 0, 0, RATE << 16), full(b"pcmC", struct.pack(">BB", 1, 8)))
        stbl = box(
            b"stbl",
            full(b"stsd", struct.pack(">I", 1), entry),
            full(b"stts", struct.pack(">III", 1, frames, FRAME)),
            full(b"stss", struct.pack(">I", len(keys)), keys.tobytes()),
            full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            full(b"stsz", struct.pack(">II", FRAME, frames)),
            full(b"co64" if large else b"stco", struct.pack(">I", chunks), offsets.astype(">u8" if large else ">u4").tobytes()),
        )
        dinf = box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1)))
        minf = box(b"minf", full(b"smhd", bytes(4)), dinf, stbl)
        mdia = box(b"mdia", full(b"mdhd", struct.pack(">IIIIHH", 0, 0, RATE, ticks & 0xFFFFFFFF, 0x55C4, 0)), full(b"hdlr", struct.pack(">I4s12x", 0, b"soun"), b"payload\0"), minf)
        tkhd = full(b"tkhd", struct.pack(">IIIII8xHHHH", 0, 0, 1, 0, ticks & 0xFFFFFFFF, 0, 0, 0x100, 0), MATRIX, bytes(8), flags=3)
        mvhd = full(b"mvhd", struct.pack(">IIIIIH10x", 0, 0, RATE, ticks & 0xFFFFFFFF, 0x10000, 0x100), MATRIX, bytes(24), struct.pack(">I", 2))
        return box(b"moov", mvhd, box(b"trak", tkhd, mdia))

    head = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isommp42")
    data = box(b"mdat", payload)
    first = len(head) + len(moov(0)) + len(data) - len(payload)
    return head + moov(first) + data


def walk(data: memoryview, deepest: int = 16) -> list[tuple[tuple, int, int]]:
    """(path, body's start, body's end) of every box, nested ones after the box that holds them.

    What follows a box that doesn't fit is left out, and so is what lies deeper
    than `deepest` boxes.
    """
    found, open_ = [], [(0, len(data), ())]
    while open_:
        at, end, path = open_.pop()
        if at + 8 > end:
            continue
        size, kind = struct.unpack_from(">I4s", data, at)
        body = at + 8
        if size == 1 and body + 8 <= end:
            size, body = struct.unpack_from(">Q", data, body)[0], body + 8
        elif size == 0:
            size = end - at
        if size < body - at or at + size > end:
            continue
        here = (*path, kind)
        found.append((here, body, at + size))
        open_.append((at + size, end, path))
        if kind in CONTAINERS and len(here) < deepest:
            open_.append((body, at + size, here))
    return found


def _track(data: memoryview, boxes: dict[bytes, tuple[int, int]]) -> dict | None:
    """Codec, duration and the place of each sample, from one track's tables."""
    if not {b"stsd", b"stsz", b"stsc"} <= boxes.keys() or not ({b"stco", b"co64"} & boxes.keys()):
        return None
    ints = lambda at, n, kind=">u4": np.frombuffer(data, kind, n, at).astype(np.int64)
    codec = bytes(data[boxes[b"stsd"][0] + 12 : boxes[b"stsd"][0] + 16]).decode("latin-1")
    at = boxes[b"stsz"][0] + 4
    fixed, n = struct.unpack_from(">II", data, at)
    if n > len(data):
        raise ValueError("more samples than bytes")
    sizes = np.full(n, fixed, np.int64) if fixed else ints(at + 8, n)
    if sizes.sum() > len(data):
        raise ValueError("samples of more bytes than the file has")
    wide = b"co64" in boxes
    at = boxes[b"co64" if wide else b"stco"][0] + 4
    offsets = ints(at + 4, struct.unpack_from(">I", data, at)[0], ">u8" if wide else ">u4")
    at = boxes[b"stsc"][0] + 4
    runs = ints(at + 4, 3 * struct.unpack_from(">I", data, at)[0]).reshape(-1, 3)
    if runs[:, 0].max(initial=0) > len(offsets) + 1 or runs[:, 1].max(initial=0) > len(data):
        raise ValueError("chunks that aren't there")
    a_chunk = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0], len(offsets) + 1)))[: len(offsets)]
    a_chunk = np.diff(np.minimum(np.cumsum(a_chunk), n), prepend=0)
    chunk = np.repeat(np.arange(len(a_chunk)), a_chunk)
    ends = np.cumsum(sizes[: len(chunk)])
    begins = ends - sizes[: len(chunk)]
    first = np.searchsorted(chunk, chunk)
    starts = offsets[chunk] + begins - begins[first]
    scale, ticks = 0, 0
    if b"mdhd" in boxes:
        at = boxes[b"mdhd"][0]
        scale, ticks = struct.unpack_from(">IQ", data, at + 20) if data[at] == 1 else struct.unpack_from(">II", data, at + 12)
    if b"stts" in boxes:  # the table says more than a header that may have been cut to 32 bits
        at = boxes[b"stts"][0] + 4
        times = ints(at + 4, 2 * struct.unpack_from(">I", data, at)[0]).reshape(-1, 2)
        ticks = int((times[:, 0] * times[:, 1]).sum())
    keys = np.arange(len(starts))
    if b"stss" in boxes:
        at = boxes[b"stss"][0] + 4
        keys = ints(at + 4, struct.unpack_from(">I", data, at)[0]) - 1
        keys = keys[(keys >= 0) & (keys < len(starts))]
    return {"codec": codec, "timescale": scale, "ticks": ticks, "starts": starts, "sizes": sizes[: len(starts)], "keys": keys}


def read(file: bytes) -> dict | None:
    """The first track with sample tables, or None if there is none or its tables are broken, or tell of more samples or bytes than there are."""
    data = memoryview(file)
    tracks: list[dict[bytes, tuple[int, int]]] = []
    for path, begin, end in walk(data):
        if path[-1] == b"trak":
            tracks.append({})
        elif b"trak" in path and tracks:
            tracks[-1].setdefault(path[-1], (begin, end))
    for boxes in tracks:
        try:
            if track := _track(data, boxes):
                return track
        except (ValueError, struct.error, IndexError):
            continue
    return None


def payload_of(file: bytes, track: dict) -> bytes:
    """The samples' bytes in order; neighbouring samples are taken together."""
    starts, sizes = track["starts"], track["sizes"]
    if not len(starts):
        return b""
    ends = starts + sizes
    cuts = np.flatnonzero(starts[1:] != ends[:-1]) + 1
    return b"".join(file[a:b] for a, b in zip(starts[np.append(0, cuts)].tolist(), ends[np.append(cuts - 1, len(ends) - 1)].tolist(), strict=True))


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, media): each whole text's UTF-8, padded by bytes 0 to a positive multiple of FRAME, as a media file.

    A null text counts as empty; equal texts give equal files.  Other columns
    are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2 << 20):
            raw = [x or b"" for x in batch.column(1).to_pylist()]
            files = [write(x + bytes(max(FRAME, -(-len(x) // FRAME) * FRAME) - len(x))) for x in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, raw), pa.int64()), pa.array(files, pa.binary())], ["id", "n_bytes", "media"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(run, f"id {kind}, n_bytes bigint, media binary").withColumnRenamed("id", id_col)


RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def probe(files: DataFrame, media_col: str = "media", payload: bool = False) -> DataFrame:
    """All columns of files, and codec, timescale, duration_s, n_samples and keyframe_ranges of the first track.

    The ranges are those of the sync samples' bytes in the file; no payload is
    decoded.  With payload, its bytes are read back as well.  The new columns are
    null where a file is null or has no readable track; columns of these names
    that files already has are replaced.
    """
    new = {"codec": pa.string(), "timescale": pa.int64(), "duration_s": pa.float64(), "n_samples": pa.int64(), "keyframe_ranges": RANGES}
    ddl = "codec string, timescale bigint, duration_s double, n_samples bigint, keyframe_ranges array<struct<start:bigint,end:bigint>>"
    if payload:
        new, ddl = new | {"payload": pa.binary()}, ddl + ", payload binary"

    def run(stored: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        for part in stored:
            rows = []
            for file in part.to_pylist():
                track = None if file is None else read(file)
                if track is None:
                    rows.append(dict.fromkeys(new))
                    continue
                begin = track["starts"][track["keys"]]
                end = begin + track["sizes"][track["keys"]]
                rows.append({
                    "codec": track["codec"], "timescale": track["timescale"], "duration_s": track["ticks"] / track["timescale"] if track["timescale"] else None,
                    "n_samples": len(track["starts"]), "keyframe_ranges": [{"start": a, "end": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)],
                } | ({"payload": payload_of(file, track)} if payload else {}))
            yield [pa.array([r[c] for r in rows], kind) for c, kind in new.items()]

    return beside(files, media_col, _parse_datatype_string(ddl), run, most=2 << 20, instead=tuple(c for c in new if c != media_col))
