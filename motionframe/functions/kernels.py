"""Pixel kernels on frames of height x width x channels, and the UDF boundary around them.

A frame is a row with height, width, channels and pixels (bytes, row by row).
Kernels are NumPy functions of one frame; codecs and networks stay outside, as
functions that a caller brings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes of frames that are handed over at once.
MOST = 1 << 20
#: Weights of red, green and blue in luma.
LUMA = (0.299, 0.587, 0.114)


def framed(pixels, height: int | None, width: int | None, channels: int | None) -> np.ndarray | None:
    """A frame from an Arrow value or bytes, without a copy; None if they don't fit the shape."""
    raw = pixels.as_buffer() if isinstance(pixels, pa.Scalar) else pixels
    shape = (height, width, channels)
    if raw is None or None in shape or min(shape) <= 0 or len(memoryview(raw)) != int(np.prod(shape)):
        return None
    return np.frombuffer(raw, np.uint8).reshape(shape)


def grayscale(frame: np.ndarray) -> np.ndarray:
    """Luma in all three channels; halves round up."""
    luma = np.floor(frame[..., :3].astype(np.float64) @ np.array(LUMA) + 0.5).clip(0, 255).astype(np.uint8)
    return np.repeat(luma[..., None], 3, axis=-1)


def flip(frame: np.ndarray) -> np.ndarray:
    return frame[:, ::-1]


def brightness_contrast(frame: np.ndarray, brightness: float, contrast: float) -> np.ndarray:
    """Changes around 0, as the plans draw them: contrast about the middle, then brightness; cut to whole values."""
    x = frame.astype(np.float32)
    return ((1 + contrast) * (x - 128) + 128 + brightness * 255).clip(0, 255).astype(np.uint8)


def gaussian_weights(sigma: float) -> np.ndarray:
    side = max(int(2 * round(3 * sigma) + 1), 3)
    x = np.arange(side) - side // 2
    w = np.exp(-(x**2) / (2 * sigma**2))
    return w / w.sum()


def blur(frame: np.ndarray, sigma: float) -> np.ndarray:
    """Separable Gaussian; the border mirrors without repeating the edge."""
    w = gaussian_weights(sigma)
    half = len(w) // 2
    out = frame.astype(np.float64)
    for axis in (0, 1):
        pad = [(0, 0)] * out.ndim
        pad[axis] = (half, half)
        wide = np.pad(out, pad, mode="reflect")
        out = sum(w[k] * np.take(wide, range(k, k + frame.shape[axis]), axis=axis) for k in range(len(w)))
    return np.floor(out + 0.5).clip(0, 255).astype(np.uint8)


def cutout(frame: np.ndarray, top: float, left: float, ratio: float) -> np.ndarray:
    """A grey rectangle, whose sides take the root of ratio of the frame's; top and left are shares of the room that it leaves."""
    h, w = frame.shape[:2]
    dy, dx = int(h * ratio**0.5), int(w * ratio**0.5)
    y, x = int(top * (h - dy)), int(left * (w - dx))
    out = frame.copy()
    out[y : y + dy, x : x + dx] = 128
    return out


Warp = Callable[[np.ndarray, float], np.ndarray]


def augmented(frame: np.ndarray, row: dict, ratio: float, rotate: Warp | None = None, rescale: Warp | None = None) -> np.ndarray:
    """The frame after the kinds that a row of parameters applies, in their fixed order; grey is always applied, null parameters aren't.

    Rotation and scaling are a caller's functions of a frame and the parameter;
    a row that asks for one that isn't given is an error.
    """
    out = grayscale(frame)
    if row["flip"]:
        out = flip(out)
    if row["brightness"] or row["contrast"]:
        out = brightness_contrast(out, row["brightness"] or 0.0, row["contrast"] or 0.0)
    if row["blur_sigma"] is not None:
        out = blur(out, row["blur_sigma"])
    for name, warp in (("rotation", rotate), ("scale", rescale)):
        if row[name] is not None:
            if warp is None:
                raise ValueError(f"no function for {name}")
            out = warp(out, row[name])
    return out if row["cutout_top"] is None else cutout(out, row["cutout_top"], row["cutout_left"], ratio)


def resized(frame: np.ndarray, height: int, width: int, axis_of_rows: int = 0) -> np.ndarray:
    """Bilinear, with the centres of pixels at halves and the edge repeated; in double precision, so libraries of fixed-point weights may differ by 1."""
    out = frame.astype(np.float64)
    for axis, size in ((axis_of_rows, height), (axis_of_rows + 1, width)):
        have = out.shape[axis]
        at = ((np.arange(size) + 0.5) * have / size - 0.5).clip(0, have - 1)
        low = np.floor(at).astype(int)
        part = (at - low).reshape([-1 if k == axis else 1 for k in range(out.ndim)])
        out = np.take(out, low, axis) * (1 - part) + np.take(out, np.minimum(low + 1, have - 1), axis) * part
    return np.floor(out + 0.5).clip(0, 255).astype(np.uint8)


def padded_crop(frame: np.ndarray, x1: int, y1: int, x2: int, y2: int) -> np.ndarray:
    """The crop, black where it lies outside the frame."""
    h, w = frame.shape[:2]
    out = np.zeros((max(y2 - y1, 0), max(x2 - x1, 0), *frame.shape[2:]), frame.dtype)
    a, b, c, d = max(x1, 0), max(y1, 0), min(x2, w), min(y2, h)
    if a < c and b < d:
        out[b - y1 : d - y1, a - x1 : c - x1] = frame[b:d, a:c]
    return out


def mirrored(at: np.ndarray, n: int) -> np.ndarray:
    """Places beyond an edge, mirrored without repeating it."""
    if n == 1:
        return np.zeros_like(at)
    at = np.abs(at) % (2 * n - 2)
    return np.where(at < n, at, 2 * n - 2 - at)


def sampled(frame: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The frame at places between pixels, bilinear in double precision, mirrored beyond its edges; halves round up."""
    h, w = frame.shape[:2]
    top, left = np.floor(y).astype(np.int64), np.floor(x).astype(np.int64)
    dy, dx = (v.reshape(*v.shape, *[1] * (frame.ndim - 2)) for v in (y - top, x - left))
    at = lambda r, c: frame[mirrored(r, h), mirrored(c, w)].astype(np.float64)
    out = (at(top, left) * (1 - dx) + at(top, left + 1) * dx) * (1 - dy) + (at(top + 1, left) * (1 - dx) + at(top + 1, left + 1) * dx) * dy
    return np.floor(out + 0.5).clip(0, 255).astype(np.uint8)


def rotated(frame: np.ndarray, degrees: float) -> np.ndarray:
    """Turned about the middle against the clock; each pixel is looked up where it comes from.  Libraries with weights of fixed point may differ by 1 or 2."""
    h, w = frame.shape[:2]
    a, b = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
    y, x = np.mgrid[:h, :w].astype(np.float64)
    y, x = y - h / 2, x - w / 2
    return sampled(frame, b * x + a * y + h / 2, a * x - b * y + w / 2)


def scale_room(height: int, width: int, scale: float) -> tuple[int, int]:
    """How far a crop of the frame's size may be moved in the scaled frame; a frame that isn't higher has none in either way."""
    more = int(height * scale) - height
    return (more, int(width * scale) - width) if more > 0 else (0, 0)


def scaled_crop(frame: np.ndarray, scale: float, top: int = 0, left: int = 0) -> np.ndarray:
    """Scaled, then cut to its size from (top, left), or brought back to it if it has become smaller."""
    h, w = frame.shape[:2]
    new_h, new_w = int(h * scale), int(w * scale)
    if new_h <= 0 or new_w <= 0:
        raise ValueError(f"nothing is left of {h} x {w} at {scale}")
    big = resized(frame, new_h, new_w)
    return big[top : top + h, left : left + w] if new_h >= h and new_w >= w else resized(big, h, w)


def placed(share: float, room: int) -> int:
    """A place from 0 up to room from a share below 1, each as likely."""
    return min(int(share * (room + 1)), room)


#: In which order the kinds are applied when versions are made, and when a network is trained.
ORDERS = {"offline": ("flip", "brightness_contrast", "blur", "rotation", "scale", "cutout"), "runtime": ("flip", "brightness_contrast", "scale", "blur", "rotation", "cutout")}
#: The parameters of a kind; a kind is applied if its first isn't null.
OF_KIND = {"flip": ("flip",), "brightness_contrast": ("brightness", "contrast"), "blur": ("blur_sigma",), "rotation": ("rotation",), "scale": ("scale", "scale_top", "scale_left"), "cutout": ("cutout_top", "cutout_left")}
PARAMETERS = tuple(p for ps in OF_KIND.values() for p in ps)


def compiled(row: tuple, order: str, ratio: float) -> list[Callable[[np.ndarray], np.ndarray]]:
    """The kernels that a row of PARAMETERS applies, in the order of that name, after grey.

    When training, places are drawn over whole pixels, edges included; when
    versions are made, they are cut from shares.  A scaled frame's place is
    a share of the room (0 where it isn't given).
    """
    p = dict(zip(PARAMETERS, row, strict=True))

    def scaled(frame: np.ndarray) -> np.ndarray:
        room = scale_room(*frame.shape[:2], p["scale"])
        return scaled_crop(frame, p["scale"], *(placed(p[k] or 0.0, max(r, 0)) for k, r in zip(("scale_top", "scale_left"), room, strict=True)))

    def cut(frame: np.ndarray) -> np.ndarray:
        if order == "offline":
            return cutout(frame, p["cutout_top"], p["cutout_left"] or 0.0, ratio)
        (h, w), out = frame.shape[:2], frame.copy()
        dy, dx = int(h * ratio**0.5), int(w * ratio**0.5)
        y, x = placed(p["cutout_top"], h - dy), placed(p["cutout_left"] or 0.0, w - dx)
        out[y : y + dy, x : x + dx] = 128
        return out

    steps = {
        "flip": flip, "brightness_contrast": lambda f: brightness_contrast(f, p["brightness"] or 0.0, p["contrast"] or 0.0), "blur": lambda f: blur(f, p["blur_sigma"]),
        "rotation": lambda f: rotated(f, p["rotation"]), "scale": scaled, "cutout": cut,
    }
    on = {k: any(p[x] for x in OF_KIND[k]) if k in ("flip", "brightness_contrast") else p[OF_KIND[k][0]] is not None for k in steps}
    return [grayscale, *(steps[k] for k in ORDERS[order] if on[k])]


def augmented_frames(frames: DataFrame, order: str = "offline", ratio: float = 0.15) -> DataFrame:
    """frames(height, width, channels, pixels and PARAMETERS, null ones or none at all) after the kernels of their parameters.

    Frames of a clip carry the same parameters, so all have the same draws.
    Rows are handled MOST bytes of pixels at a time, one row at least.  A null
    frame, or one whose bytes don't fit its shape, is null.
    """
    from . import stacks

    names, there = frames.columns, [p for p in PARAMETERS if p in frames.columns]
    if order not in ORDERS:
        raise ValueError(f"no order {order}")

    def made(pixels: pa.Array, shapes: list[tuple], rows: list[tuple]) -> list[tuple]:
        """(pixels, height, width, channels) of each row; frames of one shape are stacked."""
        framed_ = [framed(v, *shape) for v, shape in zip(pixels, shapes, strict=True)]
        out: list[tuple] = [(None,) * 4] * len(rows)
        for shape, which in stacks.by([None if f is None else f.shape for f in framed_]).items():
            if shape is None:
                continue
            together = max(1, stacks.STACK // (shape[0] * shape[1] * 3))
            for at in range(0, len(which), together):
                part = which[at : at + together]
                new = stacks.augmented(np.stack([framed_[k] for k in part]), [rows[k] for k in part], order, ratio)
                for k, frame in zip(part, new, strict=True):
                    out[k] = (frame.tobytes(), *frame.shape)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(pc.fill_null(pc.binary_length(batch.column("pixels")), 0).to_numpy(zero_copy_only=False), np.int64)
            before, at = np.append(0, np.cumsum(size)), 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(before, before[at] + MOST, "right")) - 1)
                one = batch.slice(at, to - at)
                rows = list(zip(*(one.column(p).to_pylist() if p in there else [None] * one.num_rows for p in PARAMETERS), strict=True))
                shapes = list(zip(*(one.column(n).to_pylist() for n in ("height", "width", "channels")), strict=True))
                new = zip(*made(one.column("pixels"), shapes, rows), strict=True)
                arrays = {n: pa.array(v, one.schema.field(n).type) for n, v in zip(("pixels", "height", "width", "channels"), new, strict=True)}
                yield pa.RecordBatch.from_arrays([arrays.get(n, one.column(n)) for n in names], schema=one.schema)
                at = to

    return frames.mapInArrow(run, frames.schema)


# Mean and deviation of the channels that image models were trained with.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_SD = (0.229, 0.224, 0.225)


def normalised(frames: np.ndarray) -> np.ndarray:
    """(T, H, W, C) bytes as (T, C, H, W) floats around 0."""
    x = (frames.astype(np.float32) / 255 - np.array(CHANNEL_MEAN, np.float32)) / np.array(CHANNEL_SD, np.float32)
    return x.transpose(0, 3, 1, 2)


def item(frames: list[np.ndarray] | None, length: int = 16, side: int = 224) -> np.ndarray:
    """(T, C, H, W) for a network: frames resized and normalised; zeros for a clip that couldn't be read."""
    if not frames:
        return np.zeros((length, 3, side, side), np.float32)
    return normalised(np.stack([resized(f, side, side) for f in frames]))


def on_frames(frames: DataFrame, kernel: Callable[..., np.ndarray], *arguments: str) -> DataFrame:
    """frames with the kernel applied to every frame; arguments name columns that hold its parameters.

    A null frame, or one whose bytes don't fit its shape, stays null: it is the
    reader's to fail, not the kernel's.
    """
    names = frames.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
            shapes, pixels = zip(*(at[n].to_pylist() for n in ("height", "width", "channels")), strict=True), at["pixels"].to_pylist()
            values = zip(*(at[a].to_pylist() for a in arguments), strict=True) if arguments else [()] * batch.num_rows
            out, new_shapes = [], []
            for shape, raw, args in zip(shapes, pixels, values, strict=True):
                ok = raw is not None and None not in shape and len(raw) == int(np.prod(shape))
                made = np.ascontiguousarray(kernel(np.frombuffer(raw, np.uint8).reshape(shape), *args)) if ok else None
                out.append(made.tobytes() if ok else None)
                new_shapes.append(made.shape if ok else (None, None, None))
            new = dict(at) | {"pixels": pa.array(out, pa.binary())} | {n: pa.array([s[k] for s in new_shapes], pa.int32()) for k, n in enumerate(("height", "width", "channels"))}
            yield pa.RecordBatch.from_arrays([new[n] for n in names], names)

    return frames.mapInArrow(run, frames.schema)
