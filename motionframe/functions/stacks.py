"""Kernels on stacks of frames of one shape, each with its own parameters: byte for byte what kernels.compiled() makes of each.

A stack is frames x height x width x channels.  What depends on a parameter's
whole value (the size of a scaled frame, the side of a blur) is done for the
frames that share it.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Sequence

import numpy as np

from .kernels import OF_KIND, ORDERS, PARAMETERS, gaussian_weights, grayscale, mirrored, placed, resized, scale_room

#: Bytes of grey frames that are handled at once; sums in double precision take some fifty times as much.
STACK = 1 << 18


def each(values: Sequence[float], dtype: type = np.float64) -> np.ndarray:
    """A value a frame, to be met by its pixels."""
    return np.array(values, dtype).reshape(-1, 1, 1, 1)


def by(keys: list[Hashable]) -> dict[Hashable, list[int]]:
    """The places of each key."""
    out: dict[Hashable, list[int]] = {}
    for k, key in enumerate(keys):
        out.setdefault(key, []).append(k)
    return out


def brightness_contrast(x: np.ndarray, brightness: list[float], contrast: list[float]) -> np.ndarray:
    gain, more = each([1 + c for c in contrast], np.float32), each([b * 255 for b in brightness], np.float32)
    return (gain * (x.astype(np.float32) - 128) + 128 + more).clip(0, 255).astype(np.uint8)


def blur(x: np.ndarray, sigmas: list[float]) -> np.ndarray:
    weights, out = [gaussian_weights(s) for s in sigmas], np.empty_like(x)
    for side, which in by([len(w) for w in weights]).items():
        w, part, half = np.stack([weights[k] for k in which]), x[which].astype(np.float64), side // 2
        for axis in (1, 2):
            pad = [(half, half) if a == axis else (0, 0) for a in range(4)]
            wide = np.pad(part, pad, mode="reflect")
            part = sum(each(w[:, k]) * np.take(wide, range(k, k + x.shape[axis]), axis=axis) for k in range(side))
        out[which] = np.floor(part + 0.5).clip(0, 255).astype(np.uint8)
    return out


def rotated(x: np.ndarray, degrees: list[float]) -> np.ndarray:
    h, w = x.shape[1:3]
    a, b = (each([f(np.radians(d)) for d in degrees])[..., 0] for f in (np.cos, np.sin))
    row, column = np.mgrid[:h, :w].astype(np.float64)
    row, column = row - h / 2, column - w / 2
    y, z = b * column + a * row + h / 2, a * column - b * row + w / 2
    top, left = np.floor(y).astype(np.int64), np.floor(z).astype(np.int64)
    dy, dx = (y - top)[..., None], (z - left)[..., None]
    one = np.arange(len(x))[:, None, None]
    at = lambda r, c: x[one, mirrored(r, h), mirrored(c, w)].astype(np.float64)
    out = (at(top, left) * (1 - dx) + at(top, left + 1) * dx) * (1 - dy) + (at(top + 1, left) * (1 - dx) + at(top + 1, left + 1) * dx) * dy
    return np.floor(out + 0.5).clip(0, 255).astype(np.uint8)


def scaled(x: np.ndarray, scales: list[float], tops: list[float], lefts: list[float]) -> np.ndarray:
    (h, w), out = x.shape[1:3], np.empty_like(x)
    for (high, wide), which in by([(int(h * s), int(w * s)) for s in scales]).items():
        if high <= 0 or wide <= 0:
            raise ValueError(f"nothing is left of {h} x {w} at {scales[which[0]]}")
        big = resized(x[which], high, wide, 1)
        if high < h or wide < w:
            out[which] = resized(big, h, w, 1)
            continue
        for frame, k in zip(big, which, strict=True):
            top, left = (placed(share, max(room, 0)) for share, room in zip((tops[k], lefts[k]), scale_room(h, w, scales[k]), strict=True))
            out[k] = frame[top : top + h, left : left + w]
    return out


def cut_out(x: np.ndarray, tops: list[float], lefts: list[float], order: str, ratio: float) -> np.ndarray:
    (h, w), out = x.shape[1:3], x.copy()
    dy, dx = int(h * ratio**0.5), int(w * ratio**0.5)
    at = (lambda share, room: int(share * room)) if order == "offline" else placed
    for frame, top, left in zip(out, tops, lefts, strict=True):
        y, z = at(top, h - dy), at(left, w - dx)
        frame[y : y + dy, z : z + dx] = 128
    return out


def augmented(x: np.ndarray, rows: list[tuple], order: str, ratio: float) -> np.ndarray:
    """The stack after grey and the kinds that the row of PARAMETERS of each frame applies, in the order of that name."""
    at = {p: k for k, p in enumerate(PARAMETERS)}
    steps: dict[str, Callable[..., np.ndarray]] = {
        "flip": lambda part, p: part[:, :, ::-1], "brightness_contrast": lambda part, p: brightness_contrast(part, p("brightness"), p("contrast")), "blur": lambda part, p: blur(part, p("blur_sigma")),
        "rotation": lambda part, p: rotated(part, p("rotation")), "scale": lambda part, p: scaled(part, p("scale"), p("scale_top"), p("scale_left")),
        "cutout": lambda part, p: cut_out(part, p("cutout_top"), p("cutout_left"), order, ratio),
    }
    out = grayscale(x)
    for kind in ORDERS[order]:
        if kind in ("flip", "brightness_contrast"):
            on = [k for k, row in enumerate(rows) if any(row[at[p]] for p in OF_KIND[kind])]
        else:
            on = [k for k, row in enumerate(rows) if row[at[OF_KIND[kind][0]]] is not None]
        if on:
            out[on] = steps[kind](out[on], lambda p: [rows[k][at[p]] or 0.0 for k in on])  # noqa: B023
    return out
