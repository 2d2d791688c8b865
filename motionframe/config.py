"""Settings, as frozen dataclasses that plans read as literals."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FrameSize:
    width: int = 1920
    height: int = 1080


@dataclass(frozen=True)
class TrackConfig:
    """How tracks are filtered, cropped and cut into clips."""

    min_track_frames: int = 20
    min_speed_ratio: float = 0.5
    top_n: int = 0
    min_ankle_variance: float = 0.0
    roi_height_ratio: float = 0.40
    min_roi: int = 128
    foot_length_ratio: float = 0.15
    side_offset_ratio: float = 0.1
    ankle_vertical_ratio: float = 0.35
    max_padding_ratio: float = 0.25
    window: int = 5
    height_window: int = 15
    clip_length: int = 16
    clip_stride: int = 16
    frame: FrameSize = field(default_factory=FrameSize)


@dataclass(frozen=True)
class CropConfig:
    """A crop of fixed output size around the feet."""

    width: int = 400
    height: int = 300
    feet_ratio: float = 0.25
    padding: float = 1.5
    alpha: float = 0.15
    frame: FrameSize = field(default_factory=FrameSize)


@dataclass(frozen=True)
class SplitConfig:
    train: float = 0.70
    val: float = 0.15
    seed: int = 42
    remap: dict[int, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not (0 <= self.train and 0 <= self.val and self.train + self.val <= 1.001):
            raise ValueError("ratios must be non-negative and total 1 at most")


# Probabilities of the kinds of augmentation, and ranges of their parameters.
STANDARD = {"flip": 0.7, "brightness_contrast": 0.8, "blur": 0.6, "rotation": 0.8, "scale": 0.6, "cutout": 0.6}
RANGES = {"brightness": (-0.25, 0.25), "contrast": (-0.25, 0.25), "blur_sigma": (0.1, 1.0), "rotation": (-5.0, 5.0), "scale": (0.9, 1.1)}
CUTOUT_RATIO = 0.15
VERSIONS = 25


@dataclass(frozen=True)
class AugmentConfig:
    versions: int = VERSIONS
    probability: dict[str, float] = field(default_factory=lambda: dict(STANDARD))
    ranges: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(RANGES))
    cutout_ratio: float = CUTOUT_RATIO


@dataclass(frozen=True)
class RuntimeConfig:
    """What is drawn for each clip while a network is trained."""

    flip: float = 0.5
    brightness: float = 0.25
    contrast: float = 0.25
    scale: tuple[float, float] = (0.9, 1.1)
    blur: float = 0.3
    blur_sigma: tuple[float, float] = (0.1, 1.0)
    rotation: float = 0.3
    degrees: float = 5.0
    cutout: float = 0.3
    cutout_ratio: float = CUTOUT_RATIO


def selective(kinds: list[str], versions: int = VERSIONS) -> AugmentConfig:
    """Only the named kinds, at their standard probability; names are matched without case, unknown ones warned of."""
    import warnings

    wanted = {k.lower() for k in kinds}
    if unknown := wanted - STANDARD.keys():
        warnings.warn(f"unknown augmentations: {sorted(unknown)}", stacklevel=2)
    return AugmentConfig(versions, {k: p if k in wanted else 0.0 for k, p in STANDARD.items()})


# The named combinations, by the kinds that they enable.  Short names: bc is brightness_contrast.
PRESET_NAMES = [
    "baseline",
    "flip_only", "bc_only", "blur_only", "rotation_only", "scale_only", "cutout_only",
    "flip_bc", "flip_blur", "flip_rotation", "flip_scale", "flip_cutout", "bc_blur", "bc_rotation", "bc_scale", "bc_cutout", "blur_rotation", "rotation_scale", "rotation_cutout",
    "flip_bc_blur", "flip_bc_rotation", "flip_bc_cutout", "flip_rotation_scale", "flip_blur_cutout", "bc_blur_rotation", "bc_blur_cutout", "bc_rotation_scale", "blur_rotation_scale", "rotation_scale_cutout",
    "all_augmentations",
]


def preset_kinds(name: str) -> list[str]:
    """The kinds that a preset's name lists."""
    if name == "baseline":
        return []
    if name == "all_augmentations":
        return list(STANDARD)
    return ["brightness_contrast" if part == "bc" else part for part in name.removesuffix("_only").split("_")]


def preset_config(name: str, versions: int = VERSIONS) -> AugmentConfig:
    """A preset's settings; without any kind, all versions would be equal, so there is one."""
    kinds = preset_kinds(name)
    return selective(kinds, versions if kinds else 1)
