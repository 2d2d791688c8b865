"""Plans of augmented versions: what to make, with which parameters, and what is there already."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from ..config import PRESET_NAMES, STANDARD, AugmentConfig, RuntimeConfig, preset_config, preset_kinds
from ..functions.scalars import file_name, hash32, stem, uniform
from ..sources.files import parts_document
from .catalog import augmented_name, below, without_version


def versions(videos: DataFrame, n: int) -> DataFrame:
    """Every video with version 1 to n."""
    return videos.withColumn("version", F.explode(F.sequence(F.lit(1), F.lit(n))))


def seed(video: Column, version: Column) -> Column:
    return hash32(F.concat_ws("_", video, version.cast("string")))


PARAMS = ["brightness", "contrast", "blur_sigma", "rotation", "scale", "cutout_top", "cutout_left"]


def params_native(expanded: DataFrame, c: AugmentConfig, video: str = "stem") -> DataFrame:
    """expanded(video, version) with flip and PARAMS, null where a kind isn't applied; draws are hashes of video, version and slot.

    They have the distribution of params_exact, and other values.  A probability
    may be a column of expanded too.
    """
    u = lambda slot: uniform(F.col(video), F.col("version").cast("string"), F.lit(slot))
    on = {k: u(f"on:{k}") < p for k, p in c.probability.items()}
    span = lambda slot, lo, hi: F.lit(lo) + (hi - lo) * u(slot)
    of = {"brightness": "brightness_contrast", "contrast": "brightness_contrast", "blur_sigma": "blur", "rotation": "rotation", "scale": "scale"}
    out = {"flip": on["flip"]} | {p: F.when(on[k], span(p, *c.ranges[p])) for p, k in of.items()}
    out |= {"cutout_top": F.when(on["cutout"], span("cutout_top", 0.0, 0.5 - c.cutout_ratio)), "cutout_left": F.when(on["cutout"], span("cutout_left", 0.0, 1 - c.cutout_ratio))}
    return expanded.withColumns(out)


def runtime_params(clips: DataFrame, c: RuntimeConfig, key: str = "stem", epoch: int | Column = 0) -> DataFrame:
    """clips with flip, PARAMS, scale_top, scale_left and offset: what training draws for a clip in an epoch, null where a kind isn't applied.

    Brightness, contrast and scale are always drawn, unless their range is a
    point.  Draws are hashes of clip, epoch and slot, so all frames of a clip
    share them and a rerun has the same.  `offset` is the share by which
    sampled_frames() moves a clip.
    """
    e = F.lit(epoch).cast("string") if isinstance(epoch, int) else epoch.cast("string")
    u = lambda slot: uniform(F.col(key), e, F.lit(slot))
    span = lambda slot, lo, hi: F.lit(lo) + (hi - lo) * u(slot)
    none = F.lit(None).cast("double")
    either = c.brightness > 0 or c.contrast > 0
    moved = c.scale != (1.0, 1.0)
    return clips.withColumns({
        "flip": u("on:flip") < c.flip, "brightness": span("brightness", -c.brightness, c.brightness) if either else none, "contrast": span("contrast", -c.contrast, c.contrast) if either else none,
        "blur_sigma": F.when(u("on:blur") < c.blur, span("blur_sigma", *c.blur_sigma)), "rotation": F.when(u("on:rotation") < c.rotation, span("rotation", -c.degrees, c.degrees)),
        "scale": span("scale", *c.scale) if moved else none, "cutout_top": F.when(u("on:cutout") < c.cutout, u("cutout_top")), "cutout_left": F.when(u("on:cutout") < c.cutout, u("cutout_left")),
        "scale_top": u("scale_top") if moved else none, "scale_left": u("scale_left") if moved else none, "offset": u("offset"),
    })


def drawn(video: str, version: int, c: AugmentConfig) -> dict:
    """The draws of random.Random, seeded by the hash of video and version; a parameter is drawn only if its kind is applied."""
    import hashlib
    import random

    rng = random.Random(int(hashlib.md5(f"{video}_{version}".encode()).hexdigest()[:8], 16))
    out: dict = dict.fromkeys(PARAMS)
    out["flip"] = rng.random() < c.probability["flip"]
    steps = [("brightness_contrast", ["brightness", "contrast"]), ("blur", ["blur_sigma"]), ("rotation", ["rotation"]), ("scale", ["scale"])]
    for kind, parameters in steps:
        if rng.random() < c.probability[kind]:
            out |= {p: rng.uniform(*c.ranges[p]) for p in parameters}
    if rng.random() < c.probability["cutout"]:
        out["cutout_top"], out["cutout_left"] = rng.uniform(0, 0.5 - c.cutout_ratio), rng.uniform(0, 1 - c.cutout_ratio)
    return out


def params_exact(expanded: DataFrame, c: AugmentConfig, video: str = "stem") -> DataFrame:
    """params_native with the values of drawn()."""
    names = expanded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            rows = [drawn(v, n, c) for v, n in zip(batch.column(at(video)).to_pylist(), batch.column(at("version")).to_pylist(), strict=True)]
            new = {"flip": pa.array([r["flip"] for r in rows], pa.bool_())} | {p: pa.array([r[p] for r in rows], pa.float64()) for p in PARAMS}
            yield pa.RecordBatch.from_arrays([*batch.columns, *new.values()], [*names, *new])

    drawn_ = [StructField("flip", BooleanType()), *(StructField(p, DoubleType()) for p in PARAMS)]
    return expanded.mapInArrow(run, StructType([*expanded.schema, *drawn_]))


def described() -> Column:
    """The kinds that a row of parameters applies, joined by +."""
    f = lambda pattern, *cs: F.when(F.col(cs[0]).isNotNull(), F.format_string(pattern, *cs))
    return F.concat_ws(
        "+", F.lit("gray"), F.when(F.col("flip"), "flip"), f("bc(%.2f,%.2f)", "brightness", "contrast"), f("blur(%.2f)", "blur_sigma"), f("rot(%.1f)", "rotation"), f("scale(%.2f)", "scale"), F.when(F.col("cutout_top").isNotNull(), "cutout")
    )


def cutout_rectangle(width: int, height: int, ratio: float) -> dict[str, Column]:
    """x, y, w, h of the cut, whose sides take the root of ratio of the frame's; the parameters are shares of the room that it leaves."""
    w, h = (int(side * ratio**0.5) for side in (width, height))
    return {"x": (F.col("cutout_left") * (width - w)).cast("int"), "y": (F.col("cutout_top") * (height - h)).cast("int"), "w": F.when(F.col("cutout_top").isNotNull(), F.lit(w)), "h": F.when(F.col("cutout_top").isNotNull(), F.lit(h))}


def blur_kernel(sigma: Column) -> Column:
    """Side of the Gaussian kernel; halves round to even."""
    return F.greatest((2 * F.bround(3 * sigma) + 1).cast("int"), F.lit(3))


def presets(spark: SparkSession) -> DataFrame:
    """(name, augmentations, description), in the order of the list."""
    rows = [(i, n, preset_kinds(n)) for i, n in enumerate(PRESET_NAMES)]
    return spark.createDataFrame(rows, "place int, name string, augmentations array<string>").withColumn("description", F.when(F.size("augmentations") == 0, "Baseline (grayscale only)").otherwise(F.array_join("augmentations", " + ")))


def preset_configs(spark: SparkSession, n: int) -> DataFrame:
    """Versions and probabilities of every preset."""
    rows = [(name, c.versions, *(float(c.probability[k]) for k in STANDARD)) for name in PRESET_NAMES for c in [preset_config(name, n)]]
    return spark.createDataFrame(rows, "name string, versions int, " + ", ".join(f"{k} double" for k in STANDARD))


#: Which parameter tells that a kind is applied.
_SHOWN = {"brightness_contrast": "brightness", "blur": "blur_sigma", "rotation": "rotation", "scale": "scale", "cutout": "cutout_top"}


def preset_params(work: DataFrame, c: AugmentConfig, preset: str = "preset", video: str = "stem") -> DataFrame:
    """work(video, preset) with version, flip and PARAMS: each video's versions as the preset of that name draws them.

    A name that no preset has, or null, makes no version.
    """
    configs = preset_configs(work.sparkSession, c.versions)
    found = configs.select(F.col("name").alias(preset), "versions", F.struct(*STANDARD).alias("_p"))
    each = work.join(F.broadcast(found), preset).withColumn("version", F.explode(F.sequence(F.lit(1), F.col("versions"))))  # a row a preset
    drawn_ = params_native(each, replace(c, probability={k: F.col(f"_p.{k}") for k in STANDARD}), video)
    return drawn_.select(*work.columns, "version", "flip", *PARAMS)


def suite(videos: DataFrame, n: int, names: Sequence[str] = PRESET_NAMES, video: str = "stem") -> DataFrame:
    """(place, name, versions, made, plain, and a column a kind): what each preset makes of all videos.

    A kind's column counts the versions that it is applied to, plain those without any; no
    videos give no rows.  A preset has a kind at its standard probability or not at all, so
    versions are drawn once and counted by the kinds drawn, and presets meet the counts.
    """
    drawn_ = params_native(versions(videos.select(video), n), AugmentConfig(versions=n), video)
    has = {"flip": F.col("flip")} | {k: F.col(p).isNotNull() for k, p in _SHOWN.items()}
    cells = drawn_.groupBy((F.col("version") == 1).alias("_first"), *(c.alias(k) for k, c in has.items())).agg(F.count("*").alias("_n"))
    listed = [F.struct(F.lit(i).alias("place"), F.lit(x).alias("name"), F.lit(preset_config(x, n).versions).alias("versions"), F.array(*map(F.lit, preset_kinds(x))).cast("array<string>").alias("kinds")) for i, x in enumerate(names)]
    each = cells.withColumn("_x", F.explode(F.array(*listed))).where(F.col("_first") | (F.col("_x.versions") > 1))
    applied = {k: F.col(k) & F.array_contains("_x.kinds", k) for k in STANDARD}
    total = lambda when: F.sum(F.when(when, F.col("_n")).otherwise(0))
    none = ~F.greatest(*applied.values())
    return each.groupBy(*(F.col(f"_x.{c}").alias(c) for c in ("place", "name", "versions"))).agg(F.sum("_n").alias("made"), total(none).alias("plain"), *(total(c).alias(k) for k, c in applied.items()))


def planned(split: DataFrame, n: int, prefix: str) -> DataFrame:
    """split(path, split) with train paths replaced by all their versions, whether they are there or not."""
    made = versions(split.where("split = 'train'"), n).withColumn("path", below(prefix, augmented_name(stem(file_name(F.col("path"))), F.col("version")))).drop("version")
    return made.unionByName(split.where("split <> 'train'"))


def mapped(videos: DataFrame, available: DataFrame, n: int) -> DataFrame:
    """videos(stem) x versions with name, and present, which tells whether available(name) has it."""
    wanted = versions(videos, n).withColumn("name", augmented_name(F.col("stem"), F.col("version")))
    return wanted.join(available.select("name", F.lit(True).alias("present")).distinct(), "name", "left").withColumn("present", F.coalesce("present", F.lit(False)))


def coverage(mapped_: DataFrame) -> DataFrame:
    """expected, missing, percent, and affected videos"""
    lost = ~F.col("present")
    return mapped_.agg(F.count("*").alias("expected"), F.count_if(lost).alias("missing"), F.coalesce(F.try_divide(F.count_if("present"), F.count("*")) * 100, F.lit(0.0)).alias("percent"), F.count_distinct(F.when(lost, F.col("stem"))).alias("affected"))


def first_missing(mapped_: DataFrame, most: int = 5) -> DataFrame:
    """(stem, missing, first): of each video with missing versions how many, and the first names in order."""
    lost = mapped_.where(~F.col("present")).groupBy("stem").agg(F.count("*").alias("missing"), F.array_sort(F.collect_list("name")).alias("n"))
    return lost.select("stem", "missing", F.slice("n", 1, most).alias("first"))


def require_whole(mapped_: DataFrame) -> DataFrame:
    """mapped_, or an error while it runs if a version is missing."""
    return mapped_.withColumn("present", F.when(F.col("present"), True).otherwise(F.raise_error(F.concat(F.lit("missing version "), F.col("name")))))


def augmented_split(split: DataFrame, available: DataFrame, n: int, raw: str, made: str) -> DataFrame:
    """Train videos as the versions that are there, the others below the raw prefix."""
    train = mapped(split.where("split = 'train'").withColumn("stem", stem(file_name(F.col("path")))), available, n).where("present").select(below(made, F.col("name")).alias("path"), "split")
    return train.unionByName(split.where("split <> 'train'").select(below(raw, F.col("path")).alias("path"), "split"))


def by_video(files: DataFrame) -> DataFrame:
    """files(name) with the stem of the video they were made of, which is their name without version."""
    return files.select("name", without_version(stem(file_name(F.col("name")))).alias("stem"))


def experiment_split(train: DataFrame, files: DataFrame) -> DataFrame:
    """(place, k, stem, name): the files made of each train(place, stem), in the order of their names; videos without any are left out."""
    made = train.join(by_video(files), "stem")
    return made.select("place", F.row_number().over(Window.partitionBy("place", "stem").orderBy("name")).alias("k"), "stem", "name")


def experiment_counts(train: DataFrame, files: DataFrame) -> DataFrame:
    """One row: original_train_count, augmented_train_count and missing_train_count, which counts the videos without files."""
    per = train.join(by_video(files).groupBy("stem").agg(F.count("*").alias("n")), "stem", "left")
    return per.agg(F.count("*").alias("original_train_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("augmented_train_count"), F.count_if(F.col("n").isNull()).alias("missing_train_count"))


def experiment_document(split: DataFrame, files: DataFrame, experiment: str, base_split: str) -> DataFrame:
    """The split document of an experiment: the files made of the train videos of split(split, place, path), the other parts as they are."""
    train = split.where("split = 'train'").select("place", stem(file_name(F.col("path"))).alias("stem"))
    rows = experiment_split(train, files).select(F.lit("train").alias("split"), F.struct("place", "k").alias("place"), F.col("name").alias("path"))
    rest = split.where("split <> 'train'").select("split", F.struct("place", F.lit(0).alias("k")).alias("place"), "path")
    about = experiment_counts(train, files).select(F.lit(experiment).alias("experiment_id"), "*", F.lit(base_split).alias("base_split"))
    return parts_document(rows.unionByName(rest), about)


def augmented_document(split: DataFrame, available: DataFrame, n: int, raw: str, made: str, source: str, bucket: str, original: DataFrame | None = None) -> DataFrame:
    """The document of augmented_split(), its paths in order; original is one row with the metadata of the split it was made from."""
    rows = augmented_split(split.select("path", "split"), available, n, raw, made)
    count = lambda of, part, name: of.agg(F.count_if(F.col("split") == part).alias(name))
    about = count(split, "train", "original_train_count").join(count(rows, "train", "augmented_train_count")).join(count(rows, "val", "val_count")).join(count(rows, "test", "test_count"))  # rows of one each
    about = about.select(F.lit(source).alias("source_split"), F.lit(bucket).alias("gcs_bucket"), F.lit(n).alias("versions_per_video"), "*")
    if original is not None:
        about = about.join(original.select(F.struct(*original.columns).alias("original_metadata")))
    return parts_document(rows.withColumn("place", F.col("path")), about)


def pending(work: DataFrame, completed: DataFrame, key: str = "path") -> DataFrame:
    return work.join(completed.select(key).distinct(), key, "left_anti")


def checkpoint_merge(local: DataFrame, remote: DataFrame) -> DataFrame:
    """The union of two lists of finished ids."""
    return local.unionByName(remote).distinct()
