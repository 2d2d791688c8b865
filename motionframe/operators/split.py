"""Splits by subject: every subject is in one part only, and each label's subjects are dealt to all parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import SplitConfig
from ..functions.scalars import file_name, remapped
from ..sources.files import read_split
from .catalog import label_from_name


def dominant_labels(videos: DataFrame, remap: dict[int, int] | None = None) -> DataFrame:
    """(runner_id, label): the runner's most frequent label, of equal ones that of the least path; remapped at the end."""
    per = videos.groupBy("runner_id", "label").agg(F.count("*").alias("n"), F.min("path").alias("p"))
    rank = F.row_number().over(Window.partitionBy("runner_id").orderBy(F.desc("n"), "p"))
    return per.withColumn("_r", rank).where("_r = 1").select("runner_id", remapped(F.col("label"), remap or {}).alias("label"))


def sizes(n: Column, c: SplitConfig) -> tuple[Column, Column]:
    """How many of n subjects of a label train and validate: one of each at least, while there are three."""
    train, val = F.greatest(F.lit(1), F.floor(n * c.train)), F.greatest(F.lit(1), F.floor(n * c.val))
    fits = n - train - val >= 1
    return F.when(n == 1, 1).when(n == 2, 1).when(fits, train).otherwise(n - val - 1), F.when(n == 1, 0).when(n == 2, 1).otherwise(val)


def part_of(k: Column, n: Column, c: SplitConfig, stratified: bool = True) -> Column:
    """The part of the k-th of n subjects.  Unstratified, all are cut once, with no least sizes."""
    train, val = sizes(n, c) if stratified else (F.floor(n * c.train), F.floor(n * c.val))
    return F.when(k <= train, "train").when(k <= train + val, "val").otherwise("test")


def assigned(runners: DataFrame, c: SplitConfig, stratified: bool = True) -> DataFrame:
    """runners(runner_id, label) with split.

    Subjects are put in the order of a hash of seed and subject; the draws are
    not those of any generator, but the sizes are exact.  They are counted within
    the hash's first digits, and go on from those of less.
    """
    keyed = runners.withColumn("_h", F.md5(F.concat(F.lit(f"{c.seed}|"), F.col("runner_id").cast("string")))).withColumns({"_b": F.substring("_h", 1, 3), "_g": F.col("label").cast("string") if stratified else F.lit("")})
    sizes_ = keyed.groupBy("_g", "_b").agg(F.count("*").alias("_m"))
    group = Window.partitionBy("_g")
    before = F.sum("_m").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))  # 4096 rows a label at most
    sizes_ = sizes_.select("_g", "_b", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_m").over(group).alias("_n")).withColumnsRenamed({"_g": "_g2", "_b": "_b2"})
    row = keyed.join(sizes_, F.col("_g").eqNullSafe(F.col("_g2")) & (F.col("_b") == F.col("_b2")))
    k = F.row_number().over(Window.partitionBy("_g", "_b").orderBy("_h", "runner_id")) + F.col("_before")
    return row.withColumn("_k", k).withColumn("split", part_of(F.col("_k"), F.col("_n"), c, stratified)).select(*runners.columns, "split")


def split_videos(videos: DataFrame, c: SplitConfig, stratified: bool = True) -> DataFrame:
    """videos(path, runner_id, label) with split; label is remapped."""
    parts = assigned(dominant_labels(videos, c.remap), c, stratified).select("runner_id", "split")
    return videos.withColumn("label", remapped(F.col("label"), c.remap)).join(parts, "runner_id")


def summary(split: DataFrame) -> DataFrame:
    """(label, train, val, test): clips of each label in each part, 0 where there are none."""
    return split.groupBy("label").pivot("split", ["train", "val", "test"]).count().na.fill(0)


def part_sizes(split: DataFrame) -> DataFrame:
    """clips, percent and runners of each part"""
    per = split.groupBy("split").agg(F.count("*").alias("clips"), F.count_distinct("runner_id").alias("runners"))
    return per.withColumn("percent", F.col("clips") / F.sum("clips").over(Window.partitionBy(F.lit(1))) * 100)


def exact_order(runners: list[tuple[str, object]], seed: int, stratified: bool = True) -> dict:
    """The shuffle of one seeded generator over the subjects of each label in turn, or of all at once.

    Labels come in the order in which the sorted runners, pairs (runner_id,
    label), first show them.
    """
    import random

    rng, groups = random.Random(seed), {}
    for runner, label in sorted(runners, key=lambda r: r[0]):
        groups.setdefault(label if stratified else None, []).append(runner)
    for group in groups.values():
        rng.shuffle(group)
    return groups


def exact_split(runners: DataFrame, c: SplitConfig, stratified: bool = True) -> DataFrame:
    """assigned(), but in the order that random.Random(seed) shuffles the subjects.

    For lists of subjects that fit the driver: each is one small row there.
    """
    rows = [(r.runner_id, r.label) for r in runners.select("runner_id", "label").collect()]
    placed = [(runner, k + 1, len(group)) for group in exact_order(rows, c.seed, stratified).values() for k, runner in enumerate(group)]
    row = runners.join(runners.sparkSession.createDataFrame(placed, "runner_id string, _k int, _n int"), "runner_id")
    return row.withColumn("split", part_of(F.col("_k"), F.col("_n"), c, stratified)).drop("_k", "_n")


def load_split(spark: SparkSession, path: str, remap: dict[int, int] | None = None, augment: bool = True) -> DataFrame:
    """(split, place, path, label, label_idx, augmented) of a split document, which must have all parts.

    label_idx counts the labels of a part in their order; only train rows are
    augmented, and they only with `augment`.
    """
    rows = read_split(spark, path, strict=True).withColumn("label", label_from_name(file_name(F.col("path")), remap or {}))
    index = F.row_number().over(Window.partitionBy("split").orderBy("label")) - 1  # a row a label
    labels = rows.select("split", "label").distinct().withColumn("label_idx", index)
    return rows.join(labels, ["split", "label"]).select("split", "place", "path", "label", "label_idx", ((F.col("split") == "train") & F.lit(augment)).alias("augmented"))


def require_some(videos: DataFrame) -> DataFrame:
    """videos, or an error if no file could be parsed."""
    if videos.isEmpty():
        raise ValueError("no videos to split")
    return videos
