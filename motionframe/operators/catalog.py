"""File names as records: parsing, building, and profiles of a labelled catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import file_name, pad3, remapped, stem

INTEGER = r"^[+-]?\d+$"


def _int(c: Column) -> Column:
    """Null where the text isn't an integer."""
    return F.when(c.rlike(INTEGER), c.try_cast("int"))


def labelled(paths: DataFrame) -> DataFrame:
    """Paths of lap videos with a label of three digits or question marks."""
    return paths.where(F.col("path").rlike(r"lap_\d+_[\d?]{3}\.mp4$"))


def video_info(path: Column) -> dict[str, Column]:
    """camera, lap and label of a path below the root."""
    name = stem(file_name(path))
    pattern = r"^(lap_\d+)_([\d?]{3})$"
    hit = name.rlike(pattern)
    return {"camera": F.split_part(path, F.lit("/"), F.lit(1)), "lap": F.when(hit, F.regexp_extract(name, pattern, 1)).otherwise(name), "label": F.when(hit, F.regexp_extract(name, pattern, 2)).otherwise("???")}


def parsed(videos: DataFrame) -> DataFrame:
    """videos(path) with runner_id, run_number, camera, lap, cut, label and parsed.

    A name has at least eight parts between underscores; the fifth, seventh and
    eighth are integers, and so is what follows RUN.  Other runs are number 0.
    Names that don't fit have nulls, and parsed is false.
    """
    part = F.split(stem(file_name(F.col("path"))), "_")
    at = lambda i: F.get(part, F.lit(i))
    run = F.when(~F.startswith(at(1), F.lit("RUN")), F.lit(0)).otherwise(_int(F.substring(at(1), 4, 1 << 20)))
    numbers = {"run_number": run, "lap": _int(at(4)), "cut": _int(at(6)), "label": _int(at(7))}
    ok = (F.size(part) >= 8) & numbers["run_number"].isNotNull() & numbers["lap"].isNotNull() & numbers["cut"].isNotNull() & numbers["label"].isNotNull()
    out = videos.withColumn("parsed", ok)
    return out.withColumns({k: F.when(F.col("parsed"), v) for k, v in {"runner_id": at(0), "camera": at(2), **numbers}.items()})


def label_from_name(name: Column, remap: dict[int, int]) -> Column:
    """The digits before .mp4, remapped; without them 0, which isn't remapped."""
    digits = F.regexp_extract(name, r"_(\d+)\.mp4$", 1)
    return F.when(digits != "", remapped(digits.try_cast("int"), remap)).otherwise(0)


def counts(videos: DataFrame) -> DataFrame:
    """(dimension, key, n): clips by label, runner and camera, in one pass."""
    long = videos.withColumns({"label": F.col("label").cast("string")})
    sets = long.groupingSets([["label"], ["runner_id"], ["camera"]], "label", "runner_id", "camera").agg(F.count("*").alias("n"), F.grouping_id("label", "runner_id", "camera").alias("g"))
    kind = F.when(F.col("g") == 3, "label").when(F.col("g") == 5, "runner").otherwise("camera")
    return sets.select(kind.alias("dimension"), F.coalesce("label", "runner_id", "camera").alias("key"), "n")


def cross(videos: DataFrame, a: str, b: str) -> DataFrame:
    return videos.groupBy(a, b).agg(F.count("*").alias("n"))


def imbalance(videos: DataFrame, key: str) -> DataFrame:
    """Largest count over smallest; 0 of nothing."""
    per = videos.groupBy(key).agg(F.count("*").alias("n"))
    lo, hi = F.min("n"), F.max("n")
    return per.agg(F.coalesce(F.when(lo == 0, F.lit(float("inf"))).otherwise(hi / lo), F.lit(0.0)).alias("ratio"))


def distribution(videos: DataFrame, key: str, limit: float = 3.0) -> DataFrame:
    """n, percent, and whether the largest class is over `limit` times the smallest."""
    every = Window.partitionBy(F.lit(1))  # over one row a class
    per = videos.groupBy(key).agg(F.count("*").alias("n"))
    return per.select(key, "n", (F.col("n") / F.sum("n").over(every) * 100).alias("percent"), (F.max("n").over(every) / F.min("n").over(every) > limit).alias("imbalanced"))


def augmented_name(stem_: Column, version: Column) -> Column:
    """{base}_v{NNN}_{label}.mp4; a stem without underscore gets the version at its end."""
    pattern = r"^(.*)_([^_]*)$"
    return F.when(stem_.rlike(pattern), F.concat(F.regexp_extract(stem_, pattern, 1), F.lit("_v"), pad3(version), F.lit("_"), F.regexp_extract(stem_, pattern, 2), F.lit(".mp4"))).otherwise(
        F.concat(stem_, F.lit("_v"), pad3(version), F.lit(".mp4"))
    )


def without_version(stem_: Column) -> Column:
    return F.regexp_replace(stem_, r"_v\d{3}_", "_")


def below(prefix: str, path: Column) -> Column:
    """The path's file name below a prefix."""
    return F.concat(F.lit(prefix.rstrip("/") + "/"), file_name(path))


def experiment_path(bucket: str, suite: str, experiment: Column, what: str) -> Column:
    return F.concat_ws("/", F.lit(bucket), F.lit("experiments"), F.lit(suite), experiment, F.lit(what))


def label_index(videos: DataFrame) -> DataFrame:
    """(label, index): distinct labels in order, from 0."""
    return videos.select("label").distinct().withColumn("index", F.row_number().over(Window.orderBy("label")) - 1)  # one row a label
