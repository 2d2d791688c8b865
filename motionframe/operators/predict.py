"""Predictions of clips, their aggregation, and measures of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import argmax, document, softmax


def predicted(logits: DataFrame, names: Column) -> DataFrame:
    """logits(logits) with probability_vector, predicted_idx, predicted_label and confidence in percent; names maps places to labels."""
    out = logits.withColumn("probability_vector", softmax(F.col("logits"))).withColumn("predicted_idx", argmax(F.col("probability_vector")))
    return out.withColumns({"predicted_label": label_of(F.col("predicted_idx"), names), "confidence": F.array_max("probability_vector") * 100})


def label_of(idx: Column, names: Column) -> Column:
    """The label of a place, or the place itself where the map has none."""
    return F.coalesce(F.try_element_at(names, idx), idx.cast("string"))


def mean_probability(clips: DataFrame, key: str) -> DataFrame:
    """(key, mean, predicted_idx, confidence, n_clips): the element-wise mean of the vectors of each key."""
    long = clips.select(key, F.posexplode("probability_vector").alias("i", "p")).groupBy(key, "i").agg(F.avg("p").alias("p"), F.count("*").alias("n"))
    out = long.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "p"))).alias("v"), F.max("n").alias("n_clips")).withColumn("mean", F.transform("v", lambda x: x["p"])).drop("v")
    return out.withColumns({"predicted_idx": argmax(F.col("mean")), "confidence": F.array_max("mean") * 100})


def clips_per_track(clips: DataFrame, key: str) -> DataFrame:
    return clips.groupBy(key).agg(F.count("*").alias("n_clips"))


def primary_track(clips: DataFrame, key: str) -> DataFrame:
    """(track, n_clips): the track with most clips, of equal ones the least."""
    best = F.max(F.struct("n_clips", (-F.col(key)).alias("k")))
    return clips_per_track(clips, key).agg(best.alias("b")).select((-F.col("b.k")).alias("track"), F.col("b.n_clips").alias("n_clips"))


def report(clips: DataFrame, key: str, names: Column) -> DataFrame:
    """One row: tracks, primary track, outcome, and the label, confidence and number of clips of the primary track.

    clips with a null probability_vector have failed; the primary track is chosen before they are left out.
    """
    main = primary_track(clips, key)
    tracks = clips.agg(F.count_distinct(key).alias("tracks"))
    good = clips.where("probability_vector is not null")
    mine = mean_probability(good.join(F.broadcast(main.select(F.col("track").alias(key))), key), key)  # main is one row
    out = tracks.join(main.select("track"), how="left").join(mine.withColumnRenamed(key, "track"), "track", "left")
    outcome = F.when(F.col("tracks") == 0, "no runners").when(F.col("n_clips").isNull(), "all clips failed").otherwise("success")
    return out.select("tracks", F.col("track").alias("primary_track"), outcome.alias("outcome"), label_of(F.col("predicted_idx"), names).alias("predicted_label"), "confidence", F.coalesce("n_clips", F.lit(0)).cast("long").alias("num_clips"))


def percents(v: Column, names: Column) -> Column:
    """A map of label to percent from a vector of shares, in its order; labels that aren't all different are an error."""
    places = F.transform(v, lambda _, i: label_of(i, names))
    return F.map_from_arrays(places, F.transform(v, lambda x: x * 100))


def full_report(clips: DataFrame, key: str, names: Column, clip: str, video: str, model_dir: str) -> DataFrame:
    """One row with the fields of an inference report in their order, and each good clip of the primary track by name.

    clips as for report(), and a column that names a clip.  A video has few clips of one track, and they are one list.
    """
    short = report(clips, key, names)
    main = short.select(F.col("primary_track").alias("_main"), "num_clips")
    one = F.struct(F.col(clip).cast("string").alias("clip"), "predicted_label", "confidence", percents(F.col("probability_vector"), names).alias("probabilities"))
    mine = clips.where("probability_vector is not null").join(F.broadcast(main), F.col(key) == F.col("_main"))  # main is one row
    # maps have no order, so a list of structs that hold them is sorted by name and place alone
    each = mine.select(F.struct(F.col(clip).cast("string").alias("n"), F.monotonically_increasing_id().alias("at")).alias("k"), one.alias("v"))
    listed = each.agg(F.array_sort(F.collect_list(F.struct("k", "v")), lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)).alias("l"))
    means = mean_probability(mine, key).select(percents(F.col("mean"), names).alias("mean_probabilities"))
    none = "array<struct<clip: string, predicted_label: string, confidence: double, probabilities: map<string, double>>>"
    row = short.join(means, how="left").join(listed, how="left")
    return row.select(
        F.lit(video).alias("video"), F.lit(model_dir).alias("model_dir"), F.col("tracks").alias("total_runners_detected"), F.col("primary_track").alias("primary_track_id"),
        F.when(F.col("primary_track").isNotNull(), "most_clips").alias("primary_track_selection_reason"), "num_clips", "predicted_label", "confidence", "mean_probabilities",
        F.coalesce(F.transform("l", lambda x: x["v"]), F.array().cast(none)).alias("per_clip"),
    )


def report_document(row: DataFrame, **about: str) -> DataFrame:
    """One row, json: a report with what else is known of it; fields without a value are null."""
    return row.select(document(F.struct(*(F.lit(v).alias(k) for k, v in about.items()), *row.columns)).alias("json"))


def sampled_frames(n: Column, how: str = "uniform", size: int = 16, draw: Column | None = None) -> Column:
    """Which `size` of n frames a clip takes: spread evenly, from the middle, or from an offset; fewer frames are repeated in turn.

    draw, from 0 to 1 exclusive, is what the offset is made from.
    """
    spread = lambda i: F.floor(i * (n - 1) / float(size - 1)).cast("int")
    middle = lambda i: (F.floor((n - size) / 2) + i).cast("int")
    offset = lambda i: (F.floor(draw * (n - size + 1)) + i).cast("int")
    pick = {"uniform": spread, "centre": middle, "offset": offset}[how]
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.when(n >= size, pick(i)).otherwise(F.pmod(i, n).cast("int")))


def accuracy(rows: DataFrame) -> DataFrame:
    """rows(batch, loss, hit): accuracy in percent, and the mean of the batches' mean losses; 0 of nothing."""
    per = rows.groupBy("batch").agg(F.avg("loss").alias("loss"), F.count_if("hit").alias("hits"), F.count("*").alias("n"))
    return per.agg(F.coalesce(F.try_divide(F.sum("hits"), F.sum("n")) * 100, F.lit(0.0)).alias("accuracy"), F.coalesce(F.avg("loss"), F.lit(0.0)).alias("loss"))


def best_epochs(epochs: DataFrame) -> DataFrame:
    """epochs(run, epoch, val_accuracy) with is_best: above all earlier ones of its run, and above 0."""
    before = Window.partitionBy("run").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    return epochs.withColumn("is_best", F.col("val_accuracy") > F.greatest(F.coalesce(F.max("val_accuracy").over(before), F.lit(0.0)), F.lit(0.0)))
