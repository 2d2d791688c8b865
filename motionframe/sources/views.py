"""Views of the driver's tables that have the shape of this library's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: users are tracks, in four videos; the event's type says which ankles are seen."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind, x = F.col("event_type"), F.col("value")
    frame = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    seen = lambda ok, x, y: F.when(ok & (x > 0), F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("video_"), F.col("user_id") % 4).alias("video_id"), F.col("user_id").cast("int").alias("track_id"), frame.alias("frame_idx"),
        seen(kind.isin("purchase", "signup", "click"), x, 100 + k).alias("left_ankle"), seen(kind.isin("purchase", "signup", "view"), 2 * x, 100 + 2 * k).alias("right_ankle"),
        F.lit(0.5).alias("confidence"), F.when(F.col("event_id") % 10 == 0, 0.0).otherwise((100 + k).cast("double")).alias("bbox_height"), F.lit(0).alias("det_seq"),
    )


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clip's file name per document; unlabelled ones carry ??? in place of a label."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    label = F.when(F.col("quality").isNotNull(), F.format_string("%03d", F.col("quality") + 2 * F.col("toxic"))).otherwise("???")
    name = F.format_string("%s_RUN%d_%s_lap_%03d_CUT_%03d_%s", "source", F.col("doc_id") % 3 + 1, F.upper("lang"), F.col("doc_id") % 100, "doc_id", label)
    return docs.select("doc_id", "source", "lang").join(labels.select("doc_id", "quality", "toxic"), "doc_id", "left").select(
        "doc_id", F.concat("lang", F.lit("/clips/"), name, F.lit(".mp4")).alias("path"), name.alias("stem")
    )


def runners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as subjects and event types as labels."""
    return table(spark, sf_dir, "events").select(F.format_string("%08d", "event_id").alias("path"), F.col("user_id").cast("string").alias("runner_id"), F.col("event_type").alias("label"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as experiment results: a customer is an experiment, the parity of the order tells the local from the remote copy."""
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "pending").otherwise("failed")
    rows = table(spark, sf_dir, "orders").select(
        F.format_string("exp_%06d", "o_custkey").alias("experiment_id"), status.alias("status"), F.when(F.col("o_orderkey") % 5 != 0, F.round(F.col("o_totalprice") % 100, 2)).alias("val_acc"),
        (F.col("o_orderkey") % 2 == 0).alias("remote"), F.col("o_orderkey").alias("seq"),
    )
    last = F.row_number().over(Window.partitionBy("experiment_id", "remote").orderBy(F.desc("seq")))
    return rows.withColumn("_r", last).where("_r = 1").drop("_r")
