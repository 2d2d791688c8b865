"""Frames with very many regions."""

from pyspark.sql import functions as F

from motionframe.operators import crops


def test_a_frame_of_very_many_regions_is_rows_of_few(spark):
    frames = spark.createDataFrame([("v", 1, 4, 5, 1, bytes(range(20)))], "video_id string, frame_idx int, height int, width int, channels int, pixels binary")
    size = F.lit(2)
    regions = spark.range(1000).select(F.lit("v").alias("video_id"), (F.col("id") % 1 + 1).cast("int").alias("frame_idx"), F.col("id").cast("int").alias("track_id"), F.lit(0).alias("det_seq"), size.alias("roi_size"), (F.col("id") % 4).cast("int").alias("x1"), F.lit(1).alias("y1"), (F.col("id") % 4 + 2).cast("int").alias("x2"), F.lit(3).alias("y2"))
    df = crops.cropped(frames, regions, None)
    assert {r.track_id: bytes(r.pixels) for r in df.collect()} == {k: bytes([5 + k % 4, 6 + k % 4, 10 + k % 4, 11 + k % 4]) for k in range(1000)}
    plan = crops.cropped(frames, regions, None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "_row" in plan
