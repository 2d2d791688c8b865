"""Files as tables: listings of videos, split documents, and detections from decoders that a caller brings.

Paths are read by Spark, so any file system that it knows will do.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import document, file_name

DETECTIONS = "video_id string, track_id int, frame_idx int, left_ankle struct<x:double,y:double>, right_ankle struct<x:double,y:double>, confidence double, bbox_height double, det_seq int"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scratch(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share; where it isn't set, only a session of one process has another."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/motionframe-checkpoints"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def listing(spark: SparkSession, path: str, recursive: bool = False, suffix: str = ".mp4", missing_ok: bool = True) -> DataFrame:
    """(path, name) of the files with the suffix, matched by case, below a folder or for a single file.

    A missing path is an empty table, or an error if it isn't to be missing.
    """
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], "path string, name string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path).select("path")
    return files.where(F.endswith("path", F.lit(suffix))).select("path", file_name(F.col("path")).alias("name"))


def labelled_videos(spark: SparkSession, root: str) -> DataFrame:
    """Lap videos with a label, at any depth."""
    return listing(spark, root, recursive=True).where(F.col("name").rlike(r"lap_\d+_[\d?]{3}\.mp4$"))


def clips_by_track(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, track, clip) of files named after a track and a clip; others are left out."""
    track = F.regexp_extract("name", r"_ID_(\d+)_clip_(\d+)\.mp4$", 1)
    clip = F.regexp_extract("name", r"_ID_(\d+)_clip_(\d+)\.mp4$", 2)
    return listing(spark, folder).where(track != "").select("path", "name", track.cast("int").alias("track"), clip.cast("int").alias("clip"))


def memorised(spark: SparkSession, folder: str) -> DataFrame:
    """(path, label) of files with _label_N_ in their name; none at all is an error."""
    label = F.regexp_extract("name", r"_label_(\d+)_", 1)
    found = listing(spark, folder).where(label != "").select("path", label.cast("int").alias("label"))
    if found.isEmpty():
        raise ValueError(f"no labelled videos below {folder}")
    return found


PARTS = ("train", "val", "test")


def read_split(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(split, place, path) of a split document; parts that it lacks are empty, or an error if strict."""
    doc = spark.read.option("multiLine", True).schema(", ".join(f"{p} array<string>" for p in PARTS)).json(path)
    if strict and not doc.where(" or ".join(f"{p} is null" for p in PARTS)).isEmpty():
        raise KeyError(f"{path} lacks a part")
    out = [doc.select(F.lit(p).alias("split"), F.posexplode(p).alias("place", "path")) for p in PARTS]
    return out[0].unionByName(out[1]).unionByName(out[2])


def split_document(assigned: DataFrame) -> DataFrame:
    """One row, json: the paths of each part in order, and counts; assigned has path, runner_id, label and split.

    The canonical form of a split is the table; a document holds it in one value.
    """
    row = {}
    for p in PARTS:
        mine = F.col("split") == p
        row[p] = F.array_sort(F.collect_list(F.when(mine, F.col("path"))))
    runner = {f"{p}_runners": F.array_sort(F.collect_set(F.when(F.col("split") == p, F.col("runner_id")))) for p in PARTS}
    total = {f"total_{p}": F.count_if(F.col("split") == p) for p in PARTS}
    whole = assigned.agg(*(c.alias(k) for k, c in {**row, **runner, **total}.items()))
    counts = assigned.groupBy("split", "label").count().groupBy("split").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("label").cast("string"), "count")))).alias("m"))
    none = F.create_map().cast("map<string, bigint>")
    maps = counts.agg(*(F.coalesce(F.first(F.when(F.col("split") == p, F.col("m")), True), none).alias(f"{p}_label_counts") for p in PARTS))
    meta = F.struct(*runner, *(f"{p}_label_counts" for p in PARTS), *total)
    return whole.join(F.broadcast(maps)).select(document(F.struct(*PARTS, meta.alias("metadata"))).alias("json"))  # both are one row


def parts_document(rows: DataFrame, about: DataFrame) -> DataFrame:
    """One row, json: the paths of each part of rows(split, place, path) by place, and about, one row, as metadata."""
    mine = lambda p: F.transform(F.array_sort(F.collect_list(F.when(F.col("split") == p, F.struct("place", "path")))), lambda x: x["path"])
    lists = rows.agg(*(mine(p).alias(p) for p in PARTS))
    whole = lists.join(F.broadcast(about.select(F.struct(*about.columns).alias("metadata"))))  # both are one row
    return whole.select(document(F.struct(*PARTS, "metadata")).alias("json"))


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """One file with the text, in UTF-8, in place of what was there; it is written beside it and then renamed, so a reader sees all of it or none."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    to = jvm.org.apache.hadoop.fs.Path(path)
    fs = to.getFileSystem(conf)
    beside = jvm.org.apache.hadoop.fs.Path(to.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(to, True)
    if not fs.rename(beside, to):
        raise OSError(f"{path} could not be put in its place")


def get_text(spark: SparkSession, path: str) -> str | None:
    """What put_text() put there, or the text of a single file; null where there is none."""
    if not exists(spark, path):
        return None
    return "".join(r.content.decode() for r in spark.read.format("binaryFile").load(path).select("content").collect())  # one document


def write_split(assigned: DataFrame, path: str) -> None:
    """The document of a split as one file."""
    put_text(assigned.sparkSession, path, split_document(assigned).first().json)


def decoded(spark: SparkSession, path: str, decode: Callable[[str, bytes], Iterator[dict]]) -> DataFrame:
    """Detections of the videos below a path, from a function of path and content that yields rows of DETECTIONS.

    The function stands for a decoder and a pose tracker, neither of which is
    part of this library.  A video it fails on raises, and Spark tries it again.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(DETECTIONS)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = list(decode(where, content))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.mp4").load(path).select("path", "content").mapInArrow(run, schema)


def attempted(spark: SparkSession, path: str, work: Callable[[str, bytes], int]) -> DataFrame:
    """(path, clips_generated, success, error_message) of each video below a path, from a function of path and content that returns how many clips it made.

    A video on which the function raises is a row of its own with no clips and
    the error's text; the others go on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for where, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows.append((where, work(where, content), True, None))
                except Exception as e:  # whatever it is, it is this video's
                    rows.append((where, 0, False, str(e)))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.bool_(), pa.string()), strict=True)], ["path", "clips_generated", "success", "error_message"])

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.mp4").load(path).select("path", "content").mapInArrow(run, "path string, clips_generated bigint, success boolean, error_message string")


def without_unseen(detections: DataFrame) -> DataFrame:
    """Ankles at 0 or below count as not seen."""
    ok = lambda c: F.when((F.col(f"{c}.x") > 0) & (F.col(f"{c}.y") > 0), F.col(c))
    return detections.withColumns({c: ok(c) for c in ("left_ankle", "right_ankle")})
