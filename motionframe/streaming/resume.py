"""Work that goes on where it stopped, over a stream of new files."""

from __future__ import annotations

import signal
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.augment import pending
from ..operators.experiments import batch_tally
from ..sources.files import exists, put_text
from ..sources.remote import located

COMPLETED = "path string, completed_at timestamp"


def completed(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What is done, a row an item; nothing before the first."""
    return spark.read.schema(COMPLETED).parquet(checkpoint) if exists(spark, checkpoint) else spark.createDataFrame([], COMPLETED)


def work_off(batch: DataFrame, checkpoint: str, work: Callable[[DataFrame], DataFrame]) -> None:
    """Does the items of batch(path) that aren't done yet; work returns the rows of those that it did.

    Their paths are appended, so an item that fails stays pending and one that
    is done is done once, however often a batch comes.
    """
    done = work(pending(batch, completed(batch.sparkSession, checkpoint)))
    done.select("path", F.current_timestamp().alias("completed_at")).write.mode("append").parquet(checkpoint)


def follow(listing: DataFrame, checkpoint: str, progress: str, work: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Works off a streaming table of paths; progress is the stream's own checkpoint."""
    return listing.writeStream.foreachBatch(lambda batch, _: work_off(batch, checkpoint, work)).option("checkpointLocation", progress).trigger(availableNow=True).start()


OUTCOMES = "path string, clips_generated bigint, success boolean, error_message string, completed_at timestamp"


def stop(spark: SparkSession, flag: str) -> None:
    """Asks all runs with this flag to stop: videos at work are finished, others aren't begun."""
    put_text(spark, flag, "")


@contextmanager
def on_signals(spark: SparkSession, flag: str) -> Iterator[str]:
    """While inside, the first interrupt or termination asks runs to stop; a second one ends their jobs.

    Gives the tag that the jobs of this thread have.
    """
    tag, asked = f"motionframe-{uuid.uuid4().hex}", []

    def heard(*_) -> None:
        if asked:
            spark.interruptTag(tag)
        else:
            stop(spark, flag)
        asked.append(True)

    before = {s: signal.signal(s, heard) for s in (signal.SIGINT, signal.SIGTERM)}
    spark.addTag(tag)
    try:
        yield tag
    finally:
        spark.removeTag(tag)
        for s, was in before.items():
            signal.signal(s, was)


def outcomes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What became of the items that runs have begun, a row a time that each was; nothing before the first."""
    return spark.read.schema(OUTCOMES).parquet(checkpoint) if exists(spark, checkpoint) else spark.createDataFrame([], OUTCOMES)


def process(todo: DataFrame, checkpoint: str, work: Callable[[str], int], flag: str | None = None, tasks: int | None = None) -> DataFrame:
    """Does work on each path of todo(path) that no run has done yet, and returns the tally of this run.

    work returns how many clips it made; if it raises, the item is a failure
    with the error's text, and a later run tries it again.  Before each item a
    task looks for the flag; if it is there, the task leaves what remains to the
    next run and ends well, so all that was finished is kept.  A flag that was
    there before the run begins is taken down.  Outcomes are written by one job,
    whose tasks commit once: a task that comes again repeats its own items and no others.
    """
    spark = todo.sparkSession
    if flag is not None:
        fs, path = located(flag)
        if fs.get_file_info(path).type != arrow_fs.FileType.NotFound:
            fs.delete_file(path)
    rest = pending(todo.select("path").distinct(), outcomes(spark, checkpoint).where("success"))
    rest = rest.repartition(tasks or 4 * spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                if flag is not None:
                    fs, at = located(flag)
                    if fs.get_file_info(at).type != arrow_fs.FileType.NotFound:
                        return
                try:
                    row = path, work(path), True, None
                except Exception as e:  # whatever it is, it is this item's
                    row = path, 0, False, str(e)
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, (pa.string(), pa.int64(), pa.bool_(), pa.string()), strict=True)], ["path", "clips_generated", "success", "error_message"])

    done = rest.mapInArrow(run, "path string, clips_generated bigint, success boolean, error_message string")
    now = uuid.uuid4().hex
    done.withColumn("completed_at", F.current_timestamp()).write.parquet(f"{checkpoint}/run={now}")
    return batch_tally(spark.read.schema(OUTCOMES).parquet(f"{checkpoint}/run={now}"))
