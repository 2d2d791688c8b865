"""Small helpers that the operators share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(name: str, of: str = "") -> Column:
    """The column, or the field of the struct column `of`, of exactly this name."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{of}.{quoted}" if of else quoted).alias(name)


def beside(df: DataFrame, column: str, fields: StructType, make: Callable[[Iterator[pa.Array]], Iterator[list[pa.Array]]], most: int = 1 << 20, instead: tuple[str, ...] = ()) -> DataFrame:
    """df, less the columns `instead`, with fields, whose arrays `make` gives for each array of the column's values.

    Other columns go along in a struct, so they may have any names.
    """
    names = [c for c in df.columns if c not in instead]
    kept = StructType([df.schema[n] for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def values() -> Iterator[pa.Array]:
            for part in slices(batches, most):
                held.append(part.column(0).flatten())
                yield part.column(1)

        for made in make(values()):
            yield pa.RecordBatch.from_arrays([*held.pop(), *made], [*names, *fields.names])

    return df.select(F.struct(*map(named, names)).alias("row"), named(column)).mapInArrow(run, StructType([*kept, *fields]))


def slices(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about `most` bytes, one row at least, so that long texts don't pile up."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()  # the worker goes on to other tasks


def shared_dir(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir, which the driver and all executors see."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.sparkContext._jsc.sc().getCheckpointDir()
        if base.isDefined():
            base = base.get()
        elif spark.sparkContext.master.partition("[")[0] == "local":  # driver and executor are one process here
            base = f"{tempfile.gettempdir()}/motionframe-checkpoints"
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """df, written to the shared folder and read again: lineage ends here, and lost executors lose nothing."""
    spark = df.sparkSession
    path = path or shared_dir(spark)
    df.write.mode("overwrite").parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # the context removes shuffle files of plans that are garbage, once they are collected
    return spark.read.schema(df.schema).parquet(path)


def spread_join(rows: DataFrame, of_keys: DataFrame, on: list[str], by: list[str], how: str = "inner", salts: int = 8, few: bool = False) -> DataFrame:
    """rows joined with of_keys, which has a row a key at most; the rows of one key are dealt to tasks by a hash of the columns `by`.

    Unless of_keys are few, both are shuffled: Spark takes the compressed files of
    a table that was written, and no salts, for the size of what the driver would broadcast.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    keys = of_keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(keys if few else keys.hint("merge"), [*on, "_salt"], how).drop("_salt")


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that written() made; nothing may read them any more."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        for file in df.inputFiles()[:1]:
            path = jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
