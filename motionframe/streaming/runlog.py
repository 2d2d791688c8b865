"""What became of experiments, as a log that any number of writers append to at once.

An append is a folder of Parquet files, staged under a hidden name and then
renamed, so it is there as a whole or not at all and no two writers share a
file.  What holds now is a reduction of all events that gives the same whatever
their order and however often they are read; so nothing is read, merged and
written back, and nobody's work is lost.  A compaction writes what the
reduction needs of the batches it has seen and names those; they are left out
from then on, and deleted later, when no reader can be at them any more.

Events have kind, experiment_id, op (put or reset), at, writer and seq, and the
columns of a result.  Kinds are `result`, and sets of experiments such as
`augmented` and `trained`, of which an experiment is a member by a put.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.experiments import COMPLETED, FIELDS
from ..sources.files import exists, get_text, put_text

KEY = ("kind", "experiment_id")
STAMP = {"kind": "string", "op": "string", "at": "timestamp", "writer": "string", "seq": "bigint"}
COLUMNS = STAMP | {n: kind for n, (kind, _) in FIELDS.items()}
NAMES_OF_OLD = "supersedes.txt"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def batches(spark: SparkSession, log: str) -> tuple[set[str], set[str]]:
    """Names of the batches that count, and of those that a compaction has replaced."""
    if not exists(spark, log):
        return set(), set()
    fs, p = _fs(spark, log)
    there = {s.getPath().getName() for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", "."))}
    old = {n for b in there if b.startswith("base-") for n in (get_text(spark, f"{log}/{b}/{NAMES_OF_OLD}") or "").split()}
    return there - old, there & old


def _put(rows: DataFrame, log: str, name: str, old: set[str] = frozenset()) -> str:
    spark, stage = rows.sparkSession, f"{log}/_{name}"
    rows.select(*(F.col(c).cast(k).alias(c) if c in rows.columns else F.lit(None).cast(k).alias(c) for c, k in COLUMNS.items())).write.parquet(stage)
    if old:
        put_text(spark, f"{stage}/{NAMES_OF_OLD}", "\n".join(sorted(old)))
    fs, p = _fs(spark, stage)
    if not fs.rename(p, _fs(spark, f"{log}/{name}")[1]):
        raise OSError(f"{stage} could not be put in its place")
    return name


def append(rows: DataFrame, log: str, writer: str, kind: str = "result", op: str = "put") -> str:
    """Adds rows(experiment_id, ...) as events, and returns the batch's name.

    `at` and `seq`, where rows have them, stay; else they are the time and the
    row's place.  Columns that events don't have aren't kept.
    """
    stamp = {"kind": F.lit(kind), "writer": F.lit(writer), "op": F.lit(op), "at": F.current_timestamp(), "seq": F.monotonically_increasing_id()}
    given = {c: v for c, v in stamp.items() if c not in rows.columns or c in ("kind", "writer")}
    return _put(rows.withColumns(given), log, f"events-{uuid.uuid4().hex}")


def events(spark: SparkSession, log: str) -> DataFrame:
    """All events of the batches that count; none of a log that isn't there."""
    schema = ", ".join(f"{c} {k}" for c, k in COLUMNS.items())
    live, _ = batches(spark, log)
    if not live:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(*(f"{log}/{b}" for b in sorted(live)))


def _order() -> Column:
    """Later events are greater; events of one time are ordered by writer and place, so no two differ and tie."""
    return F.struct("at", "writer", "seq")


def _last_resets(of: DataFrame) -> DataFrame:
    return of.where("op = 'reset'").groupBy(*KEY).agg(F.max(_order()).alias("_reset"))


def _last_puts(of: DataFrame) -> DataFrame:
    """Each key's last completed put and its last put since its last reset; no reset that comes late can let another one win."""
    puts = of.where("op = 'put'").join(_last_resets(of), list(KEY), "left").where(F.col("_reset").isNull() | (_order() > F.col("_reset"))).drop("_reset")
    names = [c for c in puts.columns if c not in KEY]
    done = F.when(F.col("status") == COMPLETED, _order())
    return puts.groupBy(*KEY).agg(F.max_by(F.struct(*names), done).alias("done"), F.max_by(F.struct(*names), _order()).alias("last"))


def reduced(of: DataFrame) -> DataFrame:
    """The event that holds for each kind and experiment.

    A reset takes all that came before it.  Of the rest a completed result
    goes before one that isn't, then a later one before an earlier.  An
    experiment without a put since its last reset has no row.
    """
    return _last_puts(of).select(*KEY, F.coalesce("done", "last").alias("e")).select(*KEY, "e.*")


def results(spark: SparkSession, log: str) -> DataFrame:
    """The result that holds for each experiment, with at and seq."""
    return reduced(events(spark, log)).where("kind = 'result'").select(*FIELDS, "at", "seq")


def members(spark: SparkSession, log: str, kind: str) -> DataFrame:
    """(experiment_id) of those that are augmented, trained, or whatever the kind is."""
    return reduced(events(spark, log)).where(F.col("kind") == kind).select("experiment_id")


def compact(spark: SparkSession, log: str) -> str | None:
    """One batch in place of those there are: what may still come to hold, and the last resets, which count for events that come late.

    Events appended meanwhile stay as they are.  Two compactions at once leave
    two batches that say the same.
    """
    live, _ = batches(spark, log)
    if len(live) < 2:
        return None
    schema = ", ".join(f"{c} {k}" for c, k in COLUMNS.items())
    seen = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(*(f"{log}/{b}" for b in sorted(live)))
    resets = _last_resets(seen).select(*KEY, F.lit("reset").alias("op"), "_reset.*")
    puts = _last_puts(seen).select(*KEY, F.explode(F.array_distinct(F.array_compact(F.array("done", "last")))).alias("e")).select(*KEY, "e.*")
    return _put(puts.unionByName(resets, allowMissingColumns=True), log, f"base-{uuid.uuid4().hex}", live)


def vacuum(spark: SparkSession, log: str) -> int:
    """Deletes batches that a compaction has replaced, and returns how many; readers that began before it must be through."""
    _, old = batches(spark, log)
    # a base goes last: while it is there, it says which of the others don't count
    for name in sorted(old, key=lambda n: n.startswith("base-")):
        fs, p = _fs(spark, f"{log}/{name}")
        fs.delete(p, True)
    return len(old)
