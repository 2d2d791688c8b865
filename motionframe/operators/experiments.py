"""Bookkeeping of experiments: merging copies of results, progress, and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import document
from ..sources.files import put_text

ID = "experiment_id"
#: The states of an experiment as result documents hold them.
PENDING, AUGMENTED, COMPLETED, FAILED = "pending", "augmented", "completed", "failed"
#: Phases as a checkpoint names them while they run.
AUGMENTING, TRAINING = "augmenting", "training"
#: The fields of a result in a document's order, with what stands for one that isn't known.
FIELDS = {
    "experiment_id": ("string", None), "augmentations": ("array<string>", []), "augmentation_description": ("string", ""), "original_train_count": ("int", 0), "augmented_train_count": ("int", 0), "versions_per_video": ("int", 25),
    "train_acc": ("double", None), "val_acc": ("double", None), "test_acc": ("double", None), "train_loss": ("double", None), "val_loss": ("double", None), "test_loss": ("double", None), "best_val_acc": ("double", None),
    "training_time_seconds": ("double", None), "status": ("string", PENDING), "error_message": ("string", None), "model_path": ("string", None), "dataset_path": ("string", None),
}


def _side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    left, right = a.select(ID, F.struct(*a.columns).alias("a")), b.select(ID, F.struct(*a.columns).alias("b"))
    return left.join(right, ID, "full_outer")


def upserted(rows: DataFrame, new: DataFrame, order: str = "seq") -> DataFrame:
    """rows with those of new, of each id the latest."""
    rank = F.row_number().over(Window.partitionBy(ID).orderBy(F.desc("_new"), F.desc(order)))
    both = rows.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return both.withColumn("_r", rank).where("_r = 1").drop("_r", "_new")


def saved(local: DataFrame, remote: DataFrame) -> DataFrame:
    """What a save keeps: the remote row where it is completed and the local one isn't, else the local one; other remote rows go."""
    take = (F.col("b.status") == COMPLETED) & (F.col("a").isNull() | (F.col("a.status") != COMPLETED))
    return _side_by_side(local, remote).select(F.when(take, F.col("b")).otherwise(F.col("a")).alias("r")).where("r is not null").select("r.*")


def loaded(current: DataFrame, found: DataFrame) -> DataFrame:
    """What a load keeps, with origin: the loaded row wins; new, updated, or current."""
    origin = F.when(F.col("b").isNull(), "current").when(F.col("a").isNull(), "new").otherwise("updated")
    return _side_by_side(current, found).select(F.coalesce("b", "a").alias("r"), origin.alias("origin")).select("r.*", "origin")


def _states() -> list[Column]:
    return [F.count("*").alias("total_experiments"), *(F.count_if(F.col("status") == s).alias(s) for s in (COMPLETED, PENDING, FAILED))]


def status_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(*_states())


def ranked(rows: DataFrame) -> DataFrame:
    """Completed rows with rank, by falling val_acc, a percentage; without one it counts as 0; ties by seq.

    Ranks are counted within each percent, and go on from those above it.
    """
    value = F.coalesce("val_acc", F.lit(0.0))
    done = rows.where(F.col("status") == COMPLETED).withColumn("_p", F.floor(value).cast("int"))
    sizes = done.groupBy("_p").agg(F.count("*").alias("_n"))
    above = F.sum("_n").over(Window.orderBy(F.desc("_p")).rowsBetween(Window.unboundedPreceding, -1))  # a row a percent
    before = sizes.select("_p", F.coalesce(above, F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(value.desc(), "seq")) + F.col("_before")
    return done.join(before, "_p").withColumn("rank", rank.cast("int")).drop("_p", "_before")


def eligible(augmented: DataFrame, trained: DataFrame, wanted: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Ids that are augmented and not trained, of those wanted; with force, and only with a list, trained ones too."""
    out = augmented.select(ID).distinct()
    if wanted is not None:
        out = out.join(wanted.select(ID), ID, "left_semi")
    return out if force and wanted is not None else out.join(trained.select(ID), ID, "left_anti")


def progress(every: DataFrame, augmented: DataFrame, trained: DataFrame) -> DataFrame:
    """total, augmented, trained and remaining ids"""
    flag = lambda df, name: df.select(ID, F.lit(1).alias(name)).distinct()
    both = every.select(ID).distinct().join(flag(augmented, "a"), ID, "left").join(flag(trained, "t"), ID, "left")
    return both.agg(F.count("*").alias("total"), F.count("a").alias("augmented"), F.count("t").alias("trained"), F.count_if(F.col("t").isNull()).alias("remaining"))


def remaining(every: DataFrame, augmented: DataFrame) -> DataFrame:
    """Ids that aren't augmented yet."""
    return every.select(ID).distinct().join(augmented.select(ID), ID, "left_anti")


METRICS = ("train_acc", "val_acc", "test_acc", "best_val_acc", "train_loss", "val_loss", "test_loss")


def after_phase(rows: DataFrame, outcomes: DataFrame, phase: str = TRAINING) -> DataFrame:
    """rows after a phase with outcomes(experiment_id, error_message, and what it made).

    Where it went well, augmenting makes an experiment augmented, with the
    dataset_path of its outcome; training makes it completed, with the metrics
    and the model_path that rows and outcomes both have.  Where it didn't, the experiment
    has failed, with the message.  Rows without an outcome stay; outcomes
    without a row are left out.
    """
    made, then = {AUGMENTING: (("dataset_path",), AUGMENTED), TRAINING: ((*METRICS, "model_path"), COMPLETED)}[phase]
    shared = [m for m in made if m in rows.columns and m in outcomes.columns]
    came = outcomes.select(ID, F.lit(True).alias("_came"), F.col("error_message").alias("_error"), *(F.col(m).alias("_" + m) for m in shared))
    good, bad = F.col("_came") & F.col("_error").isNull(), F.col("_error").isNotNull()
    new = {"status": F.when(good, then).when(bad, FAILED).otherwise(F.col("status"))} | {m: F.when(good, F.col("_" + m)).otherwise(F.col(m)) for m in shared}
    if "error_message" in rows.columns:
        new["error_message"] = F.when(bad, F.col("_error")).otherwise(F.col("error_message"))
    return rows.join(came, ID, "left").withColumns(new).select(*rows.columns)


def listed(every: DataFrame, augmented: DataFrame, trained: DataFrame) -> DataFrame:
    """every experiment with its flags"""
    flag = lambda df, name: df.select(ID, F.lit(True).alias(name)).distinct()
    out = every.select(ID).distinct().join(flag(augmented, "augmented"), ID, "left").join(flag(trained, "trained"), ID, "left")
    return out.na.fill(False, ["augmented", "trained"])


def fixed(c: Column, digits: int) -> Column:
    """A number in fixed notation, rounded by its exact value, as Java's format isn't; null is empty.  For reports, which are short."""
    shown = F.udf(lambda x: "" if x is None else f"{x:.{digits}f}", "string", useArrow=True)
    return shown(c.cast("double"))


def csv_rows(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of the CSV report, as text, and those to keep; those that rows lacks are empty."""
    has = lambda name, shown: shown(F.col(name)) if name in rows.columns else F.lit("")
    plain = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    kinds = has("augmentations", lambda c: F.when(F.size(c) > 0, F.array_join(c, "+")).otherwise("none"))
    return rows.select(
        ID, kinds.alias("augmentations"), has("original_train_count", plain).alias("original_samples"), has("augmented_train_count", plain).alias("augmented_samples"), has("versions_per_video", plain).alias("versions_per_video"),
        *(has(m, lambda c, d=4 if m.endswith("loss") else 2: fixed(c, d)).alias(m) for m in METRICS), has("training_time_seconds", lambda c: fixed(c, 0)).alias("training_time_s"), "status", *keep,
    )


def csv_document(rows: DataFrame, order: str | None = None) -> DataFrame:
    """One row, csv: the whole report, by `order`, else by id; lines end as RFC 4180 has it, and a field is quoted only where it must be."""
    shown = csv_rows(rows if order is None else rows.withColumn("_at", F.col(order)), keep=() if order is None else ("_at",))
    names = [c for c in shown.columns if c != "_at"]
    field = lambda c: F.when(F.col(c).rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(c, F.lit("")))
    line = F.concat_ws(",", *(field(c) for c in names))
    lines = shown.select(F.struct(F.col("_at" if order else ID).alias("at"), F.col(ID).alias("id"), line.alias("line")).alias("l")).agg(F.array_sort(F.collect_list("l")).alias("l"))
    head = ",".join(names) + "\r\n"
    return lines.select(F.concat(F.lit(head), F.array_join(F.transform("l", lambda x: F.concat(x["line"], F.lit("\r\n"))), "")).alias("csv"))


def write_csv(rows: DataFrame, path: str, order: str | None = None) -> None:
    """The report as one file."""
    put_text(rows.sparkSession, path, csv_document(rows, order).first().csv)


def batch_tally(results: DataFrame) -> DataFrame:
    """results(clips_generated, success): clips, processed and failed; a success without clips is processed."""
    return results.agg(F.coalesce(F.sum(F.when(F.col("success"), F.col("clips_generated"))), F.lit(0)).alias("clips"), F.count_if("success").alias("processed"), F.count_if(~F.col("success")).alias("failed"))


def shortened(text: Column, most: int = 12) -> Column:
    """For narrow reports: longer texts end in ~."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 1), F.lit("~"))).otherwise(text)


def result_document(rows: DataFrame, order: str | None = None) -> DataFrame:
    """One row, json: all fields of the results by `order`, else by id, and a summary of their states.

    A field that rows lacks, or that is null though it can't be, has its
    default; other columns are left out.  Experiments are few; a corpus's rows are not for this.
    """
    default = lambda kind, v: F.array().cast(kind) if v == [] else F.lit(v).cast(kind)
    value = lambda name, kind, v: F.coalesce(F.col(name).cast(kind), default(kind, v)) if name in rows.columns else default(kind, v)
    result = F.struct(*(value(n, k, v).alias(n) for n, (k, v) in FIELDS.items()))
    each = rows.select(F.struct(F.col(order or ID).alias("at"), F.col(ID).alias("id"), result.alias("r")).alias("x"), "status")
    whole = each.agg(F.array_sort(F.collect_list("x")).alias("x"), F.struct(*_states()).alias("summary"))
    return whole.select(document(F.struct(F.transform("x", lambda x: x["r"]).alias("results"), "summary")).alias("json"))


def write_results(rows: DataFrame, path: str, order: str | None = None) -> None:
    """The results as one file."""
    put_text(rows.sparkSession, path, result_document(rows, order).first().json)


def read_results(like: DataFrame, path: str) -> DataFrame:
    """The results of a document, with those columns of like that a result has."""
    kinds = {f.name: f.dataType.simpleString() for f in like.schema}
    names = [n for n in like.columns if n in FIELDS]
    fields = ", ".join(f"{n}: {kinds[n]}" for n in names)
    return like.sparkSession.read.option("multiLine", True).schema(f"results array<struct<{fields}>>").json(path).select(F.explode("results").alias("r")).select("r.*").select(*names)
