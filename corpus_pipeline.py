"""The corpus pipeline: documents in, rows of packed token sequences out.

Each stage takes what its predecessor kept, written as Parquet and read again.
All but the last return the columns of documents.  Stages hand Python workers
BATCH bytes at once, a setting that the session keeps, as results are lazy.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.llm import neardup, packing, pii, quality, substrings
from motionframe.llm.frames import table, written
from motionframe.llm.queries_rows import vocabulary
from motionframe.llm.queries_texts import KEY

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Two documents are near duplicates from this share of common runs of five words, in percent.
PERCENT = 80
#: Bytes of rows that an executor holds for a Python worker, and the worker itself, beside the heap; a longer row goes alone.
BATCH = 2 << 20
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, whose rows and the rows of what it returns go to Python in batches of about BATCH bytes."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the preference model, fitted on the labelled ones, doesn't reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), model).where("predicted = 1").select(*COLUMNS)


@in_small_batches
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near duplicates, once.

    Of rows of one id and equal text the first by lang, source and n_chars stays,
    nulls first.  Unequal texts of one id, and rows with a null id, all stay.
    """
    gone = written(neardup.near_duplicates(docs, percent=PERCENT).where("not kept").select("doc_id"))
    rest = docs.join(gone, "doc_id", "left_anti").select(*COLUMNS).withColumn("_key", F.coalesce(F.sha2("text", 256), F.lit("")))
    again = written(rest.where("doc_id is not null").groupBy("doc_id", "_key").agg(F.count("*").alias("_n")).where("_n > 1"))
    if again.isEmpty():
        return rest.select(*COLUMNS)
    marked = rest.join(again, ["doc_id", "_key"], "left")
    first = marked.where("_n is not null").groupBy("doc_id", "_key").agg(F.min(F.struct("lang", "source", "n_chars", "text")).alias("_first")).select("doc_id", "_first.*")
    return marked.where("_n is null").select(*COLUMNS).unionByName(first.select(*COLUMNS))


@in_small_batches
def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand in an earlier one."""
    rest = substrings.remove(docs, carry=("lang", "source"), untouched=True).withColumnRenamed("kept", "text")
    return rest.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@in_small_batches
def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data and secrets."""
    return pii.pseudonymise(docs.select(*COLUMNS), KEY).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@in_small_batches
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality", quality_stage), ("near duplicates", near_duplicate_stage), ("substrings", substring_stage), ("surrogates", private_stage), ("packing", packing_stage)]
#: No SQL: the model, the surrogates and the packing aren't SQL's to express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
