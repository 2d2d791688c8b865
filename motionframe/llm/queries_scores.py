"""Queries of the operators that score or judge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality, urls
from .frames import table

RULES = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "example.org", "/en/1"), urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/")]


def fold(key: str) -> Column:
    return F.crc32(F.col(key).cast("string")) % 3


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels").where(fold("doc_id") != 1))
    return quality.score(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document whose number ends its path: bad if toxic or of low quality.

    Outside the rules, the threshold is found on labels that the tree hasn't seen.
    """
    pages = table(spark, sf_dir, "pages")
    number = F.regexp_extract(urls.path_of(F.col("url")), r"/(\d{1,18})(?:\.html)?/?$", 1)
    of_page = pages.select("page_id", F.when(number != "", number.cast("long")).alias("doc_id"))
    labels = of_page.join(table(spark, sf_dir, "labels").hint("merge"), "doc_id").select("page_id", F.greatest("toxic", 1 - F.col("quality")).alias("bad"))
    return urls.judge(pages, labels, RULES, urls.TreeParams(min_purity=None))


QUERIES = {"op2_quality": op2_quality, "op7_url_filter": op7_url_filter}
SQL: dict[str, str] = {}
