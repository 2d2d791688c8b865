"""Queries of archives and of surrogates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pii, warc
from .frames import shared_dir, table, written

#: Only of these queries; who uses the operator brings a secret key.
KEY = b"a key for queries, not a secret"


def page_of(record_id: str) -> Column:
    number = F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1)
    return F.when(number != "", number.cast("long"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    warc.write(table(spark, sf_dir, "pages"), path, min_bytes=0)
    back = warc.reassembled(warc.records(spark, path))
    rows = written(back.select(
        page_of("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), warc.base32_sha1(F.col("payload")).alias("payload_digest"), F.col("type").alias("record_type"),
        page_of("refers_to").alias("refers_to"), "complete", "own_id", "own_refers_to",
    ))
    whole = rows.where("record_type = 'response'")
    origin = whole.select(F.col("own_id").alias("own_refers_to"), "payload_bytes", "payload_digest")
    again = rows.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(origin, "own_refers_to", "left")
    return whole.unionByName(again).drop("own_id", "own_refers_to")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)


QUERIES = {"op3_warc": op3_warc, "op8_surrogates": op8_surrogates}

SQL = {
    "op3_warc": """
        WITH page AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
        bits AS (SELECT *, list_transform(range(8), lambda k: ('0x' || substr(hex, 1 + 5 * k, 5))::BIGINT) AS fives FROM page),
        named AS (SELECT page_id, payload_bytes, array_to_string(list_transform(fives, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> s) & 31)::INT, 1)), '')), '') AS payload_digest FROM bits),
        kept AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keeper FROM named)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> keeper THEN keeper END AS refers_to, true AS complete
        FROM kept
    """,
}
