"""Queries of the operators that work on each text alone, and of packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, media, packing
from .frames import table, written


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = written(media.store(table(spark, sf_dir, "documents")))
    found = media.probe(stored, payload=True)
    key = F.col("keyframe_ranges")
    feature = F.concat_ws("|", "codec", "timescale", F.format_string("%.3f", "duration_s"), "n_samples", F.size(key), F.concat_ws("-", key[0]["start"], key[0]["end"]))
    return found.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"), "codec", "duration_s", "keyframe_ranges",
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    both = bpe.encode(table(spark, sf_dir, "documents"), path, decoded=True)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


QUERIES = {"op4_media_columns": op4_media_columns, "op9_bpe": op9_bpe, "op10_packing": op10_packing}
SQL: dict[str, str] = {}
