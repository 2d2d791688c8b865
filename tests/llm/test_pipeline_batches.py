"""The pipeline's stages hand bounded batches to Python workers."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def given(spark):
    """The session with Spark's own limit, which is set again in the end."""
    yield spark.conf.unset(KEY)
    spark.conf.unset(KEY)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_a_stage_hands_over_a_few_megabytes_at_once(spark, given, tmp_path, name, stage):
    """Not 10,000 rows, however long; a row that is longer than a batch goes too, and none is lost."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "bytes": [b.nbytes]})

    text = lambda n: F.concat_ws(" ", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(k))), 256) for k in range(n)])
    docs = spark.range(40).select(F.col("id").alias("doc_id"), text(20).alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"), F.lit(1299).cast("long").alias("n_chars"))
    docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")
    out = stage(spark, docs, str(tmp_path))
    long = spark.range(0, 6000, 1, 1).select("id", F.when(F.col("id") == 3000, F.expr("repeat('x', 5000000)")).otherwise(F.expr("repeat('word ', 400)")).alias("text"))
    got = long.mapInArrow(sizes, "n bigint, bytes bigint").collect()
    assert sum(r.n for r in got) == 6000
    assert max(r.bytes for r in got) < 5_000_000 + 1.1 * corpus_pipeline.BATCH
    assert sum(r.bytes > 1.1 * corpus_pipeline.BATCH for r in got) == 1
    assert out.count() > 0
