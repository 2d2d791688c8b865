"""The query of nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import neighbours
from .frames import table


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(base, base.where("vec_id % 20 = 0"), k=20)


QUERIES = {"op1_neighbours": op1_neighbours}
SQL: dict[str, str] = {}
