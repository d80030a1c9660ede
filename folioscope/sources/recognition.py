"""Recorded recognition results from JSON, with defaults for what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id string, page_number int, image_path string, rec_texts array<string>, rec_scores array<string>, dt_polys array<array<array<int>>>, doc_preprocessor_res struct<angle:int>"


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """One result per line; missing lists are empty, a missing angle is 0; scores stay text until they are cast."""
    r = spark.read.schema(SCHEMA).json(path)
    none = lambda kind: F.array().cast(kind)
    return r.select(
        "doc_id", "page_number", "image_path", F.coalesce("rec_texts", none("array<string>")).alias("rec_texts"), F.coalesce("rec_scores", none("array<string>")).alias("rec_scores"),
        F.coalesce("dt_polys", none("array<array<array<int>>>")).alias("dt_polys"), F.coalesce("doc_preprocessor_res.angle", F.lit(0)).alias("angle"),
    )
