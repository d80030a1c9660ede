"""Jobs: which pages of which files are asked for, and how."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import text as tx

SCHEMA = "job_id bigint, doc_id string, mode string, pdf_path string, pages array<int>, output_dir string, keep_images boolean"


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Jobs from JSON files with a fixed schema; missing fields are null."""
    return spark.read.schema(SCHEMA).option("multiLine", True).json(path)


def modes(jobs: DataFrame) -> DataFrame:
    """Mode (anything but ocr_only means segmentation), whether images are kept, and the file's stem."""
    return jobs.select("job_id", "doc_id", F.when(F.col("mode") == "ocr_only", "ocr_only").otherwise("segmentation").alias("mode"), F.coalesce("keep_images", F.lit(False)).alias("keep_images"), tx.stem(F.col("pdf_path")).alias("stem"))


def requested(jobs: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages (any columns) that jobs ask for.

    A null or empty list means all pages of the file; a page asked for twice
    comes twice; a page that isn't there is skipped.
    """
    some = jobs.where(F.size("pages") > 0).select("job_id", "doc_id", F.explode("pages").alias("page_number")).join(pages, ["doc_id", "page_number"])
    every = jobs.where(F.coalesce(F.size("pages"), F.lit(0)) <= 0).select("job_id", "doc_id").join(pages, "doc_id")
    return some.unionByName(every)
