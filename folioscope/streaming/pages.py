"""The row-wise half of the page flow over a stream of delivered pages, and segmentation of each micro-batch's files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioscope.config import DEFAULT, Config
from folioscope.operators import detect, pages as pg


def read(spark: SparkSession, folder: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else r).parquet(folder)


def annotated(pages: DataFrame, config: Config = DEFAULT, delay: str = "2 days") -> DataFrame:
    """Each page once within the watermark, with its route, status and whether it may be a separator or delimiter."""
    once = pages.withWatermark("ingested_at", delay).dropDuplicatesWithinWatermark(["doc_id", "page_number"])
    return once.select(*pages.columns, pg.needs_second_pass(config).alias("second_pass"), pg.page_status(config).alias("status"), detect.is_candidate(F.col("lines"), config).alias("is_candidate"), detect.is_delimiter(F.col("lines"), config).alias("is_delimiter"))


def confidence_by_window(pages: DataFrame, every: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Pages and mean confidence by source and window of arrival; late rows beyond the delay are left out."""
    return pages.withWatermark("ingested_at", delay).groupBy(F.window("ingested_at", every).alias("w"), "source").agg(F.count("*").alias("n_pages"), F.avg("conf_promedio").alias("confidence"))


def per_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
