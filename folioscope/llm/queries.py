"""Queries of the corpus problems, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import canonical, encode, harm, leak, personal, quantiles, scannoise, truncation, unify
from folioscope.session import tables

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return scannoise.found(*tables(spark, d, "pages"))


def p1_text(spark: SparkSession, d: str) -> DataFrame:
    return scannoise.repaired(*tables(spark, d, "pages"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.found(*tables(spark, d, "pages"))


def p2_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.rates(*tables(spark, d, "pages"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return unify.found(*tables(spark, d, "separators", "sections"))


def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    return unify.roles(*tables(spark, d, "separators", "sections"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return personal.found(*tables(spark, d, "pages", "sections"))


def p4_redacted(spark: SparkSession, d: str) -> DataFrame:
    return personal.redacted(*tables(spark, d, "pages", "sections"))


def p5_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return quantiles.percentiles(quantiles.score_sketches(*tables(spark, d, "pages")), quantiles.KEYS, quantiles.SHARES)


def p5_combined(spark: SparkSession, d: str) -> DataFrame:
    """The daily sketches combined over all days."""
    keys = ["metric", "engine_used", "source"]
    return quantiles.percentiles(quantiles.merge(quantiles.score_sketches(*tables(spark, d, "pages")), keys), keys, quantiles.SHARES)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.found(*tables(spark, d, "separators", "sections", "cargo_ref"))


def p6_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return canonical.unmatched(*tables(spark, d, "separators", "sections", "cargo_ref"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode(*tables(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leak.found(*tables(spark, d, "documents", "eval_items"))


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaked_items(*tables(spark, d, "documents", "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return harm.found(*tables(spark, d, "documents", "content_labels"))


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    return harm.scores(*tables(spark, d, "documents", "content_labels"))


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    return harm.rates(*tables(spark, d, "documents", "content_labels"))


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    """None: models, sketches, edit distances and tokenizers have no SQL, and the trigram query relies on hashes of one engine; see the tests."""
    return {}
