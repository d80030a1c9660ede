"""Whole flows: files to page rows, page rows to consolidated sections, with reports and a result file.

``documents`` and ``segment`` work on any number of files at once. The entry
points for one file (``process_document``, ``process_and_segment``, ``run_job``)
wire them to the reports; their files are read and written by the driver, so
they need the shared folder that the executors write images to.
"""

from __future__ import annotations

import json
import logging
import os
import shutil
import sys
import time
import traceback
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from folioscope.config import DEFAULT, Config
from folioscope.functions.text import post_number
from folioscope.operators import detect, pages as pg, segment as sg
from folioscope.session import cut

_log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Engines:
    """Factories of the models, each called once in a task: see ``models.stages`` and ``sources.pdf`` for what they return.

    ``classify`` may be left out; candidates are then judged by similarity only.
    ``calls`` bounds the number of models at work, ``pause`` is the time between retries.
    """

    count: Callable[[], Callable[[str], int]]
    render: Callable[[], Callable[[str, int, str], bool]]
    first: Callable[[], Callable[[str, int], dict]]
    second: Callable[[], Callable[[str, int, int], str]]
    classify: Callable[[], Callable[[str, int], str]] | None = None
    calls: int | None = None
    pause: float = 2.0


@dataclass(frozen=True)
class Document:
    """One processed file: its page rows (written, not computed again), its summary row and its folder."""

    doc_id: str
    pdf_path: str
    pages: DataFrame
    summary: Row
    folder: str


def route_and_override(first: DataFrame, second_pass, config: Config = DEFAULT) -> DataFrame:
    """First-pass rows, with those that need it read again by ``second_pass(rows)``.

    The first pass is written before it is split, so that no model runs twice.
    Columns that the second pass doesn't give hold what is said of pages
    without recognition scores: no scores, no counts, no angle, no table.
    """
    from folioscope.models.stages import DEFAULTS

    first = cut(first)
    routed = first.where(pg.needs_second_pass(config)).withColumn("fallback_reason", pg.second_pass_reason(config))
    again = second_pass(routed)
    for f in first.schema.fields:
        if f.name not in again.columns:
            value = F.array() if f.dataType.typeName() == "array" else F.lit(DEFAULTS.get(f.name))
            again = again.withColumn(f.name, value.cast(f.dataType))
    return pg.override(first, again.select(*first.columns))


def documents(jobs: DataFrame, engines: Engines, config: Config = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Page rows of the pages that jobs (``sources.jobs.SCHEMA``) ask for, and the rows of pages and files that gave no image."""
    from folioscope.models import stages
    from folioscope.sources import pdf

    images = cut(pdf.render(pdf.requests(jobs, engines.count), engines.render, keep_failures=True))
    pages = stages.read_page(images.where("failure IS NULL"), engines.first, engines.second, config, engines.calls, engines.pause)
    return cut(pages), images.where("failure IS NOT NULL")


def raw_sections(pages: DataFrame, replies: DataFrame, config: Config = DEFAULT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sections before consolidation, their pages (doc_id, section_index, page_number), and all judged candidates, of page rows and classifier replies."""
    pages = pg.latest(pages)
    judged = cut(detect.evaluate(pages.where(detect.is_candidate(F.col("lines"), config)), replies, config))
    yes, no = judged.where("es_separadora"), judged.where("NOT es_separadora")
    rows = cut(sg.marked(pages.select(*pg.KEYS, detect.is_delimiter(F.col("lines"), config).alias("is_delimiter")), yes, no))
    roles = yes.select("doc_id", F.col("page_number").alias("separator_page"), F.col("cargo_normalizado").alias("cargo"), F.col("cargo_detectado").alias("cargo_raw"))
    own = sg.section_pages(rows, config=config)
    tabled = pages.select("doc_id", "page_number", F.coalesce("tiene_tabla", F.lit(False)).alias("t"))
    has = own.join(tabled, pg.KEYS).groupBy("doc_id", "section_index").agg(F.bool_or("t").alias("has_tables"))
    blocks = sg.sections(rows, config=config).join(roles, ["doc_id", "separator_page"]).join(has, ["doc_id", "section_index"], "left")
    blocks = blocks.withColumn("has_tables", F.coalesce("has_tables", F.lit(False))).withColumn("numero", post_number(F.col("cargo")))
    return cut(blocks), own, judged


def segment(pages: DataFrame, replies: DataFrame, config: Config = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Consolidated sections, and the discarded candidates, of page rows and recorded classifier replies."""
    blocks, _, judged = raw_sections(pages, replies, config)
    return sg.consolidate(blocks), judged.where("NOT es_separadora")


def consolidated_pages(blocks: DataFrame, own: DataFrame, consolidated: DataFrame) -> DataFrame:
    """(doc_id, section_index, page_number) of consolidated sections: the pages of all their blocks."""
    from folioscope.functions.text import group_key

    keys = blocks.select("doc_id", F.col("section_index").alias("block"), group_key(F.coalesce("cargo", F.lit(""))).alias("key"))
    index = consolidated.select("doc_id", "key", "section_index")
    return own.withColumnRenamed("section_index", "block").join(keys, ["doc_id", "block"]).join(index, ["doc_id", "key"]).select("doc_id", "section_index", "page_number")


# ------------------------------------------------------- one file


def _images_of(spark: SparkSession, pdf_path: str, pages: Sequence[int] | None, folder: str, engines: Engines) -> DataFrame:
    from folioscope.sources import jobs as job_source, pdf

    job = spark.createDataFrame([(0, Path(pdf_path).stem, None, pdf_path, list(pages) if pages else None, folder, None)], job_source.SCHEMA)
    return pdf.checked(cut(pdf.render(pdf.requests(job, engines.count), engines.render, keep_failures=True)), pdf_path)


def _best_effort(what: str, write: Callable[[], object]) -> None:
    try:
        write()
    except Exception as e:  # noqa: BLE001 - a report that fails is no failure of the flow
        _log.warning("%s: %s", what, e)


def _read(spark, pdf_path, pages, output_dir, engines, config, now, save_reports) -> Document:
    from folioscope.models import stages
    from folioscope.sinks import reports

    began, doc_id = time.monotonic(), Path(pdf_path).stem
    folder = str(Path(output_dir) / doc_id)
    images = _images_of(spark, pdf_path, pages, folder, engines)
    rows = cut(stages.read_page(images, engines.first, engines.second, config, engines.calls, engines.pause))
    summary = pg.documents(rows, config).first()
    doc = Document(doc_id, pdf_path, rows, Row(**(summary.asDict() | {"tiempo_total": time.monotonic() - began})), folder)
    if save_reports:
        _best_effort("document report", lambda: reports.write_document_report(rows, doc_id, folder, now or datetime.now(), pdf_path, doc.summary.tiempo_total))
    return doc


def _drop_images(folder: str, keep_images: bool) -> None:
    if not keep_images:
        shutil.rmtree(os.path.join(folder, "pages"), ignore_errors=True)


def process_document(spark: SparkSession, pdf_path: str, pages: Sequence[int] | None = None, output_dir: str = "output", keep_images: bool = False, *, engines: Engines, config: Config = DEFAULT, now: datetime | None = None, save_reports: bool = True) -> Document:
    """Reads one file: images, first pass, second pass where needed, summary, reports; images are removed unless they are to be kept.

    Raises FileNotFoundError for a missing file and RuntimeError if no page
    gives an image. A page whose model fails is an error row.
    """
    doc = _read(spark, str(pdf_path), pages, output_dir, engines, config, now, save_reports)
    _drop_images(doc.folder, keep_images)
    return doc


def process_and_segment(spark: SparkSession, pdf_path: str, pages: Sequence[int] | None = None, output_dir: str = "output", keep_images: bool = False, *, engines: Engines, config: Config = DEFAULT, now: datetime | None = None, save_reports: bool = True) -> tuple[Document, DataFrame, DataFrame]:
    """``process_document``, then sections and their consolidation with reports.

    Gives the document, its consolidated sections, and the sections' pages
    (section_index, page_number). The images stay until the classifier has
    seen the candidates, so that it can read them whether they are kept or not.
    """
    from folioscope.models import stages
    from folioscope.sinks import reports

    doc = _read(spark, str(pdf_path), pages, output_dir, engines, config, now, save_reports)
    try:
        if engines.classify is None:
            replies = spark.createDataFrame([], "doc_id string, page_number int, raw_reply string")
        else:
            replies = cut(stages.classify(doc.pages.where(detect.is_candidate(F.col("lines"), config)), engines.classify, engines.calls))
        blocks, own, judged = raw_sections(doc.pages, replies, config)
    finally:
        _drop_images(doc.folder, keep_images)
    consolidated = cut(sg.consolidate(blocks))
    section_pages = cut(consolidated_pages(blocks, own, consolidated))
    if save_reports:
        at = now or datetime.now()
        _best_effort("segmentation report", lambda: reports.write_segmentation(consolidated, section_pages, doc.pages, judged, doc.doc_id, doc.folder, at, doc.pdf_path))
        _best_effort("consolidation report", lambda: reports.write_consolidation(consolidated, section_pages, doc.pages, doc.doc_id, doc.folder, at, doc.pdf_path))
    return doc, consolidated, section_pages


def run_job(spark: SparkSession, job_path: str, result_path: str, engines: Engines, config: Config = DEFAULT) -> int:
    """Runs the job of one JSON file (``pdf_path``, optional ``mode``, ``pages``, ``output_dir``, ``keep_images``) and writes its result as JSON; 0, or 1 after a failure, whose trace is printed."""
    from folioscope.sinks import reports

    try:
        job = json.loads(Path(job_path).read_text(encoding="utf-8"))
        mode = job.pop("mode", None) or "segmentation"
        if mode == "ocr_only":
            doc = process_document(spark, engines=engines, config=config, **job)
            reports.write_result(doc, None, None, result_path)
        else:
            doc, sections, section_pages = process_and_segment(spark, engines=engines, config=config, **job)
            reports.write_result(doc, sections, section_pages, result_path)
        print(reports.console_summary(doc, None if mode == "ocr_only" else sections))
        return 0
    except Exception:  # noqa: BLE001
        traceback.print_exc(file=sys.stderr)
        return 1
