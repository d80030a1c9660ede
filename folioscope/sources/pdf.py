"""Files to page images: a partitioned source over (file, page) rows with a pluggable renderer."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "job_id bigint, doc_id string, page_number int, image_path string, failure string"


def page_name(page: int) -> str:
    return f"pagina_{page:04d}.png"


def poppler_renderer(dpi: int = 300) -> Callable[[str, int, str], bool]:
    """Renders by pdf2image where it is installed."""

    def render(pdf: str, page: int, target: str) -> bool:
        from pdf2image import convert_from_path  # optional

        images = convert_from_path(pdf, dpi=dpi, first_page=page, last_page=page)
        if images:
            images[0].save(target, "PNG")
        return bool(images)

    return render


def poppler_counter() -> Callable[[str], int]:
    """Counts a file's pages by pdf2image where it is installed."""

    def count(pdf: str) -> int:
        from pdf2image import pdfinfo_from_path  # optional

        return int(pdfinfo_from_path(pdf)["Pages"])

    return count


def requests(jobs: DataFrame, counter: Callable[[], Callable[[str], int]]) -> DataFrame:
    """(job_id, doc_id, pdf_path, output_dir, page_number, failure) of every page that jobs ask for.

    A null or empty list asks for all pages, which ``counter`` counts; a page
    asked for twice comes twice. A file that is missing, or whose pages can't
    be counted, has one row with its failure and no page.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = None
        for b in batches:
            rows = []
            for job, doc, pdf, out, pages in zip(b["job_id"], b["doc_id"], b["pdf_path"], b["output_dir"], b["pages"]):
                try:
                    if not os.path.exists(pdf):
                        raise FileNotFoundError(pdf)
                    if pages is None or not len(pages):
                        count = count or counter()
                        pages = range(1, count(pdf) + 1)
                    rows += [(job, doc, pdf, out, int(p), None) for p in sorted(pages)]
                except Exception as e:  # noqa: BLE001
                    rows.append((job, doc, pdf, out, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["job_id", "doc_id", "pdf_path", "output_dir", "page_number", "failure"]).astype({"page_number": "Int32"})

    return jobs.select("job_id", "doc_id", "pdf_path", "output_dir", "pages").mapInPandas(run, "job_id bigint, doc_id string, pdf_path string, output_dir string, page_number int, failure string")


def checked(images: DataFrame, pdf: str) -> DataFrame:
    """The images of one file; raises FileNotFoundError for a missing file and RuntimeError if there is no image at all."""
    worst = images.agg(F.count_if(F.col("image_path").isNotNull()).alias("n"), F.min("failure").alias("failure"), F.bool_or(F.col("failure").startswith("FileNotFoundError")).alias("missing")).first()
    if worst.missing and not worst.n:
        raise FileNotFoundError(f"no such file: {pdf}")
    if not worst.n:
        raise RuntimeError(f"no page image of {pdf}: {worst.failure}")
    return images.where("image_path IS NOT NULL")


def render(requests: DataFrame, factory: Callable[[], Callable[[str, int, str], bool]], keep_failures: bool = False) -> DataFrame:
    """One image per requested page (job_id, doc_id, pdf_path, output_dir, page_number).

    Pages are spread over tasks, so one large file is rendered by many. A page
    that fails or is empty is skipped, or kept with its failure; a file that is
    missing fails each of its pages. ``output_dir`` must be a shared folder.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        draw = factory()
        for b in batches:
            rows = []
            for job, doc, pdf, out, page in zip(b["job_id"], b["doc_id"], b["pdf_path"], b["output_dir"], b["page_number"]):
                target = os.path.join(out, "pages", page_name(int(page)))
                try:
                    if not os.path.exists(pdf):
                        raise FileNotFoundError(pdf)
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    failure = None if draw(pdf, int(page), target) else "empty page"
                except Exception as e:  # noqa: BLE001
                    failure = f"{type(e).__name__}: {e}"
                rows.append((job, doc, page, None if failure else target, failure))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    known = requests.where("page_number IS NOT NULL")
    lost = requests.where("page_number IS NULL").select("job_id", "doc_id", "page_number", F.lit(None).cast("string").alias("image_path"), "failure") if "failure" in requests.columns else None
    n = max(1, requests.sparkSession.sparkContext.defaultParallelism)
    out = known.select("job_id", "doc_id", "pdf_path", "output_dir", "page_number").repartition(n, "doc_id", "page_number").mapInPandas(run, SCHEMA)
    out = out if lost is None else out.unionByName(lost)
    return out if keep_failures else out.where(F.col("failure").isNull())
