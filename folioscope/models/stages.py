"""Pluggable model calls over pages, one model per task, errors kept as rows.

A model is given by a factory that runs once in each task (weights, clients)
and returns a function of one page. The image must be readable by the
executors. Recorded output replaces a model by a join.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAW = "doc_id string, page_number int, image_path string, rec_texts array<string>, rec_scores array<double>, dt_polys array<array<array<int>>>, angle int, failure string, seconds double"
TEXT = "doc_id string, page_number int, image_path string, engine_used string, fallback_reason string, text string, lines array<string>, tiempo_paddle double, tiempo_qwen double, tiempo_total double"
#: What a row of the second pass, or of a failure, holds in the other columns of a page.
DEFAULTS = {"lineas_baja_confianza": 0, "det_count": 0, "rec_count": 0, "tasa_descarte": 0.0, "angle_detected": 0, "tiene_tabla": False}


def image_payload(image: bytes, most: int | None = None, share: float | None = None) -> str:
    """An image as base64 text of a PNG, no side longer than ``most`` pixels, or both sides by ``share``; needs an image library where the model is called."""
    import base64
    import io

    from PIL import Image  # optional

    with Image.open(io.BytesIO(image)) as held:
        width, height = held.size
        if share is not None:
            held = held.resize((max(1, int(width * share)), max(1, int(height * share))), Image.LANCZOS)
        elif most is not None and max(width, height) > most:
            held.thumbnail((most, most), Image.LANCZOS)
        out = io.BytesIO()
        held.save(out, format="PNG", optimize=True)
    return base64.b64encode(out.getvalue()).decode("ascii")


def recognise(pages: DataFrame, factory: Callable[[], Callable[[str, int], dict]], calls: int | None = None) -> DataFrame:
    """First pass: raw recognition results; a failing page keeps its row with ``failure``.

    ``calls`` bounds the number of tasks, and so of models, at work. Write the
    result before it is used twice, or the model runs again for each use.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for b in batches:
            rows = []
            for doc, page, path in zip(b["doc_id"], b["page_number"], b["image_path"]):
                began = time.monotonic()
                try:
                    r, failure = model(path, page) or {}, None
                except Exception as e:  # noqa: BLE001 - any failure of a model is a row
                    r, failure = {}, f"paddle_exception: {e}"
                rows.append((doc, page, path, r.get("rec_texts") or [], r.get("rec_scores") or [], r.get("dt_polys") or [], int((r.get("doc_preprocessor_res") or {}).get("angle", 0)), failure, time.monotonic() - began))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RAW.split(", ")])

    source = pages.select("doc_id", "page_number", "image_path")
    return (source.repartition(calls) if calls else source).mapInPandas(run, RAW)


def read_again(pages: DataFrame, factory: Callable[[], Callable[[str, int, int], str]], sizes: tuple[int, ...] = (2048, 1024, 768), pause: float = 2.0, calls: int | None = None) -> DataFrame:
    """Second pass: plain text of a page by a vision model, with smaller images on each retry.

    Replies lose their thoughts and blank lines. After the last failure the
    page becomes an error row: ``qwen_image_read_error`` for a file that can't
    be read, ``qwen_api_error`` for a failed call, ``qwen_exception`` for
    anything else (a model that can't be made, a reply that is no text).
    ``tiempo_paddle`` is carried on from the first pass if it is there.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, broken = None, None
        try:
            model = factory()
        except Exception as e:  # noqa: BLE001
            broken = f"qwen_exception: {e}"
        for b in batches:
            rows = []
            for doc, page, path, reason, before in zip(b["doc_id"], b["page_number"], b["image_path"], b["fallback_reason"], b["tiempo_paddle"]):
                began, lines, failure = time.monotonic(), [], broken
                for i, size in enumerate(sizes if broken is None else ()):
                    try:
                        reply = model(path, page, size)
                    except OSError as e:
                        failure = f"qwen_image_read_error: {e}"
                        break
                    except Exception as e:  # noqa: BLE001
                        failure = f"qwen_api_error: {e}"
                        if i + 1 < len(sizes):
                            time.sleep(pause)
                        continue
                    try:
                        lines, failure = [x for x in reply.rsplit("</think>", 1)[-1].strip().splitlines() if x.strip()], None
                    except Exception as e:  # noqa: BLE001
                        failure = f"qwen_exception: {e}"
                    break
                took = time.monotonic() - began
                rows.append((doc, page, path, "error", failure, "", [], None, None, 0.0) if failure else (doc, page, path, "qwen", reason, "\n".join(lines), lines, before, took, took))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in TEXT.split(", ")])

    before = F.col("tiempo_paddle") if "tiempo_paddle" in pages.columns else F.lit(None)
    source = pages.select("doc_id", "page_number", "image_path", "fallback_reason", before.cast("double").alias("tiempo_paddle"))
    return (source.repartition(calls) if calls else source).mapInPandas(run, TEXT)


def classify(pages: DataFrame, factory: Callable[[], Callable[[str, int], str]], calls: int | None = None) -> DataFrame:
    """Raw replies of a classifier (doc_id, page_number, raw_reply, failure).

    The reply is null where the call failed; ``failure`` says whether the image
    could not be read (``image_read_error``) or the call failed (``api_error``).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for b in batches:
            rows = []
            for path, page in zip(b["image_path"], b["page_number"]):
                try:
                    rows.append((model(path, page), None))
                except OSError as e:
                    rows.append((None, f"image_read_error: {e}"))
                except Exception as e:  # noqa: BLE001
                    rows.append((None, f"api_error: {e}"))
            yield pd.DataFrame({"doc_id": b["doc_id"], "page_number": b["page_number"], "raw_reply": [r for r, _ in rows], "failure": [f for _, f in rows]})

    source = pages.select("doc_id", "page_number", "image_path")
    return (source.repartition(calls) if calls else source).mapInPandas(run, "doc_id string, page_number int, raw_reply string, failure string")


def recorded(pages: DataFrame, results: DataFrame) -> DataFrame:
    """Recorded results of these pages, in place of a model."""
    return results.join(pages.select("doc_id", "page_number").distinct(), ["doc_id", "page_number"], "left_semi").withColumn("replayed", F.lit(True))


def read_page(pages: DataFrame, first: Callable[[], Callable[[str, int], dict]], second: Callable[[], Callable[[str, int, int], str]], config=None, calls: int | None = None, pause: float = 2.0) -> DataFrame:
    """Both passes as one flow: recognise, decide by the page's metrics, read again where needed; page rows with all columns.

    The first pass is written before it is split; see ``process.route_and_override``.
    """
    from folioscope.config import DEFAULT
    from folioscope.operators import pages as pg
    from folioscope.plans import process

    config = config or DEFAULT
    rows = pg.from_recognition(recognise(pages, first, calls), config)
    return process.route_and_override(rows, lambda routed: read_again(routed, second, pause=pause, calls=calls), config)


def layout(pages: DataFrame, factory: Callable[[], Callable[[str], dict]]) -> DataFrame:
    """A model's description of each page's layout as JSON text, with its tokens and seconds; null where it failed."""
    import json

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for b in batches:
            rows = []
            for doc, page, path in zip(b["doc_id"], b["page_number"], b["image_path"]):
                began = time.monotonic()
                try:
                    r = model(path)
                    rows.append((doc, page, json.dumps(r, ensure_ascii=False), r.get("completion_tokens"), time.monotonic() - began))
                except Exception:  # noqa: BLE001
                    rows.append((doc, page, None, None, time.monotonic() - began))
            yield pd.DataFrame(rows, columns=["doc_id", "page_number", "layout", "tokens", "seconds"]).astype({"tokens": "Int64"})

    return pages.select("doc_id", "page_number", "image_path").mapInPandas(run, "doc_id string, page_number int, layout string, tokens bigint, seconds double")
