"""Reports of one file as Markdown and JSON.

Tables are computed by Spark for all files; a report renders the rows of one
file, read partition by partition, on the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from folioscope.config import DEFAULT, Config
from folioscope.functions import text as tx
from folioscope.operators import pages as pg
from folioscope.operators import segment as sg

NOTHING = "—"


def _cell(x) -> str:
    return NOTHING if x is None or x == "" else str(x).replace("|", "\\|").replace("\n", " ").strip()


def _table(head: list[str], rows: Iterable[Iterable]) -> list[str]:
    return ["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *("| " + " | ".join(_cell(x) for x in r) + " |" for r in rows), ""]


def _number(x: float | None, digits: int) -> str | None:
    return None if x is None else f"{x:.{digits}f}"


def _percent(x: float | None) -> str:
    return f"{100 * (x or 0):.1f}%"


def _title(what: str, name: str, now: datetime, pdf_path: str | None) -> list[str]:
    return [f"# {what} — {name}", "", f"Fecha: {now:%Y-%m-%d %H:%M:%S}  ", f"Archivo: `{pdf_path or name}`", ""]


def _of(df: DataFrame, doc_id: str) -> DataFrame:
    return df.where(F.col("doc_id") == doc_id)


def write_document_report(pages: DataFrame, doc_id: str, folder: str, now: datetime, pdf_path: str | None = None, seconds: float | None = None, config: Config = DEFAULT) -> tuple[Path, Path]:
    """Both reports of a read file: its metrics and its text."""
    return write_metrics(pages, doc_id, folder, now, pdf_path, seconds, config), write_text(pages, doc_id, folder, now, pdf_path)


def _state(s: Row, config: Config) -> str:
    if s.status == "red":
        return f"🔴 {s.pages_error} páginas con error"
    return f"🟡 Confianza global baja ({s.conf_promedio_documento:.3f})" if s.status == "yellow" else "🟢 Procesamiento correcto"


def write_metrics(pages: DataFrame, doc_id: str, folder: str, now: datetime, pdf_path: str | None = None, seconds: float | None = None, config: Config = DEFAULT) -> Path:
    """Summary and state, error pages, pages read twice, every page's metrics, lines of low confidence, and the thresholds."""
    own = _of(pages, doc_id)
    s = pg.documents(own, config).first()
    out = _title("Métricas OCR", doc_id, now, pdf_path)
    if s is not None:
        rows = [("Total páginas", s.total_pages), ("Procesadas con Paddle", s.pages_paddle), ("Procesadas con Qwen (fallback)", s.pages_qwen), ("Páginas con error", s.pages_error), ("Confianza promedio del documento", _number(s.conf_promedio_documento, 4)), ("Tiempo total", f"{s.tiempo_total if seconds is None else seconds:.1f}s")]
        out += ["## Resumen global", "", *_table(["Métrica", "Valor"], rows), f"**Estado general:** {_state(s, config)}", ""]
    reasons = lambda engine, default: ((r.page_number, r.reason) for r in own.where(F.col("engine_used") == engine).orderBy("page_number").select("page_number", tx.or_default(F.col("fallback_reason"), default).alias("reason")).toLocalIterator())
    for title, engine, default, head in (("⚠️ Páginas con error", "error", "desconocido", "Razón"), ("Páginas procesadas con Qwen (fallback)", "qwen", "-", "Razón del fallback")):
        if rows := list(reasons(engine, default)):
            out += [f"## {title}", "", *_table(["Página", head], rows)]
    out += ["## Métricas por página", "", *_table(["#", "Engine", "Conf.Prom", "Mediana", "Mín", "Máx", "Descarte", "Ángulo", "Líneas bajas", "Estado"], _page_rows(own, config))]
    low = pg.low_lines(own, config).orderBy("page_number", "line_no").toLocalIterator()
    notes = {r.page_number: r.note for r in own.where((F.col("engine_used") == "paddle") & (F.col("lineas_baja_confianza") > 0)).orderBy("page_number").select("page_number", pg.low_note(config).alias("note")).toLocalIterator()}
    by: dict[int, list[tuple]] = {p: [] for p in notes}
    for r in low:
        by[r.page_number].append((r.line_no, _number(r.score, 4), r.line))
    if by:
        out += ["## Líneas con baja confianza por página", ""]
        for p, rows in by.items():
            out += [f"### Página {p}", "", *_table(["#", "Score", "Texto"], rows or [(None, None, notes[p])])]
    limits = [("Umbral de confianza promedio", config.least_confidence), ("Umbral de tasa de descarte", config.most_discard), ("Umbral de confianza de línea", config.least_confidence)]
    out += ["## Configuración", "", *_table(["Parámetro", "Valor"], limits)]
    return _written(folder, f"{doc_id}_metricas_{now:%Y%m%d_%H%M%S}.md", out)


def _page_rows(own: DataFrame, config: Config) -> Iterator[tuple]:
    sign = {"paddle": "🔵 paddle", "qwen": "🟠 qwen"}
    wanted = own.orderBy("page_number").select("page_number", "engine_used", "conf_promedio", "conf_mediana", "conf_min", "conf_max", "tasa_descarte", "angle_detected", "lineas_baja_confianza", pg.page_status(config).alias("status"))
    for r in wanted.toLocalIterator():
        if r.engine_used == "error":
            yield (r.page_number, "error", *[None] * 7, f"🔴 {r.status}")
        else:
            mark = "🟠 qwen" if r.engine_used != "paddle" else "🟢" if r.status == "ok" else f"🟡 {r.status}"
            scores = [_number(x, 4) for x in (r.conf_promedio, r.conf_mediana, r.conf_min, r.conf_max)]
            yield (r.page_number, sign.get(r.engine_used, r.engine_used), *scores, _percent(r.tasa_descarte), f"{r.angle_detected}°", r.lineas_baja_confianza, mark)


def write_text(pages: DataFrame, doc_id: str, folder: str, now: datetime, pdf_path: str | None = None) -> Path:
    """Every page's text; blank pages and error pages say so."""
    own = _of(pages, doc_id)
    s = own.agg(F.count("*").alias("n"), *[F.count_if(F.col("engine_used") == e).alias(e) for e in ("paddle", "qwen", "error")]).first()
    out = [*_title("Texto extraído", doc_id, now, pdf_path), f"Páginas: {s.n} | Paddle: {s.paddle} | Qwen: {s.qwen} | Error: {s.error}", "", "---", ""]
    for r in own.orderBy("page_number").select("page_number", "engine_used", pg.header_tags().alias("tags"), "text", tx.or_default(F.col("fallback_reason"), "desconocido").alias("reason")).toLocalIterator():
        out += [f"## Página {r.page_number}  _{r.tags}_", ""]
        if r.engine_used == "error":
            out += [f"> ⚠️ Error: {r.reason}", ""]
        elif not (r.text or "").strip():
            out += ["> _(página en blanco o sin texto reconocido)_", ""]
        else:
            out += ["```", r.text, "```", ""]
        out += ["---", ""]
    return _written(folder, f"{doc_id}_texto_{now:%Y%m%d_%H%M%S}.md", out)


def _previews(section_pages: DataFrame, pages: DataFrame, doc_id: str, n: int, length: int, sections: DataFrame | None = None) -> dict[int, list[Row]]:
    """Of each section the first pages with the beginning of their text; with ``sections`` content pages only."""
    rows = _of(section_pages, doc_id).join(_of(pages, doc_id).select("doc_id", "page_number", "engine_used", "text"), pg.KEYS)
    if sections is not None:
        rows = pg.content_pages(rows.join(sections.select("doc_id", "section_index", "separator_page"), ["doc_id", "section_index"]))
    first = pg.first_pages(rows.select("doc_id", "section_index", "page_number", "engine_used", tx.preview(F.col("text"), length, "  \n").alias("preview")), ["doc_id", "section_index"], n)
    out: dict[int, list[Row]] = {}
    for r in first.orderBy("section_index", "page_number").toLocalIterator():
        out.setdefault(r.section_index, []).append(r)
    return out


def _with_last(consolidated: DataFrame, section_pages: DataFrame, doc_id: str) -> list[Row]:
    last = _of(section_pages, doc_id).groupBy("section_index").agg(F.max("page_number").alias("last"))
    own = _of(consolidated, doc_id).join(last, "section_index", "left").orderBy("section_index")
    return list(own.select("section_index", "cargo", "cargo_raw", "numero", "separator_page", "total_pages", "has_tables", "n_blocks", "bloques_origen", "last").toLocalIterator())


def write_segmentation(consolidated: DataFrame, section_pages: DataFrame, pages: DataFrame, judged: DataFrame, doc_id: str, folder: str, now: datetime, pdf_path: str | None = None) -> Path:
    """Summary, sections, discarded candidates, and the beginning of each section's text; a warning where there is no section.

    The number of candidates counts consolidated sections, as the number of
    sections does; the separators found stand beside it.
    """
    rows = _with_last(consolidated, section_pages, doc_id)
    texts = _of(pages, doc_id).select("doc_id", "page_number", pg.line_count(F.col("lines")).alias("n_lines"), F.substring(F.coalesce("text", F.lit("")), 1, 80).alias("beginning"))
    lost = list(_of(judged, doc_id).where("NOT es_separadora").join(texts, pg.KEYS, "left").orderBy("page_number").select("page_number", "n_lines", "confianza_qwen", "metodo", "beginning").toLocalIterator())
    found = _of(judged, doc_id).where("es_separadora").count()
    summary = [("Total páginas", _of(pages, doc_id).count()), ("Candidatas evaluadas", len(rows) + len(lost)), ("Separadoras aceptadas", found), ("Profesionales detectados", len(rows)), ("Candidatas descartadas", len(lost))]
    out = [*_title("Segmentación", doc_id, now, pdf_path), "## Resumen", "", *_table(["Métrica", "Valor"], summary)]
    if not rows:
        out += ["> ⚠️ **No se detectaron separadoras.** Revise la estructura del documento o el número de líneas que puede tener una separadora.", ""]
    else:
        table = ((r.section_index, r.cargo, r.cargo_raw, r.separator_page, r.last, r.total_pages, "✓" if r.has_tables else None, None) for r in rows)
        out += ["## Secciones detectadas", "", *_table(["#", "Cargo", "Cargo raw", "Pág. inicio", "Pág. fin", "Total págs", "Tablas", "Método"], table)]
    if lost:
        out += ["## Candidatas descartadas", "", *_table(["Página", "Líneas", "Qwen conf", "Razón", "Texto (primeros 80 caracteres)"], (tuple(r) for r in lost))]
    if rows:
        first = _previews(section_pages, pages, doc_id, 3, 400)
        out += ["## Texto por sección", ""]
        for r in rows:
            out += [f"### {r.section_index}. {r.cargo}", "", f"_Páginas {r.separator_page}–{r.last if r.last is not None else '?'} · {r.total_pages} páginas_", ""]
            for p in first.get(r.section_index, []):
                out += [f"**Página {p.page_number}:** ⚠️ error", ""] if p.engine_used == "error" else [f"**Página {p.page_number}:**", "", "```", p.preview or "_(sin texto)_", "```", ""]
            if r.total_pages > 3:
                out += [f"_... {r.total_pages - 3} páginas más_", ""]
            out += ["---", ""]
    return _written(folder, f"{doc_id}_segmentacion_{now:%Y%m%d_%H%M%S}.md", out)


def write_consolidation(consolidated: DataFrame, section_pages: DataFrame, pages: DataFrame, doc_id: str, folder: str, now: datetime, pdf_path: str | None = None) -> Path:
    """Summary, the list of roles (with blocks for files of type B, with the last page for type A), and the details of each role."""
    rows = _with_last(consolidated, section_pages, doc_id)
    several, most = any(r.n_blocks > 1 for r in rows), max((r.n_blocks for r in rows), default=1)
    ranges = lambda r: [f"{b['start']}–{b['end']}" for b in r.bloques_origen]
    summary = [("Total profesionales", len(rows)), ("Tipo de documento", "Tipo B (bloques temáticos)" if several else "Tipo A (bloque único)"), *([("Bloques por profesional", most)] if several else []), ("Total páginas del documento", _of(pages, doc_id).count())]
    out = [*_title("Profesionales", doc_id, now, pdf_path), "## Resumen", "", *_table(["Métrica", "Valor"], summary), "## Lista de profesionales", ""]
    if several:
        out += _table(["#", "Cargo", "N°", "Págs totales", "Bloques", "Pág. inicio"], ((r.section_index, r.cargo, r.numero, r.total_pages, " · ".join(ranges(r)), r.separator_page) for r in rows))
    else:
        out += _table(["#", "Cargo", "Págs", "Pág. inicio", "Pág. fin"], ((r.section_index, r.cargo, r.total_pages, r.separator_page, r.last) for r in rows))
    out += ["## Detalle por profesional", ""]
    content = _previews(section_pages, pages, doc_id, 2, 300, consolidated)
    for r in rows:
        out += [f"### {r.section_index}. {r.cargo}" + (f" N°{r.numero}" if r.numero else ""), ""]
        if r.n_blocks > 1:
            out += ["**Bloques de origen:**", "", *(f"- Bloque {i}: páginas {x}" for i, x in enumerate(ranges(r), 1)), ""]
        out += [f"**Total páginas:** {r.total_pages}  ", f"**Página separadora:** {r.separator_page}", ""]
        if first := content.get(r.section_index):
            out += ["**Vista previa (primeras 2 páginas de contenido):**", ""]
            for p in first:
                out += [f"_Página {p.page_number}:_", "```", p.preview, "```", ""]
        out += ["---", ""]
    return _written(folder, f"{doc_id}_profesionales_{now:%Y%m%d_%H%M%S}.md", out)


def write_analysis(pages: DataFrame, lines: DataFrame, doc_id: str, folder: str, now: datetime, settings: dict[str, dict] | None = None, regions: DataFrame | None = None, config: Config = DEFAULT) -> Path:
    """The long analysis of one file in eleven parts, from page rows and the rows of ``line_table``.

    ``settings``: titles of groups of the recogniser's settings, each with its
    names and values. ``regions``: doc_id, page_number and ``polys``, all
    detected regions, also those without text.
    """
    own, rows = _of(pages, doc_id), _of(lines, doc_id)
    several = "det_count" in own.columns
    out = _title("Análisis OCR completo", doc_id, now, None)
    out += ["## 1. Configuración", ""]
    for title, values in (settings or {}).items():
        out += [f"### {title}", "", *_table(["Parámetro", "Valor"], values.items())]
    turned = own.orderBy("page_number").select("page_number", "angle_detected").toLocalIterator()
    out += ["## 2. Preprocesamiento", "", *_table(["Página", "Ángulo de rotación detectado", "Corrección aplicada"], ((r.page_number, f"{r.angle_detected}°", "Sí" if r.angle_detected else "No") for r in turned))]
    if several:
        counts = own.agg(F.sum("det_count").alias("det"), F.sum("rec_count").alias("rec")).first()
        share = (counts.det - counts.rec) / counts.det if counts.det else 0.0
        out += ["## 3. Detección y reconocimiento", "", *_table(["Métrica", "Valor"], [("Regiones detectadas", counts.det), ("Regiones reconocidas", counts.rec), ("Descartadas", f"{(counts.det or 0) - (counts.rec or 0)} ({_percent(share)})")])]
    scores = own.select(F.explode(pg.valid_scores(F.col("line_scores"))).alias("s"))
    m = scores.agg(F.avg("s").alias("mean"), F.median("s").alias("median"), F.min("s").alias("min"), F.max("s").alias("max"), F.stddev_pop("s").alias("std"), F.percentile("s", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.count_if(F.col("s") < config.least_confidence).alias("low"), F.count("*").alias("n")).first()
    names = [("Promedio", m["mean"]), ("Mediana", m["median"]), ("Mínimo", m["min"]), ("Máximo", m["max"]), ("Desviación estándar", m["std"]), *zip(("Q1 (25%)", "Q2 (50%)", "Q3 (75%)"), m.q or [None] * 3)]
    out += ["## 4. Estadísticas de confianza", "", *_table(["Métrica", "Valor"], [*((a, _number(b, 4)) for a, b in names), (f"Líneas bajo umbral ({config.least_confidence})", f"{m.low} ({_percent(m.low / m.n if m.n else 0)})")])]
    bins = pg.histogram(own, ["doc_id"], config).orderBy("low").toLocalIterator()
    upper = dict(zip(config.histogram, config.histogram[1:]))
    out += ["### Distribución", "", *_table(["Rango", "Líneas", "Porcentaje"], ((f"{r.low:.2f}–{upper[r.low]:.2f}", r.n, f"{r.percent:.1f}%") for r in bins))]
    angles = rows.where("angle <> 'N/A'").groupBy(F.col("angle").cast("int").alias("angle")).count().orderBy("angle").toLocalIterator()
    out += ["## 5. Orientación de líneas", "", *_table(["Ángulo", "Cantidad"], ((f"{r.angle}°", r["count"]) for r in angles))]
    ordered = lambda *c: rows.orderBy("page_number", "line_no").select("page_number", "line_no", *c).toLocalIterator()
    out += ["## 6. Texto reconocido", "", "```", *(r.text or "" for r in ordered("text")), "```", ""]
    out += ["## 7. Detalle línea por línea", "", *_table(["Página", "#", "Score", "Estado", "Ángulo", "Texto"], ((r.page_number, r.line_no, _number(r.score, 4), "✓" if r.status == "ok" else "⚠️", r.angle, r.text) for r in ordered("score", "status", "angle", "text")))]
    out += ["## 8. Cajas", "", *_table(["Página", "#", "x1,y1,x2,y2", "Texto"], ((r.page_number, r.line_no, r.box, r.text) for r in ordered("box", "text") if r.box))] if "box" in rows.columns else []
    out += ["## 9. Polígonos de reconocimiento", "", *_table(["Página", "#", "Puntos", "Texto"], ((r.page_number, r.line_no, r.polygon, r.text) for r in ordered("polygon", "text")))]
    if regions is not None:
        found = _of(regions, doc_id).select("page_number", F.posexplode("polys").alias("i", "poly")).orderBy("page_number", "i").select("page_number", "i", tx.polygon(F.col("poly")).alias("polygon"))
        out += ["## 10. Polígonos de detección, con los descartados", "", *_table(["Página", "#", "Puntos"], ((r.page_number, r.i + 1, r.polygon) for r in found.toLocalIterator()))]
    advice = own.orderBy("page_number").select("page_number", "conf_promedio", "tasa_descarte", pg.legacy_advice(config).alias("advice"), pg.low_share(config).alias("low")).toLocalIterator()
    fails = lambda bad: "No ⚠️" if bad else "Sí ✓"
    out += ["## 11. Recomendación", "", *_table(["Página", "Recomendación", "% bajas", "Confianza", f"≥ {config.least_confidence}", "Descarte", f"≤ {config.legacy_discard:.0%}"], ((r.page_number, r.advice, _number(r.low, 2), _number(r.conf_promedio, 4), fails((r.conf_promedio or 0) < config.least_confidence), _percent(r.tasa_descarte), fails((r.tasa_descarte or 0) > config.legacy_discard)) for r in advice))]
    low = rows.where(F.col("score") < config.least_confidence).orderBy("page_number", "line_no").toLocalIterator()
    out += ["### Líneas con baja confianza", "", *_table(["Página", "#", "Score", "Texto"], ((r.page_number, r.line_no, _number(r.score, 4), r.text) for r in low))]
    return _written(folder, f"{doc_id}_analisis_{now:%Y%m%d_%H%M%S}.md", out)


# ------------------------------------------------------- result files


def result_document(summary: DataFrame, parts: DataFrame) -> DataFrame:
    """One row per file with what its result holds: counts, confidence, time and whole text. ``parts``: ``texts_in_parts`` of the files' pages."""
    whole = parts.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "\n\n").alias("full_text"))
    return summary.select("doc_id", "total_pages", "pages_paddle", "pages_qwen", "pages_error", "conf_promedio_documento", "tiempo_total").join(whole, "doc_id", "left").withColumn("full_text", F.coalesce("full_text", F.lit("")))


def result_sections(consolidated: DataFrame, section_pages: DataFrame, pages: DataFrame) -> DataFrame:
    """One row per consolidated section: index, role, number of the post, pages and text."""
    parts = pg.texts_in_parts(section_pages.join(pages.select("doc_id", "page_number", "engine_used", "text"), pg.KEYS), False, ("doc_id", "section_index"))
    whole = parts.groupBy("doc_id", "section_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "\n\n").alias("full_text"))
    return consolidated.select("doc_id", "section_index", "cargo", "numero", "total_pages").join(whole, ["doc_id", "section_index"], "left").withColumn("full_text", F.coalesce("full_text", F.lit("")))


def write_result(doc, consolidated: DataFrame | None, section_pages: DataFrame | None, path: str) -> Path:
    """The result of one file as one JSON document: without sections its counts and text, with sections a block for the file and one for each section."""
    names = ("total_pages", "pages_paddle", "pages_qwen", "pages_error", "conf_promedio_documento", "tiempo_total")
    texts = pg.texts_in_parts(doc.pages, True).orderBy("part").select("text").toLocalIterator()
    block = {n: doc.summary[n] for n in names} | {"full_text": "\n\n".join(r.text for r in texts)}
    if consolidated is None:
        result = {"mode": "ocr_only", **block}
    else:
        sections = result_sections(consolidated, section_pages, doc.pages).orderBy("section_index").drop("doc_id").toLocalIterator()
        result = {"mode": "segmentation", "doc": block, "secciones": [r.asDict() for r in sections]}
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps(result, ensure_ascii=False), encoding="utf-8")
    return target


def write_json(consolidated: DataFrame, doc_id: str, path: str) -> Path:
    """The roles of one file as one JSON document, non-ASCII letters kept."""
    rows = _of(consolidated, doc_id).orderBy("section_index").select("section_index", "cargo", "numero", "separator_page", "total_pages").toLocalIterator()
    target = Path(path)
    target.write_text(json.dumps({"doc_id": doc_id, "profesionales": [r.asDict() for r in rows]}, ensure_ascii=False, indent=2), encoding="utf-8")
    return target


def write_all_json(consolidated: DataFrame, path: str) -> None:
    """All files' roles, written by the executors, one JSON object per role."""
    consolidated.write.mode("overwrite").json(path)


def console_summary(doc, consolidated: DataFrame | None = None) -> str:
    """A few lines for the console: pages by engine, confidence, time, and the roles found."""
    s = doc.summary
    out = [f"{doc.doc_id}: {s.total_pages} páginas (paddle {s.pages_paddle}, qwen {s.pages_qwen}, error {s.pages_error}), confianza {s.conf_promedio_documento:.3f}, {s.tiempo_total:.1f}s"]
    if consolidated is not None:
        rows = list(_of(consolidated, doc.doc_id).orderBy("section_index").select("section_index", "cargo", "total_pages", "separator_page").toLocalIterator())
        out += [f"Profesionales: {len(rows)}", *(f"{r.section_index:4d}. {r.cargo} ({r.total_pages} págs, desde pág {r.separator_page})" for r in rows)]
    return "\n".join(out)


def _written(folder: str, name: str, lines: list[str]) -> Path:
    target = Path(folder) / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return target
