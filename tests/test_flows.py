from datetime import datetime

from pyspark.sql import functions as F

import __spark_entry__ as entry
from folioscope.models import stages
from folioscope.operators import pages as pg
from folioscope.plans import process
from folioscope.sinks import reports
from folioscope.sources import jobs, pdf, recognition
from folioscope.streaming import pages as stream

COLUMNS = "doc_id string, page_number int, image_path string"


def test_recognise_route_read_again(spark):
    pages = spark.createDataFrame([("d", 1, "p1"), ("d", 2, "p2"), ("d", 3, "p3")], COLUMNS)

    def factory():
        def model(path, page):
            if page == 3:
                raise RuntimeError("sin imagen")
            return {"rec_texts": [f"línea {i}" for i in range(16)], "rec_scores": [0.5 if page == 2 else 0.95] * 16, "dt_polys": [[[0, 0]]] * (40 if page == 2 else 16), "doc_preprocessor_res": {"angle": 0}}

        return model

    raw = stages.recognise(pages, factory)
    assert raw.where("failure IS NOT NULL").select("page_number", "failure").first() == (3, "paddle_exception: sin imagen")
    first = pg.from_recognition(raw)

    def second_pass(routed):
        return stages.read_again(routed, lambda: lambda path, page, size: "<think>x</think>\nuno\n\ndos\n")

    done = {r.page_number: r for r in process.route_and_override(first, second_pass).collect()}
    assert (done[1].engine_used, done[2].engine_used, done[3].engine_used) == ("paddle", "qwen", "error")
    assert done[2].lines == ["uno", "dos"] and done[2].conf_promedio is None


def test_retries_end_in_an_error_row(spark):
    pages = spark.createDataFrame([("d", 1, "p", "r"), ("d", 2, "q", "r")], COLUMNS + ", fallback_reason string")

    def factory():
        def model(path, page, size):
            if page == 2:
                raise OSError("rota")
            if size > 1024:
                raise RuntimeError("ocupado")
            return "texto"

        return model

    r = {x.page_number: x for x in stages.read_again(pages, factory, pause=0.0).collect()}
    assert r[1].text == "texto" and r[1].fallback_reason == "r" and r[2].fallback_reason == "qwen_image_read_error: rota"


def test_classify_and_recorded(spark):
    pages = spark.createDataFrame([("d", 1, "a"), ("d", 2, "b")], COLUMNS)
    replies = stages.classify(pages, lambda: lambda path, page: "{}" if page == 1 else 1 / 0)
    assert {(r.page_number, r.raw_reply, r.failure) for r in replies.collect()} == {(1, "{}", None), (2, None, "api_error: division by zero")}
    assert stages.recorded(pages.limit(1), replies).count() == 1


def test_segment_flow_and_reports(spark, tmp_path):
    schema = COLUMNS + ", engine_used string, fallback_reason string, text string, lines array<string>, line_scores array<double>, conf_promedio double, conf_mediana double, conf_min double, conf_max double, lineas_baja_confianza int, tasa_descarte double, angle_detected int, tiene_tabla boolean, tiempo_total double, ingested_at timestamp"
    make = lambda p, text, tabled=False: ("d", p, f"pagina_{p:04d}.png", "paddle", None, text, text.split("\n"), [0.8] * len(text.split("\n")), 0.8, 0.8, 0.8, 0.8, 1, 0.1, 0, tabled, 1.0, datetime(2025, 1, p))
    pages = spark.createDataFrame([make(1, "Gerente de Contrato"), make(2, "cuerpo", True), make(3, "Jefe de Supervisión"), make(4, "más | texto"), make(5, "Gerente de Contrato"), make(6, "fin")], schema)
    replies = spark.createDataFrame([], "doc_id string, page_number int, raw_reply string")
    sections, discarded = process.segment(pages, replies)
    blocks, own, judged = process.raw_sections(pages, replies)
    section_pages = process.consolidated_pages(blocks, own, sections)
    r = {x.cargo: x for x in sections.collect()}
    assert r["Gerente De Contrato"].n_blocks == 2 and r["Gerente De Contrato"].has_tables and r["Gerente De Contrato"].total_pages == 4
    assert discarded.count() == 0
    now = datetime(2025, 1, 2, 3, 4, 5)
    assert "0.800" in reports.write_metrics(pages, "d", str(tmp_path), now).read_text()
    assert "## Página 6" in reports.write_text(pages, "d", str(tmp_path), now).read_text()
    assert "Tipo B" in (text := reports.write_consolidation(sections, section_pages, pages, "d", str(tmp_path), now).read_text()) and "1–2 · 5–6" in text
    assert "_Página 2:_\n```\ncuerpo\n```" in text and "_Página 1:_" not in text and "- Bloque 2: páginas 5–6" in text
    text = reports.write_segmentation(sections, section_pages, pages, judged, "d", str(tmp_path), now).read_text()
    assert "| Candidatas evaluadas | 2 |" in text and "| Separadoras aceptadas | 3 |" in text and "_... 1 páginas más_" in text and "**Página 4:**\n\n```\nmás | texto\n```" in text
    none = reports.write_segmentation(sections.limit(0), section_pages.limit(0), pages, judged.limit(0), "d", str(tmp_path), now).read_text()
    assert "No se detectaron separadoras" in none and "## Secciones" not in none
    assert "Jefe De Supervisión" in reports.write_json(sections, "d", str(tmp_path / "r.json")).read_text()
    reports.write_all_json(sections, str(tmp_path / "all"))
    assert spark.read.json(str(tmp_path / "all")).count() == 2


def test_lines_layout_and_fused_flow(spark, tmp_path):
    raw = spark.createDataFrame([("d", 1, ["a", "b"], ["0.9", "x"], [90], [[[1, 2], [3, 4]]])], "doc_id string, page_number int, rec_texts array<string>, rec_scores array<string>, angles array<int>, polys array<array<array<int>>>")
    r = pg.line_table(raw).orderBy("line_no").collect()
    assert [(x.line_no, x.text, x.score, x.angle, x.polygon, x.status) for x in r] == [(1, "a", 0.9, "90", "(1,2) → (3,4)", "ok"), (2, "b", None, "N/A", None, "warn")]
    pages = spark.createDataFrame([("d", 1, "a"), ("d", 2, "b")], COLUMNS)
    first = lambda: lambda path, page: {"rec_texts": ["x"] * 16, "rec_scores": [0.2] * 16, "dt_polys": [[[0, 0]]] * 40} if page == 1 else 1 / 0
    done = stages.read_page(pages, first, lambda: lambda path, page, size: "leído")
    assert {(x.page_number, x.engine_used, x.text) for x in done.collect()} == {(1, "qwen", "leído"), (2, "error", "")}
    assert done.where("page_number = 2").first().fallback_reason.startswith("paddle_exception:")
    lay = stages.layout(pages, lambda: lambda path: {"tipo": "tabla", "completion_tokens": 7} if path == "a" else 1 / 0)
    assert {(x.page_number, x.tokens) for x in lay.select("page_number", "tokens", pg.throughput(F.col("tokens"), F.col("seconds"))).collect()} == {(1, 7), (2, None)}
    assert {x.page_number for x in pg.documents(done).select("total_pages", F.lit(1).alias("page_number")).collect()} == {1} and reports.write_document_report(done, "d", str(tmp_path), datetime(2025, 1, 2))[0].read_text().count("🔴") == 2
    metrics = spark.createDataFrame([("d", 1, [0.9, 0.4], 0.65, 0.1, 1, 2, 90)], "doc_id string, page_number int, line_scores array<double>, conf_promedio double, tasa_descarte double, lineas_baja_confianza int, rec_count int, angle_detected int")
    text = reports.write_analysis(metrics, pg.line_table(raw), "d", str(tmp_path), datetime(2025, 1, 2)).read_text()
    assert "reroute" in text and "50.0" in text and "(1,2) → (3,4)" in text


def test_jobs_and_pdf(spark, tmp_path):
    p = spark.createDataFrame([("d", 1, "a"), ("d", 2, "b")], "doc_id string, page_number int, x string")
    j = spark.createDataFrame([(1, "d", "", [2, 2, 9], None), (2, "d", None, [], True), (3, "d", "ocr_only", None, None)], "job_id long, doc_id string, mode string, pages array<int>, keep_images boolean").withColumn("pdf_path", F.lit("/x/y.z.pdf"))
    assert sorted((r.job_id, r.page_number) for r in jobs.requested(j, p).collect()) == [(1, 2), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2)]
    assert [(r.mode, r.keep_images, r.stem) for r in jobs.modes(j).orderBy("job_id").collect()] == [("segmentation", False, "y.z"), ("segmentation", True, "y.z"), ("ocr_only", False, "y.z")]
    (tmp_path / "f.pdf").write_text("x")
    req = spark.createDataFrame([(1, "d", str(tmp_path / "f.pdf"), str(tmp_path), 3), (1, "d", str(tmp_path / "f.pdf"), str(tmp_path), 1), (1, "e", "/none.pdf", str(tmp_path), 1)], "job_id long, doc_id string, pdf_path string, output_dir string, page_number int")
    draw = lambda: lambda pdf, page, target: bool(open(target, "w").write("i")) if page != 1 else False  # noqa: E731, SIM115
    assert [r.image_path.rsplit("/", 1)[1] for r in pdf.render(req, draw).collect()] == ["pagina_0003.png"]
    assert pdf.render(req, draw, keep_failures=True).where("failure LIKE 'FileNotFoundError%'").count() == 1
    (tmp_path / "raw.json").write_text('{"doc_id":"d","page_number":1,"rec_texts":["a"],"rec_scores":[0.5]}\n{"doc_id":"d","page_number":2}\n')
    assert sorted((r.page_number, r.angle, r.rec_scores) for r in recognition.read_json(spark, str(tmp_path / "raw.json")).collect()) == [(1, 0, ["0.5"]), (2, 0, [])]
    (tmp_path / "job.json").write_text('[{"job_id":7,"pages":[1]}]')
    assert jobs.read_json(spark, str(tmp_path / "job.json")).first().job_id == 7


def test_stream(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    seen = []
    q = stream.per_batch(stream.annotated(stream.read(spark, "/root/testdata/sf0.001/pages.parq*", source.schema)), lambda b, i: seen.append((b.count(), b.where("is_candidate").count())), str(tmp_path / "c"))
    q.awaitTermination(120)
    n = source.select("doc_id", "page_number").distinct().count()
    assert sum(a for a, _ in seen) == n and sum(b for _, b in seen) > 0
    assert stream.confidence_by_window(source).agg(F.sum("n_pages")).first()[0] == source.count()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def engines(image_text, classify=None):
    def first():
        def model(path, page):
            lines = image_text[page].split("\n")
            return {"rec_texts": lines, "rec_scores": [0.5 if page == 4 else 0.95] * len(lines), "dt_polys": [[[0, 0]]] * (40 if page == 4 else len(lines))}

        return model

    draw = lambda: lambda pdf, page, target: bool(open(target, "w").write("i"))  # noqa: E731, SIM115
    return process.Engines(lambda: lambda pdf: len(image_text), draw, first, lambda: lambda path, page, size: "leído de nuevo", classify, pause=0.0)


PAGES = {1: "Gerente de Contrato", 2: "cuerpo\ndos", 3: "Jefe de Supervisión", 4: "\n".join(f"renglón {i} del acta" for i in range(20)), 5: "CALIDAD\nGESTIÓN DE CALIDAD", 6: "suelta"}


def test_process_one_file_to_its_result(spark, tmp_path):
    import json

    (tmp_path / "entrada.pdf").write_text("x")
    seen = lambda: lambda path, page: open(path).read() and '{"es_separadora": true, "cargo": "Jefe de supervicion", "confianza": "alta"}' if page == 3 else 1 / 0  # noqa: E731, SIM115
    job = {"pdf_path": str(tmp_path / "entrada.pdf"), "output_dir": str(tmp_path / "out")}
    (tmp_path / "job.json").write_text(json.dumps(job))
    assert process.run_job(spark, str(tmp_path / "job.json"), str(tmp_path / "r.json"), engines(PAGES, seen)) == 0
    r = json.loads((tmp_path / "r.json").read_text())
    assert r["mode"] == "segmentation" and (r["doc"]["total_pages"], r["doc"]["pages_paddle"], r["doc"]["pages_qwen"]) == (6, 5, 1)
    assert [(s["section_index"], s["cargo"], s["total_pages"], s["full_text"]) for s in r["secciones"]] == [(1, "Gerente De Contrato", 2, "Gerente de Contrato\n\ncuerpo\ndos"), (2, "Jefe De Supervisión", 2, "Jefe de Supervisión\n\nleído de nuevo")]
    kinds = {x.name.split("_")[1] for x in (tmp_path / "out" / "entrada").glob("*.md")}
    assert kinds == {"metricas", "texto", "segmentacion", "profesionales"} and not (tmp_path / "out" / "entrada" / "pages").exists()
    (tmp_path / "job.json").write_text(json.dumps(job | {"mode": "ocr_only", "pages": [2, 1], "keep_images": True}))
    assert process.run_job(spark, str(tmp_path / "job.json"), str(tmp_path / "r.json"), engines(PAGES)) == 0
    r = json.loads((tmp_path / "r.json").read_text())
    assert r["mode"] == "ocr_only" and r["full_text"] == "Gerente de Contrato\n\ncuerpo\ndos" and (tmp_path / "out" / "entrada" / "pages" / "pagina_0001.png").exists()


def test_missing_files_raise_and_fail_jobs(spark, tmp_path):
    import json

    import pytest

    with pytest.raises(FileNotFoundError):
        process.process_document(spark, str(tmp_path / "none.pdf"), output_dir=str(tmp_path), engines=engines(PAGES))
    (tmp_path / "empty.pdf").write_text("x")
    with pytest.raises(RuntimeError):
        process.process_document(spark, str(tmp_path / "empty.pdf"), output_dir=str(tmp_path), engines=engines({}))
    (tmp_path / "job.json").write_text(json.dumps({"pdf_path": str(tmp_path / "none.pdf")}))
    assert process.run_job(spark, str(tmp_path / "job.json"), str(tmp_path / "r.json"), engines(PAGES)) == 1
    rows = spark.createDataFrame([(1, "a", None, str(tmp_path / "empty.pdf"), [3, 1], str(tmp_path), None), (2, "b", None, str(tmp_path / "none.pdf"), None, str(tmp_path), None)], jobs.SCHEMA)
    pages, failed = process.documents(rows, engines(PAGES))
    assert sorted(r.page_number for r in pages.collect()) == [1, 3] and failed.first().failure.startswith("FileNotFoundError")


def test_second_pass_that_cannot_begin_is_an_error_row(spark):
    pages = spark.createDataFrame([("d", 1, "p", "r")], COLUMNS + ", fallback_reason string")
    assert stages.read_again(pages, lambda: 1 / 0).first().fallback_reason == "qwen_exception: division by zero"
    assert stages.read_again(pages, lambda: lambda path, page, size: None).first().fallback_reason.startswith("qwen_exception: ")


def test_small_files_are_spread_and_other_tables_left(spark, tmp_path):
    from folioscope.session import spread

    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    n = spark.sparkContext.defaultParallelism
    assert spread(spark.read.parquet(str(tmp_path / "one")).select("id")).rdd.getNumPartitions() == n
    made = spark.createDataFrame([(1,)], "a int")
    assert spread(made) is made
