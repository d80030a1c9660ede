import math

import pytest
from pyspark.sql import functions as F

from folioscope.operators import pages as pg

PAGE = "doc_id string, page_number int, engine_used string, fallback_reason string, text string, lines array<string>, conf_promedio double, lineas_baja_confianza int, tasa_descarte double, tiempo_total double, ingested_at timestamp"


def page(spark, rows):
    """rows: (page, engine, text, lines, conf, low, discard)"""
    return spark.createDataFrame([("d", p, e, None, t, ls, c, low, d, 1.0, None) for p, e, t, ls, c, low, d in rows], PAGE)


def test_recognition(spark):
    raw = spark.createDataFrame(
        [("d", 1, "a", ["Linea 1", " ", "Linea 3"], ["0.9", "0.7", "0.8"], [[[0, 0]]] * 3, 90), ("d", 2, "b", None, None, None, None), ("d", 3, "c", ["x", None, "y"], [], [[[0]]], 0), ("d", 4, "e", ["x", "y"], ["no", "0.5", "0.9"], [[[0]]], 0)],
        "doc_id string, page_number int, image_path string, rec_texts array<string>, rec_scores array<string>, dt_polys array<array<array<int>>>, angle int",
    )
    r = {x.page_number: x for x in pg.from_recognition(raw).collect()}
    assert r[1].text == "Linea 1\nLinea 3" and r[1].det_count == 3 and r[1].rec_count == 3 and r[1].angle_detected == 90
    assert (round(r[1].conf_promedio, 6), round(r[1].conf_mediana, 6), r[1].conf_min, r[1].conf_max, round(r[1].conf_std, 6), r[1].lineas_baja_confianza) == (0.85, 0.85, 0.8, 0.9, 0.05, 1)
    assert r[2].engine_used == "error" and r[2].fallback_reason == "paddle_empty_result" and r[2].conf_promedio is None and r[2].text == ""
    assert r[3].lines == ["x", "y"] and r[3].line_scores == [] and r[3].conf_std is None and r[3].tasa_descarte == -2.0
    assert r[4].line_scores == [0.0, 0.5]


@pytest.mark.parametrize("n,conf,discard,engine,expected", [(16, 0.84, 0.40, "paddle", True), (15, 0.84, 0.40, "paddle", False), (16, 0.95, 0.45, "paddle", False), (16, None, 0.45, "paddle", False), (16, 0.5, 0.9, "error", False), (16, 0.85, 0.40, "paddle", False), (16, 0.84, 0.35, "paddle", False)])
def test_route(spark, n, conf, discard, engine, expected):
    r = page(spark, [(1, engine, "", ["x"] * n, conf, 0, discard)]).select(pg.needs_second_pass().alias("y"), pg.second_pass_reason().alias("why")).first()
    assert r.y is expected and (r.why != "") is expected


def test_summary_and_texts(spark):
    p = page(spark, [(2, "qwen", "dos", [], None, 0, 0.0), (1, "paddle", "uno", [], 0.8, 0, 0.0), (3, "error", "", [], None, 0, 0.0), (4, "paddle", " ", [], None, 0, 0.0)])
    s = pg.documents(p).first()
    assert (s.total_pages, s.pages_paddle, s.pages_qwen, s.pages_error, round(s.conf_promedio_documento, 6), s.status) == (4, 2, 1, 1, 0.8, "red")
    assert pg.texts_in_parts(p, True).first().text == "uno\n\ndos\n\n "
    assert pg.texts_in_parts(p, False).first().text == "uno\n\ndos"
    assert pg.text_by_page(p).first().texts == {1: "uno", 2: "dos", 3: "", 4: " "}
    assert pg.documents(page(spark, [(1, "qwen", "x", [], None, 0, 0.0)])).first().conf_promedio_documento == 0.0


def test_override_keeps_rows_and_errors(spark):
    first = page(spark, [(1, "paddle", "a", [], 0.9, 0, 0.0), (2, "paddle", "b", [], 0.5, 0, 0.5)])
    second = page(spark, [(2, "error", "", [], None, 0, 0.0), (9, "qwen", "z", [], None, 0, 0.0)])
    assert {(r.page_number, r.engine_used, r.text) for r in pg.override(first, second).collect()} == {(1, "paddle", "a"), (2, "error", "")}


def test_latest(spark):
    rows = spark.createDataFrame([("d", 1, "old", "2025-01-01"), ("d", 1, "new", "2025-02-01"), ("d", 1, "none", None), (None, None, "n", None)], "doc_id string, page_number int, text string, at string").select("doc_id", "page_number", "text", F.col("at").cast("timestamp").alias("ingested_at"), F.lit(1).alias("row"))
    assert {(r.doc_id, r.text, r.row) for r in pg.latest(rows).collect()} == {("d", "new", 1), (None, "n", 1)}


def test_metrics_of_dirty_scores(spark):
    s = spark.createDataFrame([(1, [0.5, None, float("nan"), 0.9]), (2, []), (3, None)], "k int, s array<double>")
    r = {x.k: x for x in pg.score_metrics(s, "s", ["k"]).collect()}
    assert math.isclose(r[1].conf_promedio, 0.7) and r[1].lineas_baja_confianza == 1
    assert r[2].conf_promedio is None and r[3].conf_max is None and r[3].lineas_baja_confianza == 0


def test_histogram_bounds(spark):
    p = spark.createDataFrame([("d", [0.5, 0.85, 1.0, 0.2])], "doc_id string, line_scores array<double>")
    assert {(r.low, r.n, r.percent) for r in pg.histogram(p, ["doc_id"]).collect()} == {(0.5, 1, 25.0), (0.85, 1, 25.0)}


def test_labels(spark):
    p = page(spark, [(1, "paddle", "", [], 0.8, 0, 0.0), (2, "paddle", "", [], 0.9, 0, 0.4), (3, "paddle", "", [], 0.9, 3, 0.1), (4, "paddle", "", [], 0.9, 0, 0.1), (5, "qwen", "", [], None, 0, 0.0), (6, "error", "", [], None, 0, 0.0)])
    assert [r.s for r in p.orderBy("page_number").select(pg.page_status().alias("s")).collect()] == ["conf baja", "descarte alto", "3 líneas bajas", "ok", "qwen", "error"]
    assert [r.s for r in p.orderBy("page_number").select(pg.legacy_advice().alias("s")).collect()][:4] == ["reroute", "reroute", "evaluate", "use"]


def test_empty_table(spark):
    p = page(spark, [])
    assert pg.documents(p).count() == 0 and pg.latest(p).count() == 0 and pg.low_lines(p.withColumn("line_scores", F.array().cast("array<double>"))).count() == 0
