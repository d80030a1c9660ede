import json

import pytest
from pyspark.sql import functions as F

from folioscope.config import DEFAULT
from folioscope.operators import detect


@pytest.mark.parametrize(
    "lines,expected",
    [([], False), (None, False), (["solo una"], False), (["Gerente de Contrato", "12", "a"], True), (["jefe de obra"] * 16, False), (["Certificado de trabajo", "Jefe de Supervisión"], False), (["Supervisión de obras"], False), (["PRE INSTALACIÓN de equipos", None], True)],
)
def test_candidate(spark, lines, expected):
    assert spark.createDataFrame([(lines,)], "l array<string>").select(detect.is_candidate(F.col("l")).alias("r")).first().r is expected


def test_delimiter(spark):
    rows = [(["B.2 EXPERIENCIA DEL PERSONAL CLAVE"] + ["- - -"] * 40,), (["experiencia del personal clave"] + [f"renglón {i} con texto" for i in range(31)],), (None,)]
    assert [r.r for r in spark.createDataFrame(rows, "l array<string>").select(detect.is_delimiter(F.col("l")).alias("r")).collect()] == [True, False, False]


def by_python(raw):
    if raw is None:
        return False, "", "error"
    text = raw.rsplit("</think>", 1)[-1].strip().strip("`").strip()
    text = text[4:].strip() if text.startswith("json") else text
    try:
        v = json.loads(text)
        if not isinstance(v, dict):
            raise ValueError
    except ValueError:
        return False, "", "error"
    return bool(v.get("es_separadora")), str(v.get("cargo") or ""), str(v.get("confianza", "baja")).lower()


REPLIES = [
    '<think>a</think>\n```json\n{"es_separadora": true, "cargo": "Jefe de supervicion", "confianza": "Alta"}\n```', "no-json", "[1]", '{"es_separadora":"false","cargo":"X"}', '{"es_separadora":true,"cargo":null,"confianza":null}',
    "", None, '{"es_separadora": 0}', '{"es_separadora": 2, "cargo": "", "confianza": "MEDIA"}', '{"es_separadora": [], "cargo": "Y"}', '{"es_separadora": [0]}', '{"es_separadora": {}}', "{'es_separadora': true}", '{"es_separadora": tr', '"x"', "null", '{"cargo": "Z"}',
]


def test_verdict_like_python(spark):
    rows = spark.createDataFrame(list(enumerate(REPLIES)), "i int, raw string").select("i", detect.verdict(F.col("raw")).alias("v")).orderBy("i").collect()
    assert [(r.v.es_separadora, r.v.cargo, r.v.confianza) for r in rows] == [by_python(x) for x in REPLIES]


def test_cascade(spark):
    pages = spark.createDataFrame([("d", 1, "x"), ("d", 2, "Gerente de Contrato"), ("d", 3, "nada que ver"), ("d", 4, None)], "doc_id string, page_number int, text string")
    replies = spark.createDataFrame([("d", 1, '{"es_separadora":true,"cargo":"Jefe de supervicion","confianza":"media"}'), ("d", 2, '{"es_separadora":false,"confianza":"baja"}'), ("d", 3, "broken")], "doc_id string, page_number int, raw_reply string")
    r = {x.page_number: x for x in detect.evaluate(pages, replies).collect()}
    assert (r[1].metodo, r[1].cargo_normalizado, r[1].confianza_qwen) == ("qwen", "Jefe De Supervisión", "media")
    assert (r[2].metodo, r[2].cargo_normalizado, r[2].confianza_qwen) == ("fuzzy_fallback", "Gerente De Contrato", "baja")
    assert (r[3].metodo, r[3].es_separadora, r[3].confianza_qwen) == ("descartada", False, "error")
    assert r[4].metodo == "descartada"


def test_catalogue():
    assert len(DEFAULT.roles) == 36 and len(DEFAULT.misreadings) == 44 and len(DEFAULT.separate_roles().roles) == 37
