import pytest

from folioscope.llm import truncation as tr

SCHEMA = "doc_id string, page_number int, text string, fallback_reason string, lines array<string>, source string, field string, value string"
BODY = [
    "El sistema de bombeo opera con dos unidades alternadas y un tablero automático.",
    "La supervisión verificó el uso de membrana asfáltica conforme a las especificaciones.",
    "El comité de recepción verificó el funcionamiento de las instalaciones del reservorio.",
    "El monto contratado asciende a S/ 5,911.90, incluidos los impuestos de ley.",
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = []
    for p in range(400):
        text = "\n".join(BODY[(p + i) % 4] for i in range(4))
        rows.append(("d", p, text, "confianza baja (0.812) y descarte alto (40.0%)", None, f"s{p % 2}", "clash", "clash"))
    cut = "\n".join(BODY)
    odd = {1000: cut[:-40], 1001: cut[:150] + "…", 1002: cut + "\nIng. Marisol Tovavarán Ñaupavayoc", 1003: cut + "\n12", 1004: "", 1005: None, 1006: " ", 1007: cut[:200] + "�", 1008: cut + "\n1.01 Obra de riego m3 2.00 1,200.50", 1009: cut.replace("\n", " ") * 300}
    rows += [("d", p, t, "confianza baja (0.8" if p == 1000 else None, None, "s0", "x", "x") for p, t in odd.items()]
    rows.append(rows[-10])
    return spark.createDataFrame(rows, SCHEMA)


def test_found(pages):
    got = {(r.page_number, r.field) for r in tr.found(pages).collect()}
    assert got == {(1000, "text"), (1000, "fallback_reason"), (1001, "text"), (1007, "text")}


def test_rates(pages):
    r = {(x.source, x.field): x for x in tr.rates(pages).collect()}
    assert r["s0", "text"].n_cut == 3 and r["s0", "text"].n_values == 207 and r["s1", "text"].n_cut == 0


def test_empty_table(spark):
    assert tr.found(spark.createDataFrame([], SCHEMA)).count() == 0
