import pytest

from folioscope.llm import personal as pe

NAMES = frozenset("ciro brenda sonia tovavarán ñaupavayoc quilnesque zubidondía marisol bremnesque".split())


def kinds(text):
    return [(text[a:b], k) for a, b, k in pe.spans(text, NAMES)]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("El suscrito, TOVAVARÁN QUILNESQUE, SONIA, identificado con DNI N° 61818125, declara", [("TOVAVARÁN QUILNESQUE, SONIA", "name"), ("61818125", "id_number")]),
        ("comunicarse con marisol bremnesque zubidondía al celular\n0051 939017732 o al correo\nx.y9@cons-ultora.invalid.", [("marisol bremnesque zubidondía", "name"), ("0051 939017732", "phone"), ("x.y9@cons-ultora.invalid", "email")]),
        ("domicilio en Mz. E Lote 6, AA.HH. Larihualpata, suscribe", [("Mz. E Lote 6, AA.HH. Larihualpata", "address")]),
        ("vivir en JIRÓN LOS TORNOS 1700 - LARIPALTINA.", [("JIRÓN LOS TORNOS 1700 - LARIPALTINA", "address")]),
        ("Contribuyente con RUC 10565968988 a nombre de Ciro Brenda Tovavarán.", [("10565968988", "id_number"), ("Ciro Brenda Tovavarán", "name")]),
        ("escriba a margallecho43 [arroba] ingenieros.example hoy", [("margallecho43 [arroba] ingenieros.example", "email")]),
        ("llamar al (01) 420-8657 en horario", [("(01) 420-8657", "phone")]),
        ("Pasaporte GB826269 expedido a favor de T. Tovavarán Quilnesque", [("GB826269", "id_number"), ("T. Tovavarán Quilnesque", "name")]),
        ("suscrito con Grupo Tresandes S.R.L.. El 12.04.2018 se pagó S/ 1,735,432.89 por 12345678 ladrillos", []),
        ("a favor de la Municipalidad Distrital de Pampa Vinmayo", []),
        ("Firmado: Sonia Quilnesque\nJefe de Obra", [("Sonia Quilnesque", "name")]),
        ("", []), (None, []),
    ],
)
def test_spans(text, expected):
    assert kinds(text) == expected if text else pe.spans(text, NAMES) == expected


def test_checksums():
    assert pe.luhn("4539578763621486") and not pe.luhn("4539578763621487")
    assert pe.mod97("GB82WEST12345698765432") and not pe.mod97("GB82WEST12345698765433")
    assert pe.ruc("20131312955") and not pe.ruc("20131312956")


def test_redaction_keeps_the_rest():
    text = "Ing. Ciro Tovavarán, DNI 61818125."
    assert pe.redact(text, pe.spans(text, NAMES)) == "Ing. [NOMBRE], DNI [IDENTIDAD]."
    assert pe.redact(None, []) is None and pe.redact("x", []) == "x"


@pytest.fixture(scope="module")
def data(spark):
    who = ["Ciro Tovavarán Quilnesque", "Brenda Quilnesque Tovavarán", "Sonia Tovavarán Quilnesque"]
    rows = [("d", i, f"Firmado: {who[i % 3]}", "clash") for i in range(30)] + [("d", 30, "aquí ciro tovavarán", "x"), ("d", 31, None, "x"), ("d", 32, "", "x"), ("d", 0, f"Firmado: {who[0]}", "x"), ("d", 33, "palabra " * 50_000, "x")]
    pages = spark.createDataFrame(rows, "doc_id string, page_number int, text string, tbl string")
    sections = spark.createDataFrame([("e", 1, [(5, "llamar al 939 017 732"), (6, None)]), ("e", 2, None)], "doc_id string, section_index int, pages array<struct<page_number:int,text:string>>")
    return pages, sections


def test_found(data):
    got = {tuple(r) for r in pe.found(*data).collect()}
    assert ("pages", "d", 30, 5, "name") in got and ("sections", "e", 5, 10, "phone") in got and ("pages", "d", 0, 9, "name") in got and len(got) == 32


def test_redacted(data):
    out = {(r.tbl, r.page_number): r.text for r in pe.redacted(*data).collect()}
    assert out["pages", 30] == "aquí [NOMBRE]" and out["sections", 5] == "llamar al [TELEFONO]" and len(out["pages", 33]) == 400_000


def test_empty(data):
    assert pe.found(data[0].limit(0), data[1].limit(0)).count() == 0


def test_names_beyond_the_bound_are_joined(data, monkeypatch):
    rows = lambda: {tuple(r) for r in pe.found(*data).collect()}
    one = rows()
    monkeypatch.setattr(pe, "MOST_NAMES", 2)
    assert rows() == one


@pytest.mark.parametrize(
    "text,expected",
    [("ver https://portal.example/x@obras.test hoy", []), ("correo x@obras.test hoy", ["email"]), ("mejoramiento de la Carretera Central 120 y obras", []), ("con domicilio en Carretera Central 120", ["address"]), ("dijo el testigo Pedro Nadie", []), ("dijo el testigo Ciro Nadie", ["name"]), ("Ing. Pedro Nadie", ["name"])],
)
def test_every_kind_has_a_score(text, expected):
    assert [k for _, k in kinds(text)] == expected
