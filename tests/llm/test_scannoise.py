import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import scannoise as sn
from folioscope.llm.boost import Boosted

SCHEMA = "doc_id string, page_number int, lines array<string>, text string, running string"
SENTENCES = [
    "El sistema de bombeo opera con dos unidades alternadas y un tablero automático.",
    "La supervisión verificó el uso de membrana asfáltica conforme a las especificaciones técnicas.",
    "El informe técnico-económico sustenta la alternativa de menor costo de mantenimiento.",
    "Las partidas de movimiento de tierras registraron un rendimiento de metros cúbicos por jornada.",
    "El comité de recepción verificó el funcionamiento de las instalaciones del reservorio apoyado.",
    "El profesional propuesto permaneció en obra durante todo el periodo contractual señalado.",
]


THINGS = "del canal|del puente|de la vía|del muro|del aula|del mercado|del túnel|de la presa|del dique|de la toma|del pozo|de la losa|del talud".split("|")


def page(doc, p, extra=(), total=40):
    body = []
    for i in range(6):
        s = SENTENCES[(p + i) % 6][:-1] + " " + THINGS[(p * 5 + i * 3) % 13] + " " + THINGS[(p // 13 + i) % 13] + "."
        body += [s[: 40 + p % 7], s[40 + p % 7 :]]
    return (doc, p, [f"Consorcio Vial {doc}", *(["ACTA DE RECEPCIÓN"] if p % 9 == 0 else []), *extra, *body, f"Pág. {p}/{total}"], None, "clash")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [page(d, p) for d in ("Larimarseda", "Oscoserca", "Tambopalca") for p in range(1, 41)]
    noisy = ("Larimarseda", 50, ["Consorcio Vial Larimarscda", "El sistema de b0mbeo opera con dos uni-", "dades alternadas. El informe técnico-", "económico sustenta la supervlsión", None, "de la obra.", "- 50 -"], None, "x")
    return spark.createDataFrame([*rows, noisy, noisy, ("Larimarseda", 51, [], None, "x"), ("Larimarseda", 52, None, None, "x"), (None, None, ["suelta"], None, "x")], SCHEMA)


def test_found(pages):
    got = {(r.line_no, r.noise) for r in sn.found(pages).where("doc_id = 'Larimarseda' AND page_number = 50").collect()}
    assert got == {(1, "running"), (2, "hyphen"), (2, "misread"), (4, "misread"), (7, "page_no")}
    rows = sn.found(pages).where("page_number <= 40").groupBy("noise").count().collect()
    assert {r.noise: r["count"] for r in rows} == {"running": 120, "page_no": 120}


def test_repaired(pages):
    out = {(r.doc_id, r.page_number): r.text for r in sn.repaired(pages).collect()}
    assert out["Larimarseda", 50] == "El sistema de bombeo opera con dos unidades alternadas. El informe técnico-económico sustenta la supervisión de la obra." or "técnico- económico" in out["Larimarseda", 50]
    assert out["Larimarseda", 51] == "" and out["Larimarseda", 52] == "" and out[None, None] == "suelta"


def test_empty_table(spark):
    e = spark.createDataFrame([], SCHEMA)
    assert sn.found(e).count() == 0 and sn.repaired(e).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(["especificaciones", "membrana", "alternadas", "conducción", "rendimiento"]), st.integers(0, 10**6))
def test_what_was_spoilt_is_explained(word, seed):
    wrong = sn.spoil(word, np.random.default_rng(seed))
    assert sn.explained(wrong, word, 4)[0] <= 4


@pytest.mark.parametrize("line,expected", [("- 15 -", True), ("[58]", True), ("0001", True), ("pág 1", True), ("Página 16 de 77", True), ("Folio 00001", True), ("2015.", False), ("N° 2", False), ("1.01 Obra m3 2.00", False), ("", False), ("Plano 3", False)])
def test_page_number_lines(line, expected):
    assert sn.page_number_line(line) is expected


def test_boosting_learns_a_rule_of_two_features():
    x = np.random.default_rng(0).normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    m = Boosted().fit(x[:1500], y[:1500])
    assert ((m.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.9


def test_words_with_many_confusions_are_proposed(spark):
    right = ["acuerdo", "estudio", "predios", "iniciaron", "modificación", "contiene", "administración", "tierno"]
    wrong = ["acverclo", "e5tuclio", "preclio5", "iriici@ron", "moclificac1ón", "confierie", "aclrniriistrac1ón", "tierri0"]
    words = spark.createDataFrame([(w, 500) for w in right] + [(w, 1) for w in wrong], "word string, n long")
    x = np.zeros((200, 9))
    x[:, 0] = [1, 99] * 100
    whatever_is_explained = Boosted(trees=20).fit(x, (x[:, 0] == 1).astype(float))
    assert {r.word: r.fix for r in sn.corrections(words, whatever_is_explained).collect()} == dict(zip(wrong, right))


def test_confusions_fold_to_the_same(spark):
    dice = np.random.default_rng(5)
    pairs = [*sn.CONFUSIONS, *((w, sn.spoil(w, dice)) for w in ["tierno", "arriba", "clarines", "encarnación", "modificación"] for _ in range(200))]
    rows = spark.createDataFrame(pairs, "a string, b string")
    assert rows.where(sn.folded(rows["a"]) != sn.folded(rows["b"])).collect() == []


def test_misread_signs_in_no_list_are_repaired(spark):
    frequent = {w: 5000 for w in sn.words_of(SENTENCES + THINGS)} | {"expediente": 5000, "zonas": 5000, "zona": 90, "obra": 9000, "mesa": 5000, "mes": 300}
    ranker = sn.train_ranker(sorted(frequent.items(), key=lambda x: (-x[1], x[0])))
    wrong = {"expe0iente": "expediente", "obr4": "obra", "supe7vi8ión": "supervisión", "rese|vorio": "reservorio", "m3mbrana": "membrana"}
    # numbers behind and before a word, an ordinary other letter, and too many edits
    stand = ["obra7", "obra27", "3muro", "zona2", "mes3", "tablera", "ob74", "ex3e7ie9te"]
    words = spark.createDataFrame([*frequent.items(), *((w, 20 if w == "zona2" else 1) for w in [*wrong, *stand])], "word string, n long")
    assert {r.word: r.fix for r in sn.corrections(words, ranker).collect()} == wrong
