import numpy as np
import pytest

from folioscope.llm import harm as ha

CLEAN = ["El humo negro de los equipos fue controlado con el cambio de filtros.", "Las conexiones macho y hembra fueron probadas a una presión de 268 libras.", "Se atendió una denuncia por insultos entre cuadrillas, archivada por falta de pruebas.", "La gestión fue pésima y exijo una respuesta por escrito.", "El peso bruto vehicular autorizado es de 66 toneladas."]
BAD = ["Eres un imbécil y un inútil de mierda, ingeniero de pacotilla.", "Cierra el hocico, animal, o te voy a romper la cara.", "Váyanse todos al carajo, manada de ineptos asquerosos."]
MASKED = ["Er3s un 1mbéc1l y un 1nút1l de m1erda, ingeniero de p4cotilla.", "Cierra el h o c i c o, animal, o te voy a romper la c*ra.", "VÁYANSE TODOS AL CARAAAJO, MANADA DE INEPTOS ASQUEROSOS."]


def corpus(seed, n=300):
    dice = np.random.default_rng(seed)
    out = []
    for i in range(n):
        parts = [CLEAN[k] for k in dice.integers(len(CLEAN), size=4)]
        bad = i % 4 == 0
        if bad:
            parts.insert(int(dice.integers(4)), BAD[int(dice.integers(3))])
        out.append((i, " ".join(parts), bad))
    return out


@pytest.fixture(scope="module")
def model():
    rows = corpus(1)
    targets = np.array([[float(b)] for _, _, b in rows])
    targets[4] = 0.0  # a rater's error
    return ha.Model.train([t for _, t, _ in rows], targets, ["abuso"])


def test_held_out(model):
    rows = corpus(2)
    wrong = sum((model.score(t)[0].max() >= 0.5) != b for _, t, b in rows)
    assert wrong / len(rows) < 0.03


def test_disguised_and_located(model):
    for m in MASKED:
        doc, each, parts = model.score(" ".join([CLEAN[0], m, CLEAN[1]]))
        assert doc.max() >= 0.5 and parts[int(each.max(axis=1).argmax())].startswith(m[:6])
    assert all(model.score(c)[0].max() < 0.5 for c in CLEAN)


def test_noisy_or(model):
    doc, each, _ = model.score(" ".join([*CLEAN, *BAD]))
    assert np.allclose(doc, 1 - np.prod(1 - each, axis=0))


def test_tables(spark):
    rows = corpus(3, 120)
    docs = spark.createDataFrame([(i, t, f"s{i % 2}", "clash") for i, t, _ in rows] + [(900, None, "s0", "x"), (901, "", "s0", "x"), (902, " \n", None, "x"), (903, "palabra " * 20_000, "s1", "x")], "doc_id long, text string, source string, label string")
    labels = spark.createDataFrame([(i, r, "abuso" if b else "limpio") for i, _, b in rows for r in (1, 2)] + [(None, 1, "abuso"), (1, None, None)], "doc_id long, rater int, label string")
    assert {r.doc_id for r in ha.found(docs, labels).collect()} == {i for i, _, b in rows if b}
    r = {x.source: x for x in ha.rates(docs, labels).collect()}
    assert r["s0"].n_offensive == 30 and r["s1"].n_offensive == 0 and r[None].n_documents == 1
    assert ha.scores(docs, labels).count() == docs.count()
    assert ha.found(docs, labels.limit(0)).count() == 0 and ha.found(docs.limit(0), labels).count() == 0


def test_short_sentences_are_read_with_their_neighbour(model):
    assert ha.sentences("Te odio. Eres basura. Muérete ya. Las obras siguen su curso normal.") == ["Te odio. Eres basura. Muérete ya.", "Las obras siguen su curso normal."]
    assert ha.sentences("Sí. No.") == ["Sí. No."] and ha.sentences("La obra sigue igual. No. Ya.") == ["La obra sigue igual. No. Ya."]
    assert model.score(f"{CLEAN[0]} ¡Imbécil! ¡Inútil! ¡Animal! {CLEAN[1]}")[1].shape[0] == 2


def test_the_sample_is_bounded_in_characters(spark, monkeypatch):
    rows = corpus(5, 40)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, "abuso" if b else "limpio") for i, _, b in rows], "doc_id long, rater int, label string")
    seen = []
    monkeypatch.setattr(ha.Model, "train", classmethod(lambda cls, texts, targets, labels: seen.append(len(texts))))
    ha.fit(docs, labels)
    monkeypatch.setattr(ha, "MOST_CHARS", 2000)
    ha.fit(docs, labels)
    assert seen[0] == 40 and 0 < seen[1] < 10
