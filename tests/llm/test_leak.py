import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscope.llm import leak as le

PASSAGE = (
    "El sifón invertido de doble barril soportó con holgura una cuña de roca meteorizada y suelta en el sector Villa Margua, gracias al drenaje horizontal perforado frente a las 549 previstas por la memoria. "
    "Las partes declaran conocer el contenido y alcance legal de cada una de las cláusulas del presente documento y lo firman en señal de conformidad. "
    "La torre de aforo hueca duplicó en el segundo ensayo la fisura diagonal del paramento aguas arriba en el sector Oscohualyacu, salvo en los meses de viento constante hasta llegar a 709 ciclos de carga."
)
FORMULA = PASSAGE.split(". ")[1] + "."
OTHER = "El humo negro de los equipos fue controlado con el cambio oportuno de los filtros. "
ALTERED = PASSAGE.split(". ")[0].replace("sector", "paraje").replace("gracias", "grac1as").replace("de doble", "de\ndo-\nble").upper()
# same parts, another place and number
NEAR = PASSAGE.split(". ")[0].replace("Villa Margua", "Alto Llaca").replace("549", "12")


def table(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=1, max_size=10), st.text("abc", max_size=25))
def test_distance_like_the_table(pattern, text):
    assert le.myers(pattern, text, 99) == table(pattern, text)


def longest(places):
    best = n = 0
    for x in range(max(places, default=0) + 1):
        n = n + 1 if x in places else 0
        best = max(best, n)
    return best


@pytest.mark.parametrize("text,expected", [(OTHER + PASSAGE, True), (OTHER + ALTERED + OTHER, True), (OTHER * 3, False), (NEAR, True), ("", False), (None, False), (" ".join(PASSAGE.split()[5:22]) + " " + OTHER, False)])
def test_stretches(text, expected):
    # another place and number are alterations like any others
    held = le.Items([(le.words_of(PASSAGE), set())]).held(text)
    assert (longest(held.get(0, set())) >= le.LEAST_WORDS) is expected


@settings(max_examples=100, deadline=None)
@given(st.text("aáÁÑñßº²µ -\n¬\u00ad.’ﬁｆ０\u200b", max_size=30))
def test_both_ways_of_folding_are_equal(text):
    assert le.words_of(text) == le._WORD.findall(le._folded(le._BROKEN.sub("", text)))


@pytest.mark.parametrize("altered,least", [(0, 1.0), (1, 1.0), (2, 0.95), (3, 0.9)])
def test_recall_by_alterations(altered, least):
    import random

    dice, words = random.Random(altered), le.words_of(PASSAGE)
    items, hits = le.Items([(words, set())]), 0
    for _ in range(200):
        a = dice.randrange(len(words) - 26)
        part = words[a : a + 26]
        for x in dice.sample(range(26), altered):
            part[x] = dice.choice(["mortero", part[x][: len(part[x]) // 2] + "1" + part[x][len(part[x]) // 2 + 1 :], ""])
        hits += longest(items.held(OTHER + " ".join(part) + " " + OTHER).get(0, set())) >= le.LEAST_WORDS
    assert hits >= least * 200


def test_tables(spark):
    docs = [(i, f"{OTHER * 2}Folio {i}. {FORMULA}") for i in range(100, 130)] + [(1, OTHER + PASSAGE + OTHER), (1, OTHER + PASSAGE + OTHER), (2, ALTERED), (3, None), (4, ""), (5, NEAR), (6, "palabra " * 30_000)]
    documents = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, "a", PASSAGE), (2, "a", None), (3, "b", ""), (4, "b", "tres palabras solas")], "item_id int, suite string, passage string")
    assert {tuple(r) for r in le.found(documents, items).collect()} == {(1, 1), (2, 1), (5, 1)}
    assert {(r.item_id, r.n_documents) for r in le.leaked_items(documents, items).collect()} == {(1, 3)}
    assert le.found(documents.limit(0), items).count() == 0 and le.found(documents, items.limit(0)).count() == 0


FIRST = PASSAGE.split(". ")[0].split()


@pytest.mark.parametrize("words,expected", [(FIRST[3:24], {1}), (FIRST[13:34], {1}), (FIRST[:20], {1}), (FIRST[10:28], set()), (FIRST[:19] + ["Alto", "Llaca"], set())])
def test_about_twenty_words_are_enough(spark, words, expected):
    # with only a name (twice); with neither number nor name; too few words; the name is another one
    documents = spark.createDataFrame([(1, OTHER + " ".join(words) + ". " + OTHER)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a", PASSAGE)], "item_id int, suite string, passage string")
    assert {r.item_id for r in le.found(documents, items).collect()} == expected


def test_popular_items_and_copies_are_no_formulas(spark):
    # an item in twelve different documents, a fragment in copies of one document, and a formula of two items in few documents
    whole = [(i, f"{OTHER} Expediente {i}. {PASSAGE}") for i in range(12)]
    copies = [(100 + i, OTHER + " ".join(FIRST[3:32]) + ". " + OTHER) for i in range(20)]
    formula = [(200 + i, f"Folio {i}. {FORMULA} {OTHER}") for i in range(3)]
    documents = spark.createDataFrame(whole + copies + formula, "doc_id long, text string")
    other = f"El caudal de estiaje medido con molinete en el sector Laricortina bajó a 37 litros por segundo durante la campaña de aforos que pidió la entidad. {FORMULA} La poza disipadora quedó sin revestir hasta la progresiva 812 por falta de cemento en los almacenes del consorcio de Pampa Vinmayo."
    items = spark.createDataFrame([(1, "a", PASSAGE), (2, "a", other)], "item_id int, suite string, passage string")
    assert {tuple(r) for r in le.found(documents, items).collect()} == {(d, 1) for d, _ in whole + copies}


@pytest.mark.parametrize("n", [1, 9, 1000])
def test_an_item_may_leak_into_any_number_of_documents(spark, n):
    documents = spark.range(1, n + 41).selectExpr("id AS doc_id").withColumn("text", F.when(F.col("doc_id") <= n, F.concat(F.lit(OTHER), F.lit("Folio "), F.col("doc_id").cast("string"), F.lit(". " + PASSAGE))).otherwise(OTHER))
    items = spark.createDataFrame([(1, "a", PASSAGE)], "item_id int, suite string, passage string")
    assert le.leaked_items(documents, items).first().n_documents == n


def test_blocks_of_items_and_two_passages_of_an_item(spark, monkeypatch):
    monkeypatch.setattr(le, "BLOCK", 1)
    second = "La poza disipadora quedó sin revestir hasta la progresiva 812 por falta de cemento en los almacenes del consorcio de Pampa Vinmayo durante toda la campaña de estiaje."
    items = spark.createDataFrame([(1, "a", PASSAGE), (1, "a", second), (2, "a", OTHER * 2 + "Nadie lo dijo.")], "item_id int, suite string, passage string")
    documents = spark.createDataFrame([(1, PASSAGE), (2, second), (3, second + " " + PASSAGE)], "doc_id long, text string")
    assert {tuple(r) for r in le.found(documents, items).collect()} == {(1, 1), (2, 1), (3, 1)}
