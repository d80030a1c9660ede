import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscope.functions import fuzzy
from folioscope.functions import text as tx

SAMPLES = ["", " ", "  x\t\n", "ÑANDÚ Ágil", "d'obra-2a parte/BIM", "o'neill 3ra", " fin\x1c", "²", "N° 12", "naïve", "  jefe de supervicion y varolizaciones ", "línea\r\nuna\x0bdos\n"]


def plain(s):
    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if unicodedata.category(c) != "Mn")


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("name,ours,theirs", [("strip", tx.strip, str.strip), ("fold", tx.fold, plain), ("title", tx.title, str.title), ("digits", tx.is_digits, str.isdigit), ("lines", tx.lines_of, str.splitlines)])
def test_like_python(spark, name, ours, theirs):
    rows = spark.createDataFrame([(s,) for s in SAMPLES], "v string").select("v", ours(F.col("v")).alias("r")).collect()
    assert [(r.v, r.r) for r in rows] == [(s, theirs(s)) for s in SAMPLES]


def test_roles(spark):
    assert one(spark, "  jefe de supervicion y varolizaciones ", tx.normal_role) == "Jefe De Supervisión Y Valorizaciones"
    assert one(spark, "Especialista BIM", tx.normal_role) == "Especialista Bim"
    keys = [one(spark, f"Especialista En Estructuras {n}", tx.group_key) for n in ("N° 1", "N 1", "Nº1")]
    assert set(keys) == {"especialista en estructuras n°1"}
    assert one(spark, "Jefe De Supervisión", tx.post_number) is None
    assert one(spark, "Especialista En Estructuras N° 1", tx.post_number) == "1"


def test_ngrams_and_candidates(spark):
    rows = spark.createDataFrame([("a b\ncd\n12\n---\nJefe de obra\nLote",)], "v string").select(tx.match_lines(F.col("v")).alias("l"), tx.match_candidates(F.col("v")).alias("c")).first()
    assert rows.l == ["a b", "Jefe de obra", "Lote"]
    assert rows.c[1:] == ["a b Jefe de obra Lote", "a b", "Jefe de obra", "Lote", "a b Jefe de obra", "Jefe de obra Lote", "a b Jefe de obra Lote"]


def test_eta_paths_defaults(spark):
    assert [one(spark, s, lambda c: tx.eta(c.try_cast("double"))) for s in ("0", "7.9", "65", "3723", None)] == ["0s", "7s", "01m05s", "01h02m03s", "0s"]
    assert [one(spark, s, tx.page_of_path) for s in ("/t/pagina_0012.png", "/t/x.png", "/a_b/pagina_x.png")] == [12, 0, 0]
    assert one(spark, "", lambda c: tx.or_default(c, "-")) == "-"
    assert one(spark, "a|b\nc", tx.md_escape) == "a\\|b c"
    assert one(spark, "<think>x</think>\n ya ", tx.after_thought) == "ya"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text("abc ñ", max_size=12), st.text("abc ñ", max_size=12))
def test_common_subsequence(a, b):
    assert fuzzy.common_subsequence(a, b) == lcs(a, b)


def test_first_acceptable_role(spark):
    roles = ("Gerente de Contrato", "Jefe de Supervisión")
    rows = spark.createDataFrame([(["nada", "gerente de contrat", "jefe de supervisión"],), (["zzz"],), ([],), (None,)], "c array<string>")
    assert [r.r for r in fuzzy.with_first_role(rows, "c", "r", roles, 80.0).collect()] == ["Gerente de Contrato", None, None, None]


@pytest.mark.parametrize("digits", [1, 3, 4])
def test_numbers_like_python(spark, digits):
    import random

    dice = random.Random(digits)
    values = [0.8125, 0.0625, 0.1285, 0.1245, 0.25, 40.25, 0.0, 1.0, -0.0625, -1.5, 0.99995, 0.9995, 123456.78125, float("nan"), 1e-9]
    values += [dice.choice([dice.random(), round(dice.random() * 100, digits + 1), (dice.randrange(2000) * 2 + 1) / 32, dice.randrange(10000) / 10**digits + 5 / 10 ** (digits + 1)]) for _ in range(3000)]
    rows = spark.createDataFrame([(x,) for x in values], "x double").select("x", tx.fixed(F.col("x"), digits).alias("t")).collect()
    assert [(r.x, r.t) for r in rows if r.t != f"{r.x:.{digits}f}"] == []


def test_boxes_and_plurals(spark):
    r = spark.range(1).select(tx.box(F.array(F.array(F.lit(1), F.lit(2)), F.array(F.lit(3), F.lit(4)))).alias("b"), tx.plural(F.lit(1), "a", "b").alias("one"), tx.plural(F.lit(2), "a", "b").alias("two")).first()
    assert (r.b, r.one, r.two) == ("1,2,3,4", "a", "b")
