import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st

from folioscope.llm import unify as un


@pytest.mark.parametrize(
    "text,plain",
    [
        ("Especialista En Acústica", "Especialista En Acústica"), ("E⁠specialista", "Especialista"), ("Folio\xa0233", "Folio 233"), ("Monitor 𝐀𝐦𝐛𝐢𝐞𝐧𝐭𝐚𝐥", "Monitor Ambiental"), ("Ｐｏｒｔｅｒｏ", "Portero"),
        ("Contadοra", "Contadora"), ("Acústica", "Acústica"), ("N° 2 Nº 3", "N° 2 Nº 3"), ("a​b\xadc", "abc"), ("", ""), (None, None), ("GUÍΑ DΕ", "GUÍA DE"), ("a　b", "a b"), ("Москва Привет", "Москва Привет"),
        ("СОСЕ Мосt", "COCE Moct"), ("a\u0600\u06dd\ufff9b", "a\u0600\u06dd\ufff9b"), ("a\u2065\ufff0\u061cb", "ab"),
    ],
)
def test_plain(text, plain):
    assert un.plain_form(text) == plain


@given(st.text(max_size=40))
def test_plain_is_stable_and_composed(text):
    once = un.plain_form(text)
    assert un.plain_form(once) == once and unicodedata.normalize("NFC", once) == once


def test_key():
    assert un.key_form("  JEFE\xa0de  Ｏbra ") == "jefe de obra" and un.key_form(None) is None and un.key_form("STRASSE") == un.key_form("straße")


def test_found_and_forms(spark):
    sep = spark.createDataFrame([("d", 1, "Folio\xa01", "x"), ("d", 1, "Folio\xa01", "x"), ("d", 2, "Folio 1", "x"), ("d", 3, None, "x"), ("d", 4, "", "x")], "doc_id string, page_number int, cargo_normalizado string, plain string")
    sec = spark.createDataFrame([("d", 1, "Rоl")], "doc_id string, section_index int, cargo_raw string")
    assert {tuple(r) for r in un.found(sep, sec).collect()} == {("separators", "d", 1), ("sections", "d", 1)}
    assert un.found(sep.limit(0), sec.limit(0)).count() == 0
    assert {(r.value, r.plain, r.n_rows) for r in un.roles(sep, sec).collect()} == {("Folio\xa01", "Folio 1", 2), ("Folio 1", "Folio 1", 1), ("", "", 1), ("Rоl", "Rol", 1)}
    kept = un.unify(sep, "cargo_normalizado")
    assert kept.count() == 5 and kept.columns == ["doc_id", "page_number", "cargo_normalizado", "plain", "key"]
