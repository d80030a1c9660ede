import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import canonical as ca

ENTRIES = ((1, "Residente de Obra Vial"), (2, "Especialista en Acústica"), (3, "Jefe de Logística y Almacenes"), (4, "Supervisor de Puesta en Marcha"), (5, "Especialista en Gestión Social"), (6, "Especialista en Gestión de Residuos"))
TRIES = ca.tries(ENTRIES)


@pytest.mark.parametrize(
    "value,expected",
    [
        ("RESIDENTE DE OBRA VIAL N° 2", 1), ("resid. de obra 𝐯𝐢𝐚𝐥", 1), ("Residentede obra viai", 1), ("Acústica, Especialista en", 2), ("Experto en Acustica", 2), ("Acústica (Especialista)", 2), ("Jefe de Logísfica y A1macenes", 3),
        ("jefe logística almacenes", 3), ("Marcha, Supervisor de Puesta en Nº 3", 4), ("supervisora puesta marcha", 4), ("Especialista en Gestión Social propuesto", 5), ("1. Especialista en Gestión de Residuos - Lote 3", 6), ("Ing. Residente de Obra Vial", 1),
        ("Veterinario Zonal", -1), ("Folio 233", -1), ("", -1), (None, -1), ("x" * 5000, -1),
    ],
)
def test_match(value, expected):
    hits = ca.match(value, TRIES)
    assert (hits[0][0] if hits else -1) == expected


def distance(a, b):
    """Optimal string alignment by the plain table."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=9), min_size=1, max_size=6, unique=True), st.text("abc", max_size=9))
def test_search_like_brute_force(paths, word):
    trie = ca.Trie([])
    for i, p in enumerate(paths):
        trie._add(p, i, 2)
    trie.deepest = 2
    assert trie.search(word) == {i: e for i, p in enumerate(paths) if (e := distance(word, p)) <= 2}


def test_tables(spark):
    sep = spark.createDataFrame([("d", 1, "Residente de Obra Vial"), ("d", 1, "Residente de Obra Vial"), ("d", 2, ""), ("d", 3, None), ("d", 4, "Portero")], "doc_id string, page_number int, cargo_detectado string")
    sec = spark.createDataFrame([("d", 1, "Esp. en Acústica", 9)], "doc_id string, section_index int, cargo_raw string, cargo_id int")
    ref = spark.createDataFrame([*ENTRIES, ENTRIES[0], (9, None)], "cargo_id int, cargo_oficial string")
    assert {tuple(r) for r in ca.found(sep, sec, ref).collect()} == {("separators", "d", 1, 1), ("separators", "d", 4, -1), ("sections", "d", 1, 2)}
    assert {(r.value, r.n_rows) for r in ca.unmatched(sep, sec, ref).collect()} == {("Portero", 1)}
    assert {r.cargo_id for r in ca.found(sep, sec, ref.limit(0)).collect()} == {-1} and ca.found(sep.limit(0), sec.limit(0), ref).count() == 0


def test_all_entries_within_the_distance_also_beside_an_exact_one():
    tries = ca.tries(((1, "Residente de Obra Vial"), (2, "Residente de Obra Vital"), (3, "Médico Zonal")))
    assert ca.match("Residente de Obra Vial", tries) == [(1, 0), (2, 1)]


def test_values_may_be_as_long_as_an_entry(spark):
    long = "Especialista en " + " ".join(f"Materia{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(30))
    assert ca.match(long.upper(), ca.tries(((7, long), *ENTRIES)))[0] == (7, 0)


def test_blocks_of_entries_like_one(spark, monkeypatch):
    values = spark.createDataFrame([("Residente de Obra Vial",), ("Esp. en Acústica",), ("jefe logística almacenes",), ("Portero",), ("Especialista en Gestion",)], "value string")
    ref = spark.createDataFrame(list(ENTRIES), "cargo_id int, cargo_oficial string")
    rows = lambda: {(r.value, r.cargo_id, r.distance, tuple(map(tuple, r.candidates))) for r in ca.map_values(values, ref).collect()}
    one = rows()
    monkeypatch.setattr(ca, "BLOCK", 2)
    assert rows() == one and len(one) == 5
