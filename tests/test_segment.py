from dataclasses import replace

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from folioscope.config import DEFAULT
from folioscope.operators import segment as sg

PAGES = "doc_id string, page_number int, is_sep boolean, is_cut boolean"
SMALL = replace(DEFAULT, block=3)


def rows(spark, pages, seps, cuts=(), doc="d"):
    return spark.createDataFrame([(doc, p, p in seps, p in cuts) for p in pages], PAGES)


def listed(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.section_index, []).append(r.page_number)
    return {k: sorted(v) for k, v in out.items()}


def test_goldens(spark):
    assert listed(sg.section_pages(rows(spark, [5, 1, 3, 2, 6, 4], {1, 4}), config=SMALL)) == {1: [1, 2, 3], 2: [4, 5, 6]}
    assert sg.sections(rows(spark, [1, 2], set())).count() == 0
    g3 = rows(spark, range(1, 8), {2, 6}, {4, 6})
    assert listed(sg.section_pages(g3, config=SMALL)) == {1: [2, 3], 2: [6, 7]}
    assert sorted(r.page_number for r in sg.orphans(g3, SMALL).collect()) == [1, 4, 5]


def test_repeated_separator_leaves_an_empty_section(spark):
    r = rows(spark, [1, 2, 5, 5], {1, 5})
    assert {(x.section_index, x.separator_page, x.total_pages) for x in sg.sections(r, config=SMALL).collect()} == {(1, 1, 2), (2, 5, 0), (3, 5, 2)}


def by_hand(pages, seps, cuts):
    out, starts = {}, sorted(p for p in pages if p in seps)
    for i, s in enumerate(starts):
        end = starts[i + 1] - 1 if i + 1 < len(starts) else max(pages)
        cut = min([c for c in cuts if s < c <= end and c in pages], default=None)
        kept = [p for p in sorted(pages) if s <= p <= end and (cut is None or p < cut)]
        if kept:
            out[i + 1] = kept
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 25), min_size=1), st.sets(st.integers(0, 25), max_size=6), st.sets(st.integers(0, 25), max_size=6))
def test_like_by_hand(spark, pages, seps, cuts):
    assert listed(sg.section_pages(rows(spark, pages, seps, cuts), config=SMALL)) == by_hand(pages, seps, cuts)


def test_consolidation(spark):
    blocks = spark.createDataFrame(
        [("d", "Rol A N° 1", "a", "1", 1, 1, 2, 2, False), ("d", "Rol C", "c", None, 4, 4, 5, 2, False), ("d", "ROL A Nº1", "aa", "1", 7, 7, 8, 2, True), ("d", None, None, None, 9, None, None, 0, None)],
        "doc_id string, cargo string, cargo_raw string, numero string, separator_page int, first int, last int, total_pages long, has_tables boolean",
    )
    r = {x.section_index: x for x in sg.consolidate(blocks).select("*", sg.ranges_label().alias("ranges")).collect()}
    assert (r[1].cargo, r[1].cargo_raw, r[1].numero, r[1].total_pages, r[1].has_tables, r[1].ranges) == ("Rol A N° 1", "a", "1", 4, True, "1–2; 7–8")
    assert (r[2].cargo, r[2].numero, r[2].ranges) == ("Rol C", None, "4–5") and r[3].ranges == "9–9"
    assert sg.document_type(sg.consolidate(blocks)).first().doc_type == "B"
    assert sg.consolidate(blocks.limit(0)).count() == 0


def test_cut_points_are_a_set(spark):
    a = spark.createDataFrame([("d", 1), ("d", 2)], "doc_id string, page_number int")
    assert sg.cut_points(a, a).count() == 2
