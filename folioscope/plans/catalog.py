"""The queries of the page operators over the driver's tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.config import DEFAULT, Config
from folioscope.functions import fuzzy, text as tx
from folioscope.operators import detect, pages as pg, segment as sg
from folioscope.plans import process
from folioscope.session import cut, tables
from folioscope.sinks import reports
from folioscope.sources import jobs as job_source

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, expand: Callable[[str], str] | None = None):
    def keep(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = (expand or _shared)(sql)
        return f

    return keep


# ----------------------------------------------------------- SQL parts

_STRIP = r"regexp_replace({0}, '^[\s\pZ\x{{1C}}-\x{{1F}}\x{{85}}]+|[\s\pZ\x{{1C}}-\x{{1F}}\x{{85}}]+$', '', 'g')"
_STRIP_X = _STRIP.format("x")
_BLANK_X = f"(x IS NULL OR length({_STRIP_X}) = 0)"
_WORDS = ", ".join(f"'{w}'" for w in DEFAULT.role_words)
_NO = ", ".join(f"'{w}'" for w in DEFAULT.no_separator)
_DELIM = ", ".join(f"'{w}'" for w in DEFAULT.delimiters)

_NO_LINE = "'[\\p{Nd}²³¹⁰⁴-⁹₀-₉]+'"
_LINE_END = "'\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x{85}\\x{2028}\\x{2029}]'"


def _first_role(table: str, candidates: str, keys: str) -> str:
    """Tables up to ``first_role`` (keys, role): of the candidates (a list, in order) of each row of ``table`` the first that is similar to a role, with that role.

    The longest common subsequence is one integer for each role, of which a
    candidate's letters are worked off one by one.
    """
    roles = ", ".join(f"({i}, '{r}')" for i, r in enumerate(DEFAULT.roles))
    space = r"'[\s\pZ\x{{1C}}-\x{{1F}}\x{{85}}]+'"
    ordered = f"array_to_string(list_sort(list_filter(regexp_split_to_array(lower({{0}}), {space}), lambda w: w <> '')), ' ')"
    return (
        f"ro0 AS (SELECT * FROM (VALUES {roles}) v(ri, role)), ro AS (SELECT ri, role, {ordered.format('role')} AS rs FROM ro0), "
        "rm AS (SELECT ri, any_value(role) AS role, any_value(rs) AS rs, map_from_entries(list((c, m))) AS masks FROM (SELECT ri, role, rs, c, bit_or(1::UHUGEINT << (i - 1)::UHUGEINT) AS m FROM (SELECT ri, role, rs, unnest(string_split(rs, '')) AS c, unnest(range(1, length(rs) + 1)) AS i FROM ro) GROUP BY ALL) GROUP BY ri), "
        f"cd AS (SELECT DISTINCT c, {ordered.format('c')} AS cs FROM (SELECT unnest({candidates}) AS c FROM {table})), "
        "sc AS (SELECT c, ri, role, CASE WHEN length(rs) + length(cs) = 0 THEN 100.0 ELSE 200.0 * (length(rs) - bit_count(list_reduce(list_transform(string_split(cs, ''), lambda x: coalesce(masks[x], 0::UHUGEINT)), lambda v, x: ((v + (v & x)) | (v - (v & x))) & ((1::UHUGEINT << length(rs)::UHUGEINT) - 1), (1::UHUGEINT << length(rs)::UHUGEINT) - 1)::HUGEINT))::DOUBLE / (length(rs) + length(cs)) END AS score FROM cd CROSS JOIN rm "
        f"WHERE 200.0 * least(length(rs), length(cs)) >= {DEFAULT.fuzzy_score} * (length(rs) + length(cs)) - 1e-6), "
        f"best AS (SELECT c, arg_min(role, (-score, ri)) AS role FROM sc WHERE score >= {DEFAULT.fuzzy_score} - 1e-9 GROUP BY c), "
        f"first_role AS (SELECT {keys}, arg_min(b.role, o) AS role FROM (SELECT {keys}, unnest({candidates}) AS c, unnest(range(1, len({candidates}) + 1)) AS o FROM {table}) x JOIN best b ON x.c = b.c GROUP BY {keys})"
    )


def _candidates_of(c: str) -> tuple[str, str]:
    """SQL for the lines of a text that may hold a role, and, given them as ``ml``, for all candidates in order."""
    strip = _STRIP.format("x")
    lines = f"list_filter(list_transform(regexp_split_to_array({c}, {_LINE_END}), lambda x: {strip}), lambda x: length(x) > 0 AND NOT regexp_full_match(x, {_NO_LINE}) AND NOT regexp_full_match(x, '-+') AND NOT (length(x) <= 2 AND regexp_full_match(x, '\\pL+')))"
    grams = lambda n: f"list_transform(range(1, greatest(len(ml) - {n - 1}, 0) + 1), lambda i: array_to_string(ml[i:i + {n - 1}], ' '))"
    return lines, f"[{c}, array_to_string(ml, ' ')] || ml || {grams(2)} || {grams(3)}"


_PARTS = {
    # the last delivery of each page; deliveries of a page are otherwise equal
    "latest": "latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY ingested_at DESC) AS rn FROM pages) WHERE rn = 1)",
    "valid": "list_filter(line_scores, lambda x: x IS NOT NULL AND NOT isnan(x))",
    "n_lines": f"coalesce(len(list_filter(lines, lambda x: NOT {_BLANK_X})), 0)",
    "candidate": (
        f"cand AS (SELECT doc_id, page_number, text, lines, list_filter(list_transform(coalesce(lines, []), lambda x: {_STRIP_X}), lambda x: x IS NOT NULL AND length(x) > 2 AND NOT regexp_full_match(x, '[\\p{{Nd}}²³¹⁰⁴-⁹₀-₉]+')) AS clean FROM latest), "
        "cand2 AS (SELECT *, array_to_string(clean, ' ') AS t, strip_accents(lower(array_to_string(clean, ' '))) AS f FROM cand), "
        f"cand3 AS (SELECT *, len(clean) BETWEEN 1 AND {DEFAULT.separator_lines} AND length(t) >= 10 AND len(list_filter([{_WORDS}], lambda x: contains(f, x))) > 0 AND len(list_filter([{_NO}], lambda x: contains(f, x))) = 0 AND len(list_distinct(string_split(replace(t, ' ', ''), ''))) > 2 AS is_candidate FROM cand2)"
    ),
    "delimiter": (
        f"del1 AS (SELECT doc_id, page_number, list_filter(coalesce(lines, []), lambda x: NOT {_BLANK_X}) AS kept FROM latest), "
        f"del2 AS (SELECT *, list_filter(list_transform(kept, lambda x: {_STRIP_X}), lambda x: length(x) > 3 AND NOT regexp_full_match(x, '[\\p{{Nd}}²³¹⁰⁴-⁹₀-₉]+') AND NOT regexp_full_match(replace(x, ' ', ''), '[-.—*=]+')) AS telling FROM del1), "
        f"del3 AS (SELECT doc_id, page_number, len(telling) <= {DEFAULT.delimiter_lines} AND len(list_filter([{_DELIM}], lambda p: contains(strip_accents(lower(array_to_string(kept, ' '))), p))) > 0 AS is_delimiter FROM del2)"
    ),
    # the classifier's replies: (doc_id, page_number, es_separadora, cargo, confianza)
    "verdict": (
        "v0 AS (SELECT doc_id, page_number, raw_reply FROM classifier), "
        + f"v1 AS (SELECT doc_id, page_number, raw_reply, try_cast({_STRIP.format("regexp_replace(" + _STRIP.format("regexp_replace(" + _STRIP.format("string_split(raw_reply, '</think>')[-1]") + ", '^`+|`+$', '', 'g')") + ", '^json', '')")} AS JSON) AS d FROM v0), "
        "v2 AS (SELECT *, coalesce(json_type(d) = 'OBJECT', false) AS ok, json_type(d, '$.es_separadora') AS st, d->>'$.es_separadora' AS sv, json_type(d, '$.cargo') AS ct, d->>'$.cargo' AS cv, json_type(d, '$.confianza') AS ft, d->>'$.confianza' AS fv FROM v1), "
        "verdict AS (SELECT doc_id, page_number, raw_reply, ok AND CASE WHEN st IS NULL OR st = 'NULL' THEN false WHEN st = 'BOOLEAN' THEN sv = 'true' WHEN st = 'VARCHAR' THEN sv <> '' WHEN st = 'ARRAY' THEN sv <> '[]' WHEN st = 'OBJECT' THEN sv <> '{}' ELSE TRY_CAST(sv AS DOUBLE) <> 0 END AS es_separadora, "
        "CASE WHEN NOT ok OR ct IS NULL OR ct = 'NULL' OR cv IN ('', 'false', '0', '0.0', '[]', '{}') THEN '' ELSE cv END AS cargo, CASE WHEN NOT ok THEN 'error' WHEN ft IS NULL THEN 'baja' WHEN ft = 'NULL' THEN 'none' ELSE lower(fv) END AS confianza FROM v2)"
    ),
    "marked": (
        "sep AS (SELECT DISTINCT doc_id, page_number FROM separators WHERE es_separadora), "
        "cut AS (SELECT doc_id, page_number FROM separators WHERE NOT es_separadora UNION SELECT doc_id, page_number FROM del3 WHERE is_delimiter), "
        "m AS (SELECT l.doc_id, l.page_number, s.doc_id IS NOT NULL AS is_sep, c.doc_id IS NOT NULL AS is_cut FROM latest l LEFT JOIN sep s USING (doc_id, page_number) LEFT JOIN cut c USING (doc_id, page_number)), "
        "r1 AS (SELECT *, CAST(sum(CAST(is_sep AS INT)) OVER w AS INT) AS sec, max(CASE WHEN is_sep THEN page_number END) OVER w AS start FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY page_number)), "
        "r2 AS (SELECT *, min(CASE WHEN is_cut AND page_number > start THEN page_number END) OVER (PARTITION BY doc_id, sec) AS fc FROM r1), "
        "kept AS (SELECT * FROM r2 WHERE sec > 0 AND (fc IS NULL OR page_number < fc))"
    ),
}


def _shared(sql: str) -> str:
    for name, part in _PARTS.items():
        sql = sql.replace(f"@{name}", part)
    return sql


# ------------------------------------------------------------- pieces


def _pages(spark: SparkSession, d: str, *columns: str | Column) -> DataFrame:
    """Pages without repeated deliveries; only the columns asked for are read and shuffled.

    Deliveries of a page are otherwise equal, so what is needed of long columns
    is given as an expression, computed before the shuffle.
    """
    p = tables(spark, d, "pages")[0]
    return pg.latest(p.select("doc_id", "page_number", *columns, "ingested_at") if columns else p)


def _delimiter(config: Config = DEFAULT) -> Column:
    return detect.is_delimiter(F.col("lines"), config).alias("is_delimiter")


def _marked(spark: SparkSession, d: str, config: Config = DEFAULT) -> DataFrame:
    separators = tables(spark, d, "separators")[0]
    pages = _pages(spark, d, _delimiter(config))
    # a narrow table that several windows and joins read: written once
    return cut(sg.marked(pages, separators.where("es_separadora"), separators.where("NOT es_separadora")))


def _roles(spark: SparkSession, d: str) -> DataFrame:
    """One row per separator page with its role."""
    s = tables(spark, d, "separators")[0].where("es_separadora")
    return s.groupBy("doc_id", "page_number").agg(F.max("cargo_normalizado").alias("cargo"), F.max("cargo_detectado").alias("cargo_raw"))


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    marked = _marked(spark, d)
    tabled = _pages(spark, d, F.coalesce("tiene_tabla", F.lit(False)).alias("t")).select(*pg.KEYS, "t")
    has = sg.section_pages(marked).join(tabled, pg.KEYS).groupBy("doc_id", "section_index").agg(F.bool_or("t").alias("has_tables"))
    s = sg.sections(marked).join(_roles(spark, d).withColumnRenamed("page_number", "separator_page"), ["doc_id", "separator_page"], "left").join(has, ["doc_id", "section_index"], "left")
    return s.withColumn("numero", tx.post_number(F.col("cargo"))).withColumn("has_tables", F.coalesce("has_tables", F.lit(False)))


# ------------------------------------------------------------ queries


@query("WITH @latest, @delimiter, @marked SELECT k.doc_id, k.sec AS section_index, min(k.start) AS separator_page, min(k.page_number) AS first, max(k.page_number) AS last, count(*) AS total_pages FROM kept k GROUP BY ALL")
def segment(spark, d):
    """Sections between separators, trimmed at the first cut point."""
    return sg.sections(_marked(spark, d))


@query("WITH @latest, @delimiter, @marked SELECT doc_id, sec AS section_index, min(start) AS separator_page, min(page_number) AS first, max(page_number) AS last, count(*) AS total_pages FROM r1 WHERE sec > 0 GROUP BY doc_id, sec")
def sections_untrimmed(spark, d):
    return sg.sections(_marked(spark, d), trim=False)


@query("WITH @latest, @delimiter, @marked, b AS (SELECT doc_id, page_number AS lo, coalesce(lead(page_number) OVER (PARTITION BY doc_id ORDER BY page_number) - 1, 1000000000) AS hi, row_number() OVER (PARTITION BY doc_id ORDER BY page_number) AS i FROM m WHERE is_sep) SELECT l.doc_id, l.page_number, CAST(b.i AS INT) AS section_index FROM latest l JOIN b ON l.doc_id = b.doc_id AND l.page_number BETWEEN b.lo AND b.hi")
def interval_join(spark, d):
    """Pages with the separator interval they lie in; a running sum in place of a range join."""
    return sg.section_pages(_marked(spark, d), trim=False)


@query("WITH @latest, @delimiter, @marked SELECT doc_id, sec AS section_index, page_number FROM kept")
def section_page_list(spark, d):
    return sg.section_pages(_marked(spark, d))


@query("WITH @latest, @delimiter, @marked SELECT doc_id, page_number FROM m EXCEPT SELECT doc_id, page_number FROM kept")
def orphan_pages(spark, d):
    return sg.orphans(_marked(spark, d))


@query("WITH @latest, @delimiter, @marked SELECT doc_id, page_number FROM cut")
def cut_points(spark, d):
    """Discarded candidates and delimiter pages, each page once."""
    return sg.cut_points(tables(spark, d, "separators")[0].where("NOT es_separadora"), _pages(spark, d, _delimiter()).where("is_delimiter"))


_CONSOLIDATED = (
    "WITH @latest, @delimiter, @marked, role AS (SELECT doc_id, page_number, max(cargo_normalizado) AS cargo, max(cargo_detectado) AS cargo_raw FROM separators WHERE es_separadora GROUP BY 1, 2), "
    "b AS (SELECT k.doc_id, sec, min(start) AS sp, min(page_number) AS first, max(page_number) AS last, count(*) AS n, bool_or(coalesce(l.tiene_tabla, false)) AS tabled FROM kept k JOIN latest l USING (doc_id, page_number) GROUP BY 1, 2), "
    f"k AS (SELECT b.*, cargo, cargo_raw, regexp_replace(lower({_STRIP.format('cargo')}), 'n[°º]?\\s*(\\d+)', 'n°\\1', 'g') AS key, nullif(regexp_extract(lower(cargo), 'n[°º]?\\s*(\\d+)', 1), '') AS num FROM b JOIN role r ON b.doc_id = r.doc_id AND b.sp = r.page_number), "
    "c AS (SELECT doc_id, key, arg_min(cargo, sp) AS cargo, arg_min(cargo_raw, sp) AS cargo_raw, arg_min(coalesce(num, ''), sp) AS num1, min(sp) AS separator_page, CAST(sum(n) AS BIGINT) AS total_pages, bool_or(tabled) AS has_tables, count(*) AS n_blocks, string_agg(first || '–' || last, '; ' ORDER BY first) AS ranges FROM k GROUP BY 1, 2)"
)


@query(_CONSOLIDATED + " SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY separator_page) AS INT) AS section_index, key, cargo, cargo_raw, CASE WHEN n_blocks > 1 THEN nullif(regexp_extract(lower(cargo), 'n[°º]?\\s*(\\d+)', 1), '') ELSE nullif(num1, '') END AS numero, separator_page, total_pages, has_tables, n_blocks, ranges FROM c")
def consolidate(spark, d):
    """Repeated sections of a role as one."""
    return sg.consolidate(_blocks(spark, d)).select("doc_id", "section_index", "key", "cargo", "cargo_raw", "numero", "separator_page", "total_pages", "has_tables", "n_blocks", sg.ranges_label().alias("ranges"))


@query(_CONSOLIDATED + " SELECT doc_id, max(n_blocks) AS most_blocks, count(*) AS n_roles, CASE WHEN max(n_blocks) > 1 THEN 'B' ELSE 'A' END AS doc_type FROM c GROUP BY doc_id")
def document_type(spark, d):
    return sg.document_type(sg.consolidate(_blocks(spark, d)))


@query("WITH @latest, v AS (SELECT doc_id, page_number, @valid AS s FROM latest) SELECT doc_id, page_number, round(list_avg(s), 9) AS conf_promedio, round(list_median(s), 9) AS conf_mediana, round(list_min(s), 9) AS conf_min, round(list_max(s), 9) AS conf_max, round(list_stddev_pop(s), 9) AS conf_std, coalesce(len(list_filter(s, lambda x: x < 0.85)), 0) AS lineas_baja_confianza FROM v")
def page_metrics(spark, d):
    # the metrics of a row need no other row, so they are what is shuffled
    m = pg.latest(pg.score_metrics(tables(spark, d, "pages")[0].select(*pg.KEYS, "ingested_at", "line_scores"), "line_scores", [*pg.KEYS, "ingested_at"]))
    return m.select(*pg.KEYS, *[F.round(c, 9).alias(c) for c in ("conf_promedio", "conf_mediana", "conf_min", "conf_max", "conf_std")], F.col("lineas_baja_confianza").cast("bigint").alias("lineas_baja_confianza"))


@query("WITH @latest, e AS (SELECT source, unnest(@valid) AS s FROM latest) SELECT source, round(quantile_cont(s, 0.25), 6) AS q25, round(quantile_cont(s, 0.5), 6) AS q50, round(quantile_cont(s, 0.75), 6) AS q75 FROM e GROUP BY source")
def quartiles(spark, d):
    """Exact quartiles with linear interpolation of each source's scores; equal values are counted before they meet."""
    e = _pages(spark, d, "source", "line_scores").select("source", F.explode(pg.valid_scores(F.col("line_scores"))).alias("s")).groupBy("source", "s").agg(F.count("*").alias("n"))
    q = e.groupBy("source").agg(F.percentile("s", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"))
    return q.select("source", *[F.round(F.col("q")[i], 6).alias(c) for i, c in enumerate(("q25", "q50", "q75"))])


_BIN = "CASE " + " ".join(f"WHEN s >= {a} AND s < {b} THEN {a}" for a, b in zip(DEFAULT.histogram, DEFAULT.histogram[1:])) + " END"


@query(f"WITH @latest, e AS (SELECT source, unnest(@valid) AS s FROM latest), b AS (SELECT source, CAST({_BIN} AS DOUBLE) AS low FROM e), t AS (SELECT source, count(*) AS total FROM b GROUP BY 1) SELECT b.source, low, count(*) AS n, round(count(*) * 100 / any_value(total), 4) AS percent FROM b JOIN t USING (source) WHERE low IS NOT NULL GROUP BY b.source, low")
def histogram(spark, d):
    return pg.histogram(_pages(spark, d, "source", "line_scores"), ["source"])


@query("WITH @latest SELECT angle_detected, count(*) AS n FROM latest GROUP BY 1")
def angle_frequency(spark, d):
    return _pages(spark, d, "angle_detected").groupBy("angle_detected").agg(F.count("*").alias("n"))


_ROUTE = "engine_used <> 'error' AND conf_promedio IS NOT NULL AND n_lines > 15 AND conf_promedio < 0.85 AND tasa_descarte > 0.35"


@query(f"WITH @latest, n AS (SELECT *, @n_lines AS n_lines FROM latest) SELECT doc_id, page_number, coalesce({_ROUTE}, false) AS second_pass, round(CASE WHEN det_count > 0 THEN (det_count - rec_count) / det_count ELSE 0 END, 6) AS discard FROM n")
def route(spark, d):
    """Pages that a second recogniser shall read."""
    return _pages(spark, d, pg.needs_second_pass().alias("second_pass"), F.round(pg.discard_rate(F.col("det_count"), F.col("rec_count")), 6).alias("discard")).drop("ingested_at")


@query("WITH @latest SELECT doc_id, page_number, CASE WHEN conf_promedio < 0.85 OR tasa_descarte > 0.20 THEN 'reroute' WHEN lineas_baja_confianza > 0 THEN 'evaluate' ELSE 'use' END AS advice FROM latest")
def legacy_route(spark, d):
    return _pages(spark, d, "conf_promedio", "tasa_descarte", "lineas_baja_confianza").select(*pg.KEYS, pg.legacy_advice().alias("advice"))


@query("WITH @latest, f AS (SELECT doc_id, page_number, 'paddle' AS engine_used, length(text) AS n_chars FROM latest), s AS (SELECT doc_id, page_number, engine_used, length(text) AS n_chars FROM latest WHERE engine_used <> 'paddle') SELECT doc_id, page_number, CASE WHEN s.engine_used IS NOT NULL THEN s.engine_used ELSE f.engine_used END AS engine_used, CASE WHEN s.engine_used IS NOT NULL THEN s.n_chars ELSE f.n_chars END AS n_chars FROM f LEFT JOIN s USING (doc_id, page_number)")
def override(spark, d):
    """First-pass rows replaced by second-pass rows, errors too."""
    p = _pages(spark, d, "engine_used", F.length("text").cast("bigint").alias("n_chars"))
    return pg.override(p.select(*pg.KEYS, F.lit("paddle").alias("engine_used"), "n_chars"), p.where("engine_used <> 'paddle'").select(*pg.KEYS, "engine_used", "n_chars"))


@query("WITH @latest SELECT doc_id, count(*) AS total_pages, count(*) FILTER (engine_used = 'paddle') AS pages_paddle, count(*) FILTER (engine_used = 'qwen') AS pages_qwen, count(*) FILTER (engine_used = 'error') AS pages_error, round(coalesce(avg(conf_promedio), 0), 6) AS conf_promedio_documento, round(sum(tiempo_total), 4) AS tiempo_total, CASE WHEN count(*) FILTER (engine_used = 'error') > 0 THEN 'red' WHEN coalesce(avg(conf_promedio), 0) < 0.85 THEN 'yellow' ELSE 'green' END AS status FROM latest GROUP BY doc_id")
def doc_summary(spark, d):
    s = pg.documents(_pages(spark, d, "engine_used", "conf_promedio", "tiempo_total"))
    return s.withColumn("conf_promedio_documento", F.round("conf_promedio_documento", 6)).withColumn("tiempo_total", F.round("tiempo_total", 4))


@query("WITH @latest SELECT doc_id, CAST(page_number // 256 AS INT) AS part, count(*) AS n_pages, md5(string_agg(text, chr(10) || chr(10) ORDER BY page_number)) AS digest FROM latest WHERE engine_used <> 'error' AND text IS NOT NULL GROUP BY 1, 2")
def doc_text(spark, d):
    """Each file's text by parts of 256 pages; its digest, as the texts are long."""
    return pg.texts_in_parts(_pages(spark, d, "engine_used", "text"), True).select("doc_id", "part", "n_pages", F.md5("text").alias("digest"))


@query(f"WITH @latest, @delimiter, @marked SELECT k.doc_id, k.sec AS section_index, CAST(page_number // 256 AS INT) AS part, count(*) AS n_pages, md5(string_agg(l.text, chr(10) || chr(10) ORDER BY page_number)) AS digest FROM kept k JOIN latest l USING (doc_id, page_number) WHERE l.engine_used <> 'error' AND l.text IS NOT NULL AND length({_STRIP.format('l.text')}) > 0 GROUP BY 1, 2, 3")
def section_text(spark, d):
    """Each section's text by parts; the text is joined to the pages only after the sections are known."""
    p = _pages(spark, d, "engine_used", "text")
    rows = sg.section_pages(_marked(spark, d)).join(p, pg.KEYS)
    return pg.texts_in_parts(rows, False, ("doc_id", "section_index")).select("doc_id", "section_index", "part", "n_pages", F.md5("text").alias("digest"))


@query(f"WITH @latest SELECT doc_id, page_number, @n_lines AS n_lines, coalesce(array_to_string(list_filter(lines, lambda x: NOT {_BLANK_X}), chr(10)), '') AS text FROM latest")
def line_filter(spark, d):
    """Lines that aren't blank, counted and put together."""
    p = _pages(spark, d, "lines")
    return p.select(*pg.KEYS, pg.line_count(F.col("lines")).cast("bigint").alias("n_lines"), F.coalesce(F.array_join(tx.kept_lines(F.col("lines")), "\n"), F.lit("")).alias("text"))


@query("WITH @latest, e AS (SELECT doc_id, page_number, unnest(range(1, greatest(len(lines), len(line_scores)) + 1)) AS line_no, lines, line_scores FROM latest WHERE engine_used = 'paddle' AND lineas_baja_confianza > 0) SELECT doc_id, page_number, line_no, lines[line_no] AS line, line_scores[line_no] AS score FROM e WHERE line_scores[line_no] < 0.85 AND NOT isnan(line_scores[line_no])")
def low_lines(spark, d):
    low = _pages(spark, d, pg.low_entries().alias("low"))
    return low.select(*pg.KEYS, F.inline("low")).withColumn("line_no", F.col("line_no").cast("bigint"))


@query(f"SELECT DISTINCT doc_id, page_number, cargo_detectado, strip_accents(lower(cargo_detectado)) AS folded, {_STRIP.format('cargo_detectado')} AS stripped, regexp_replace(lower({_STRIP.format('cargo_detectado')}), 'n[°º]?\\s*(\\d+)', 'n°\\1', 'g') AS key, nullif(regexp_extract(lower(cargo_detectado), 'n[°º]?\\s*(\\d+)', 1), '') AS numero FROM separators")
def role_text(spark, d):
    """The text functions over roles: folding, stripping, key, number of the post."""
    c = F.col("cargo_detectado")
    return tables(spark, d, "separators")[0].select("doc_id", "page_number", c, tx.fold(c).alias("folded"), tx.strip(c).alias("stripped"), tx.group_key(c).alias("key"), tx.post_number(c).alias("numero")).distinct()


def _nested_replace(c: str = "cargo_detectado") -> str:
    sql = f"lower({_STRIP.format(c)})"
    for a, b in DEFAULT.misreadings:
        sql = f"replace({sql}, '{a}', '{b.lower()}')"
    return sql


_TITLED = "array_to_string(list_transform(regexp_extract_all({0}, '[\\pL\\pM]+|[^\\pL\\pM]+'), lambda x: upper(x[1]) || x[2:]), '')"


@query(f"WITH n AS (SELECT DISTINCT cargo_detectado, {_nested_replace()} AS r FROM separators WHERE cargo_detectado IS NOT NULL) SELECT cargo_detectado, array_to_string(list_transform(regexp_extract_all(r, '[\\pL\\pM]+|[^\\pL\\pM]+'), lambda x: upper(x[1]) || x[2:]), '') AS cargo_normalizado FROM n")
def normal_roles(spark, d):
    c = F.col("cargo_detectado")
    return tables(spark, d, "separators")[0].where(c.isNotNull()).select(c).distinct().select(c, tx.normal_role(c).alias("cargo_normalizado"))


@query("WITH @latest, @candidate SELECT doc_id, page_number FROM cand3 WHERE is_candidate")
def candidates(spark, d):
    return _pages(spark, d, detect.is_candidate(F.col("lines")).alias("is_candidate")).where("is_candidate").select(*pg.KEYS)


@query("WITH @latest, @delimiter SELECT doc_id, page_number FROM del3 WHERE is_delimiter")
def delimiters(spark, d):
    return _pages(spark, d, _delimiter()).where("is_delimiter").select(*pg.KEYS)


@query("WITH @verdict SELECT doc_id, page_number, es_separadora, cargo, confianza, es_separadora AND confianza IN ('alta', 'media') AND length(" + _STRIP.format("cargo") + ") > 0 AS accepted FROM verdict")
def verdicts(spark, d):
    """The classifier's replies, parsed."""
    v = tables(spark, d, "classifier")[0].select("doc_id", "page_number", detect.verdict(F.col("raw_reply")).alias("v"))
    return v.select("doc_id", "page_number", "v.es_separadora", "v.cargo", "v.confianza", detect.accepted(F.col("v")).alias("accepted"))


@query(f"SELECT doc_id, page_number, {_STRIP.format("string_split(raw_reply, '</think>')[-1]")} AS reply FROM classifier WHERE raw_reply IS NOT NULL")
def after_thought(spark, d):
    """Replies without what the model thought before."""
    return tables(spark, d, "classifier")[0].where("raw_reply IS NOT NULL").select("doc_id", "page_number", tx.after_thought(F.col("raw_reply")).alias("reply"))


_ML, _CANDS = _candidates_of("text")
_CASCADE = (
    f"WITH @latest, @candidate, @verdict, ca AS (SELECT doc_id, page_number, coalesce(text, '') AS text FROM cand3 WHERE is_candidate), one AS (SELECT doc_id, page_number, max(raw_reply) AS raw_reply FROM classifier GROUP BY ALL), "
    "j AS (SELECT ca.*, coalesce(v.es_separadora, false) AS said, coalesce(v.cargo, '') AS vc, coalesce(v.confianza, 'error') AS conf FROM ca LEFT JOIN (SELECT DISTINCT v.* FROM verdict v JOIN one o ON v.doc_id = o.doc_id AND v.page_number = o.page_number AND v.raw_reply IS NOT DISTINCT FROM o.raw_reply) v USING (doc_id, page_number)), "
    f"y AS (SELECT *, said AND conf IN ('alta', 'media') AND length({_STRIP.format('vc')}) > 0 AS yes, {_ML} AS ml FROM j), u AS (SELECT doc_id, page_number, {_CANDS} AS cands FROM y WHERE NOT yes), "
    + _first_role("u", "cands", "doc_id, page_number")
    + ", e AS (SELECT doc_id, page_number, yes, conf, role, CASE WHEN yes THEN vc ELSE coalesce(role, '') END AS cargo_detectado FROM y LEFT JOIN first_role USING (doc_id, page_number)) "
)


@query(_CASCADE + f"SELECT doc_id, page_number, yes OR role IS NOT NULL AS es_separadora, cargo_detectado, {_TITLED.format(_nested_replace())} AS cargo_normalizado, conf AS confianza_qwen, CASE WHEN yes THEN 'qwen' WHEN role IS NOT NULL THEN 'fuzzy_fallback' ELSE 'descartada' END AS metodo FROM e")
def cascade(spark, d):
    """Candidates judged by classifier, else by similarity, else discarded. Only the texts of candidates are shuffled."""
    candidates = _pages(spark, d, F.when(detect.is_candidate(F.col("lines")), F.coalesce("text", F.lit(""))).alias("text")).where("text IS NOT NULL")
    return detect.evaluate(candidates, tables(spark, d, "classifier")[0])


_ML_ROLE, _CANDS_ROLE = _candidates_of("cargo_detectado")


@query(f"WITH r AS (SELECT cargo_detectado, {_ML_ROLE} AS ml FROM (SELECT DISTINCT cargo_detectado FROM separators WHERE cargo_detectado <> '')), u AS (SELECT cargo_detectado, {_CANDS_ROLE} AS cands FROM r), " + _first_role("u", "cands", "cargo_detectado") + " SELECT cargo_detectado, role FROM u LEFT JOIN first_role USING (cargo_detectado)")
def fuzzy_roles(spark, d):
    """For each distinct role as detected the first catalogue role that is similar enough."""
    rows = tables(spark, d, "separators")[0].where("cargo_detectado <> ''").select("cargo_detectado").distinct()
    return fuzzy.with_first_role(rows.withColumn("c", tx.match_candidates(F.col("cargo_detectado"))), "c", "role", DEFAULT.roles, DEFAULT.fuzzy_score)


@query(f"WITH @latest, @candidate, t AS (SELECT doc_id, page_number, coalesce(text, '') AS text, {_ML.replace('(text,', "(coalesce(text, ''),")} AS ml FROM cand3 WHERE is_candidate), c AS (SELECT doc_id, page_number, {_CANDS} AS cands FROM t) SELECT doc_id, page_number, unnest(range(1, len(cands) + 1)) AS place, unnest(cands) AS candidate FROM c")
def match_candidates(spark, d):
    """What is compared with the roles, in order: text, cleaned text, lines, pairs and triples of lines."""
    p = _pages(spark, d, F.when(detect.is_candidate(F.col("lines")), F.coalesce("text", F.lit(""))).alias("text")).where("text IS NOT NULL")
    return p.select(*pg.KEYS, F.posexplode(tx.match_candidates(F.col("text"))).alias("p", "candidate")).select(*pg.KEYS, (F.col("p") + 1).cast("bigint").alias("place"), "candidate")


def _line_ngrams(pages: DataFrame) -> DataFrame:
    k = pages.withColumn("l", tx.kept_lines(F.col("lines")))
    parts = [k.select(*pg.KEYS, F.lit(n).alias("n"), F.posexplode(tx.ngrams(F.col("l"), n)).alias("p", "gram")) for n in (2, 3)]
    return parts[0].unionByName(parts[1]).select(*pg.KEYS, "n", (F.col("p") + 1).cast("bigint").alias("pos"), "gram")


@query(f"WITH @latest, k AS (SELECT doc_id, page_number, list_filter(lines, lambda x: NOT {_BLANK_X}) AS l FROM latest WHERE len(lines) <= 15) SELECT doc_id, page_number, 2 AS n, i AS pos, l[i] || ' ' || l[i + 1] AS gram FROM k, unnest(range(1, len(l))) AS u(i) UNION ALL SELECT doc_id, page_number, 3, i, l[i] || ' ' || l[i + 1] || ' ' || l[i + 2] FROM k, unnest(range(1, len(l) - 1)) AS u(i)")
def line_ngrams(spark, d):
    """Pairs and triples of neighbouring lines of pages with few lines."""
    p = tables(spark, d, "pages")[0].where(F.size("lines") <= DEFAULT.separator_lines)
    return _line_ngrams(pg.latest(p.select(*pg.KEYS, "lines", "ingested_at")))


@query(f"WITH @latest, k AS (SELECT doc_id, page_number, list_filter(lines, lambda x: NOT {_BLANK_X}) AS l FROM latest) SELECT doc_id, page_number, 2 AS n, i AS pos, l[i] || ' ' || l[i + 1] AS gram FROM k, unnest(range(1, len(l))) AS u(i) UNION ALL SELECT doc_id, page_number, 3, i, l[i] || ' ' || l[i + 1] || ' ' || l[i + 2] FROM k, unnest(range(1, len(l) - 1)) AS u(i)")
def ngrams(spark, d):
    """Pairs and triples of neighbouring lines of all pages."""
    return _line_ngrams(_pages(spark, d, "lines").where("lines is not null"))


@query(f"WITH @latest, t AS (SELECT doc_id, page_number, text, row_number() OVER (PARTITION BY doc_id ORDER BY page_number) AS rn FROM latest WHERE engine_used <> 'error' AND length({_STRIP.format('text')}) > 0) SELECT doc_id, page_number, replace(replace(text[1:80], chr(10), ' '), '|', '\\|') AS preview FROM t WHERE rn <= 2")
def top_previews(spark, d):
    """The first two pages with text of each file, as previews. The two are found by partial aggregation, without a window over the file."""
    holds = (F.col("engine_used") != "error") & ~tx.blank(F.col("text"))
    short = _pages(spark, d, F.when(holds, F.replace(tx.preview(F.col("text"), 80, " "), F.lit("|"), F.lit("\\|"))).alias("preview")).where("preview IS NOT NULL").select(*pg.KEYS, "preview")
    first = short.groupBy("doc_id").agg(F.min(F.struct("page_number", "preview")).alias("a"))
    rest = short.join(first.select("doc_id", F.col("a.page_number").alias("one")), "doc_id").where("page_number > one").groupBy("doc_id").agg(F.min(F.struct("page_number", "preview")).alias("a"))
    return first.unionByName(rest).select("doc_id", "a.page_number", "a.preview")


@query("WITH @latest SELECT doc_id, CAST(page_number // 256 AS INT) AS part, page_number, coalesce(text, '') AS text FROM latest")
def map_text(spark, d):
    """The maps from page to text, opened again."""
    return pg.text_by_page(_pages(spark, d, "text")).select("doc_id", "part", F.explode("texts").alias("page_number", "text"))


@query("WITH @latest, s AS (SELECT doc_id, page_number, CAST(floor(coalesce(tiempo_total, 0) * 100) AS BIGINT) AS s FROM latest) SELECT doc_id, page_number, CASE WHEN s <= 0 THEN '0s' WHEN s >= 3600 THEN lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || 'h' || lpad(CAST((s % 3600) // 60 AS VARCHAR), 2, '0') || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' WHEN s >= 60 THEN lpad(CAST(s // 60 AS VARCHAR), 2, '0') || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' ELSE CAST(s AS VARCHAR) || 's' END AS eta FROM s")
def eta(spark, d):
    """Durations of a hundred times each page's time as text."""
    return _pages(spark, d, "tiempo_total").select(*pg.KEYS, tx.eta(F.col("tiempo_total") * 100).alias("eta"))


@query("WITH @latest SELECT doc_id, page_number, CASE WHEN engine_used = 'error' THEN coalesce(nullif(fallback_reason, ''), 'error') WHEN engine_used <> 'paddle' THEN 'qwen' WHEN conf_promedio < 0.85 THEN 'conf baja' WHEN tasa_descarte > 0.35 THEN 'descarte alto' WHEN lineas_baja_confianza > 0 THEN lineas_baja_confianza || ' líneas bajas' ELSE 'ok' END AS status FROM latest")
def page_status(spark, d):
    p = _pages(spark, d, "engine_used", "fallback_reason", "conf_promedio", "tasa_descarte", "lineas_baja_confianza")
    return p.select(*pg.KEYS, pg.page_status().alias("status"))


@query("SELECT doc_id, count(*) FILTER (es_separadora) AS n_separators, count(*) FILTER (NOT es_separadora) AS n_discarded FROM (SELECT DISTINCT doc_id, page_number, es_separadora FROM separators) GROUP BY doc_id")
def separator_counts(spark, d):
    s = tables(spark, d, "separators")[0].select("doc_id", "page_number", "es_separadora").distinct()
    return s.groupBy("doc_id").agg(F.count_if("es_separadora").alias("n_separators"), F.count_if(~F.col("es_separadora")).alias("n_discarded"))


@query("WITH @latest SELECT image_path, coalesce(TRY_CAST(list_extract(string_split(regexp_replace(regexp_extract(image_path, '([^/]*)$', 1), '\\.[^.]*$', ''), '_'), -1) AS INT), 0) AS page FROM latest WHERE image_path IS NOT NULL")
def page_of_path(spark, d):
    return _pages(spark, d, "image_path").where("image_path IS NOT NULL").select("image_path", tx.page_of_path(F.col("image_path")).alias("page"))


@query("WITH @latest, j AS (SELECT job_id, doc_id, pages FROM jobs), want AS (SELECT job_id, doc_id, unnest(pages) AS page_number FROM j WHERE len(pages) > 0 UNION ALL SELECT job_id, doc_id, page_number FROM j JOIN latest USING (doc_id) WHERE coalesce(len(pages), 0) = 0) SELECT w.job_id, w.doc_id, w.page_number, l.engine_used FROM want w JOIN latest l USING (doc_id, page_number)")
def requested_pages(spark, d):
    """The pages that jobs ask for: all of a file for an empty list; repeated requests stay, missing pages are skipped."""
    return job_source.requested(tables(spark, d, "jobs")[0], _pages(spark, d, "engine_used")).select("job_id", "doc_id", "page_number", "engine_used")


@query("SELECT job_id, doc_id, CASE WHEN coalesce(nullif(mode, ''), 'segmentation') = 'ocr_only' THEN 'ocr_only' ELSE 'segmentation' END AS mode, coalesce(keep_images, false) AS keep_images, regexp_replace(regexp_extract(pdf_path, '([^/]*)$', 1), '\\.[^.]*$', '') AS stem FROM jobs")
def job_modes(spark, d):
    return job_source.modes(tables(spark, d, "jobs")[0])


@query("SELECT doc_id, section_index, count(DISTINCT page_number) AS n_pages, min(page_number) AS first, max(page_number) AS last FROM section_pages GROUP BY 1, 2")
def section_ranges(spark, d):
    s = tables(spark, d, "section_pages")[0].distinct()
    return s.groupBy("doc_id", "section_index").agg(F.count("*").alias("n_pages"), F.min("page_number").alias("first"), F.max("page_number").alias("last"))


@query("SELECT doc_id, section_index, cargo, b.start AS start, b.\"end\" AS stop, b.separator_page AS separator_page, len(bloques_origen) > 1 AS type_b FROM (SELECT *, unnest(bloques_origen) AS b FROM sections)")
def origin_blocks(spark, d):
    s = tables(spark, d, "sections")[0]
    return s.select("doc_id", "section_index", "cargo", (F.size("bloques_origen") > 1).alias("type_b"), F.explode("bloques_origen").alias("b")).select("doc_id", "section_index", "cargo", F.col("b.start").alias("start"), F.col("b.end").alias("stop"), F.col("b.separator_page").alias("separator_page"), "type_b")


_FIXED = "CASE WHEN isnan({0}) THEN 'nan' ELSE printf('%.{1}f', {0}) END"


@query(f"WITH @latest SELECT doc_id, page_number, CASE engine_used WHEN 'paddle' THEN '🔵 ' WHEN 'qwen' THEN '🟠 ' WHEN 'error' THEN '🔴 ' ELSE '' END || engine_used || CASE WHEN conf_promedio IS NOT NULL THEN ' · conf ' || {_FIXED.format('conf_promedio', 3)} ELSE '' END || CASE WHEN angle_detected <> 0 THEN ' · ' || angle_detected || '°' ELSE '' END AS header FROM latest")
def page_headers(spark, d):
    return _pages(spark, d, pg.header_tags().alias("header")).select(*pg.KEYS, "header")


@query(f"WITH @latest, n AS (SELECT *, @n_lines AS n_lines FROM latest) SELECT doc_id, page_number, CASE WHEN coalesce({_ROUTE}, false) THEN 'confianza baja (' || {_FIXED.format('conf_promedio', 3)} || ') y descarte alto (' || {_FIXED.format('(tasa_descarte * 100)', 1)} || '%)' ELSE '' END AS reason, CASE WHEN conf_promedio IS NOT NULL THEN 'confianza baja (' || {_FIXED.format('conf_promedio', 3)} || ') y descarte alto (' || {_FIXED.format('(tasa_descarte * 100)', 1)} || '%)' END AS said FROM n")
def reasons(spark, d):
    """Why pages are read again, and the same words for every page with a confidence."""
    said = F.when(F.col("conf_promedio").isNotNull(), pg.reason_text(F.col("conf_promedio"), F.col("tasa_descarte")))
    return _pages(spark, d, pg.second_pass_reason().alias("reason"), said.alias("said")).select(*pg.KEYS, "reason", "said")


@query(f"WITH v AS (SELECT DISTINCT l_extendedprice::DOUBLE / 1024 AS x, (l_orderkey % 10000)::DOUBLE / 2000 + 0.0005::DOUBLE AS y FROM lineitem) SELECT x, y, {_FIXED.format('x', 1)} AS x1, {_FIXED.format('x', 3)} AS x3, {_FIXED.format('x', 4)} AS x4, {_FIXED.format('y', 3)} AS y3, {_FIXED.format('(y / 32)', 4)} AS y4 FROM v")
def numbers(spark, d):
    """Numbers as text with one, three and four digits, many of them just between two results: half to even on the exact value."""
    x, y = F.col("l_extendedprice").cast("double") / 1024, (F.col("l_orderkey") % 10000).cast("double") / 2000 + F.lit(0.0005)
    v = tables(spark, d, "lineitem")[0].select(x.alias("x"), y.alias("y")).distinct()
    return v.select("x", "y", tx.fixed(F.col("x"), 1).alias("x1"), tx.fixed(F.col("x"), 3).alias("x3"), tx.fixed(F.col("x"), 4).alias("x4"), tx.fixed(F.col("y"), 3).alias("y3"), tx.fixed(F.col("y") / 32, 4).alias("y4"))


# ------------------------------------- recorded results of the recogniser


def _recorded(spark: SparkSession, d: str) -> DataFrame:
    """The pages table in the shape of recorded recognition results; regions, angles and boxes are made from its counts, by a rule that the SQL repeats."""
    p = tables(spark, d, "pages")[0].where("engine_used <> 'qwen'")
    box = lambda i: F.array(F.array(i, F.col("page_number")), F.array(i + 10, F.col("page_number") + 5))
    n = F.size(F.coalesce("lines", F.array().cast("array<string>")))
    at = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: i)
    shapes = lambda f: F.when(n > 0, F.transform(at, f)).otherwise(F.array().cast("array<array<array<int>>>"))
    angles = F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.when(i % 7 == 3, F.lit(180)).otherwise(F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return p.select(
        *pg.KEYS, "image_path", "ingested_at", F.col("lines").alias("rec_texts"), F.col("line_scores").alias("rec_scores"), F.transform(F.sequence(F.lit(1), F.greatest("det_count", F.lit(1))), box).alias("all_polys"), "det_count",
        F.col("angle_detected").alias("angle"), angles.alias("angles"), shapes(box).alias("polys"), shapes(box).alias("boxes"),
    ).withColumn("dt_polys", F.when(F.col("det_count") > 0, F.col("all_polys")))


_RECORDED = "rec AS (SELECT doc_id, page_number, image_path, coalesce(lines, []) AS t, coalesce(line_scores, []) AS s, greatest(det_count, 0) AS det, angle_detected FROM latest WHERE engine_used <> 'qwen')"
_KEPT = (
    f"{_RECORDED}, nk AS (SELECT *, CASE WHEN len(s) = 0 THEN len(t) ELSE least(len(t), len(s)) END AS n FROM rec), "
    "kx AS (SELECT doc_id, page_number, i, t[i] AS x, CASE WHEN len(s) > 0 THEN coalesce(s[i], 0) END AS score FROM nk, unnest(range(1, n + 1)) AS u(i)), "
    f"kp AS (SELECT doc_id, page_number, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY i) AS place, x AS text, score FROM kx WHERE NOT {_BLANK_X})"
)


@query(f"WITH @latest, {_KEPT} SELECT doc_id, page_number, place, text, CASE WHEN isnan(score) THEN NULL ELSE score END AS score FROM kp")
def kept_pairs(spark, d):
    """Lines that aren't blank with their scores."""
    raw = _recorded(spark, d)
    pairs = pg.kept_pairs(F.col("rec_texts"), F.col("rec_scores").cast("array<string>"))
    p = pg.latest(raw.select(*pg.KEYS, pairs.alias("pairs"), "ingested_at"))
    return p.select(*pg.KEYS, F.posexplode("pairs").alias("p", "x")).select(*pg.KEYS, (F.col("p") + 1).cast("bigint").alias("place"), "x.text", F.nanvl("x.score", F.lit(None).cast("double")).alias("score"))


@query(
    f"WITH @latest, {_KEPT}, agg AS (SELECT doc_id, page_number, string_agg(text, chr(10) ORDER BY place) AS text, count(*) AS n_lines, list(score) FILTER (score IS NOT NULL AND NOT isnan(score)) AS sc FROM kp GROUP BY ALL) "
    "SELECT r.doc_id, r.page_number, CASE WHEN len(t) = 0 AND det = 0 THEN 'error' ELSE 'paddle' END AS engine_used, CASE WHEN len(t) = 0 AND det = 0 THEN 'paddle_empty_result' END AS fallback_reason, coalesce(a.text, '') AS text, coalesce(a.n_lines, 0) AS n_lines, CAST(det AS INT) AS det_count, CAST(len(t) AS INT) AS rec_count, "
    "round(CASE WHEN det > 0 THEN (det - len(t)) / det ELSE 0 END, 9) AS tasa_descarte, coalesce(angle_detected, 0) AS angle_detected, round(list_avg(sc), 9) AS conf_promedio, round(list_median(sc), 9) AS conf_mediana, round(list_stddev_pop(sc), 9) AS conf_std, CAST(coalesce(len(list_filter(sc, lambda x: x < 0.85)), 0) AS INT) AS lineas_baja_confianza FROM rec r LEFT JOIN agg a USING (doc_id, page_number)"
)
def from_recognition(spark, d):
    """Page rows made anew from recorded results: text, counts, discard rate, confidence, error rows."""
    raw = pg.latest(_recorded(spark, d).select(*pg.KEYS, "image_path", "rec_texts", "rec_scores", "dt_polys", "angle", "ingested_at"))
    r = pg.from_recognition(raw)
    return r.select(*pg.KEYS, "engine_used", "fallback_reason", "text", F.size("lines").cast("bigint").alias("n_lines"), "det_count", "rec_count", F.round("tasa_descarte", 9).alias("tasa_descarte"), "angle_detected", *[F.round(c, 9).alias(c) for c in ("conf_promedio", "conf_mediana", "conf_std")], "lineas_baja_confianza")


_POLY = "'(' || i || ',' || page_number || ') → (' || (i + 10) || ',' || (page_number + 5) || ')'"


@query(
    f"WITH @latest, {_RECORDED}, l AS (SELECT doc_id, page_number, t, s, unnest(range(1, greatest(len(t), len(s)) + 1)) AS i FROM rec) "
    f"SELECT doc_id, page_number, i AS line_no, t[i] AS text, CASE WHEN isnan(s[i]) THEN NULL ELSE s[i] END AS score, CASE WHEN i < len(t) THEN CASE WHEN i % 7 = 3 THEN '180' ELSE '0' END ELSE 'N/A' END AS angle, CASE WHEN i <= len(t) THEN {_POLY} END AS polygon, CASE WHEN i <= len(t) THEN i || ',' || page_number || ',' || (i + 10) || ',' || (page_number + 5) END AS box, CASE WHEN s[i] >= 0.85 THEN 'ok' ELSE 'warn' END AS status FROM l"
)
def line_table(spark, d):
    """Lines with score, angle, polygon, box and status, by position."""
    raw = pg.latest(_recorded(spark, d).select(*pg.KEYS, "rec_texts", "rec_scores", "angles", "polys", "boxes", "ingested_at"))
    return pg.line_table(raw).withColumn("line_no", F.col("line_no").cast("bigint")).withColumn("score", F.nanvl("score", F.lit(None).cast("double")))


@query(f"WITH @latest, {_RECORDED}, a AS (SELECT unnest(list_transform(range(1, len(t)), lambda i: CASE WHEN i % 7 = 3 THEN 180 ELSE 0 END)) AS angle FROM rec) SELECT angle, count(*) AS n FROM a GROUP BY 1")
def line_angles(spark, d):
    """How many lines have each orientation."""
    return pg.angle_counts(pg.latest(_recorded(spark, d).select(*pg.KEYS, "angles", "ingested_at")))


@query("WITH @latest SELECT doc_id, page_number, round(CASE WHEN rec_count > 0 THEN lineas_baja_confianza * 100 / rec_count ELSE 0 END, 6) AS low_percent, round(CASE WHEN tiempo_total > 0 THEN length(text) / tiempo_total END, 6) AS throughput FROM latest")
def rates(spark, d):
    """Share of lines of low confidence, and characters a second of each page's reading."""
    return _pages(spark, d, F.round(pg.low_share(), 6).alias("low_percent"), F.round(pg.throughput(F.length("text"), F.col("tiempo_total")), 6).alias("throughput")).select(*pg.KEYS, "low_percent", "throughput")


@query("WITH @latest SELECT doc_id, page_number, '(' || lineas_baja_confianza || ' ' || CASE WHEN lineas_baja_confianza = 1 THEN 'línea' ELSE 'líneas' END || ' bajo 0.85)' AS note FROM latest WHERE engine_used = 'paddle' AND lineas_baja_confianza > 0")
def low_notes(spark, d):
    return _pages(spark, d, F.when((F.col("engine_used") == "paddle") & (F.col("lineas_baja_confianza") > 0), pg.low_note()).alias("note")).where("note IS NOT NULL").select(*pg.KEYS, "note")


@query("SELECT DISTINCT doc_id, page_number, strftime(ingested_at, '%Y%m%d_%H%M%S') AS stamp, strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS shown FROM pages")
def stamps(spark, d):
    """Times of delivery as they stand in names of files and in reports."""
    return tables(spark, d, "pages")[0].select(*pg.KEYS, F.date_format("ingested_at", "yyyyMMdd_HHmmss").alias("stamp"), F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("shown")).distinct()


@query(f"WITH @latest, e AS (SELECT doc_id, page_number, lines, unnest(range(1, len(lines) + 1)) AS line_no FROM latest) SELECT doc_id, page_number, line_no, {_STRIP.format("replace(replace(lines[line_no], '|', chr(92) || '|'), chr(10), ' ')")} AS cell FROM e WHERE lines[line_no] IS NOT NULL")
def md_cells(spark, d):
    """Lines as cells of a Markdown table."""
    p = _pages(spark, d, F.transform("lines", tx.md_escape).alias("cells"))
    return p.select(*pg.KEYS, F.posexplode("cells").alias("p", "cell")).where("cell IS NOT NULL").select(*pg.KEYS, (F.col("p") + 1).cast("bigint").alias("line_no"), "cell")


# ------------------------------------------------ sections and their texts

_SECTION_TEXTS = "WITH @latest, @delimiter, @marked, st AS (SELECT k.doc_id, k.sec AS section_index, k.start, page_number, l.engine_used, l.text FROM kept k JOIN latest l USING (doc_id, page_number))"


def _section_texts(spark: SparkSession, d: str, *columns: str | Column) -> DataFrame:
    """Pages of sections with their separator page; of the text only what is asked for is shuffled."""
    marked = _marked(spark, d)
    return sg.section_pages(marked).join(_pages(spark, d, *columns), pg.KEYS).join(sg.sections(marked).select("doc_id", "section_index", "separator_page"), ["doc_id", "section_index"])


@query(_SECTION_TEXTS + f" SELECT doc_id, section_index, page_number FROM st WHERE page_number <> start AND engine_used <> 'error' AND length({_STRIP.format("coalesce(text, '')")}) > 0")
def content_pages(spark, d):
    """Pages of sections with content of their own."""
    rows = _section_texts(spark, d, "engine_used", F.when(tx.blank(F.coalesce("text", F.lit(""))), "").otherwise("x").alias("text"))
    return pg.content_pages(rows).select("doc_id", "section_index", "page_number")


@query(_SECTION_TEXTS + f", c AS (SELECT *, row_number() OVER (PARTITION BY doc_id, section_index ORDER BY page_number) AS rn FROM st WHERE page_number <> start AND engine_used <> 'error' AND length({_STRIP.format("coalesce(text, '')")}) > 0) SELECT doc_id, section_index, page_number, replace(text[1:300], chr(10), '  ' || chr(10)) AS preview FROM c WHERE rn <= 2")
def content_previews(spark, d):
    """The first two content pages of each section, shortened."""
    short = tx.preview(F.col("text"), 300, "  \n")
    rows = _section_texts(spark, d, "engine_used", F.when(tx.blank(F.coalesce("text", F.lit(""))), "").otherwise("x").alias("text"), short.alias("preview"))
    return pg.first_pages(pg.content_pages(rows), ["doc_id", "section_index"], 2).select("doc_id", "section_index", "page_number", "preview")


@query(_SECTION_TEXTS + ", c AS (SELECT *, row_number() OVER (PARTITION BY doc_id, section_index ORDER BY page_number) AS rn FROM st) SELECT doc_id, section_index, page_number, CASE WHEN engine_used = 'error' THEN '⚠️ error' WHEN coalesce(text, '') = '' THEN '_(sin texto)_' ELSE replace(text[1:400], chr(10), '  ' || chr(10)) END AS preview FROM c WHERE rn <= 3")
def section_previews(spark, d):
    """The first three pages of each section, shortened; error pages and pages without text say so."""
    short = F.when(F.col("engine_used") == "error", "⚠️ error").when(F.coalesce("text", F.lit("")) == "", "_(sin texto)_").otherwise(tx.preview(F.col("text"), 400, "  \n"))
    rows = _section_texts(spark, d, short.alias("preview"))
    return pg.first_pages(rows, ["doc_id", "section_index"], 3).select("doc_id", "section_index", "page_number", "preview")


@query("WITH @latest, s AS (SELECT doc_id, count(*) AS total_pages, count(*) FILTER (engine_used = 'paddle') AS pages_paddle, count(*) FILTER (engine_used = 'qwen') AS pages_qwen, count(*) FILTER (engine_used = 'error') AS pages_error, round(coalesce(avg(conf_promedio), 0), 6) AS conf_promedio_documento, round(sum(tiempo_total), 4) AS tiempo_total, md5(coalesce(string_agg(text, chr(10) || chr(10) ORDER BY page_number) FILTER (engine_used <> 'error' AND text IS NOT NULL), '')) AS digest FROM latest GROUP BY doc_id) SELECT * FROM s")
def result_documents(spark, d):
    """The block of the result file for each file; its whole text as a digest."""
    p = cut(_pages(spark, d, "engine_used", "conf_promedio", "tiempo_total", "text"))
    r = reports.result_document(pg.documents(p), pg.texts_in_parts(p, True))
    return r.select("doc_id", "total_pages", "pages_paddle", "pages_qwen", "pages_error", F.round("conf_promedio_documento", 6).alias("conf_promedio_documento"), F.round("tiempo_total", 4).alias("tiempo_total"), F.md5("full_text").alias("digest"))


@query(
    _CONSOLIDATED
    + f", x AS (SELECT doc_id, key, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY separator_page) AS INT) AS section_index, cargo, CASE WHEN n_blocks > 1 THEN nullif(regexp_extract(lower(cargo), 'n[°º]?\\s*(\\d+)', 1), '') ELSE nullif(num1, '') END AS numero, total_pages FROM c), "
    + f"tt AS (SELECT b.doc_id, b.key, string_agg(l.text, chr(10) || chr(10) ORDER BY page_number) AS whole FROM k b JOIN kept p ON b.doc_id = p.doc_id AND b.sec = p.sec JOIN latest l ON p.doc_id = l.doc_id AND p.page_number = l.page_number WHERE l.engine_used <> 'error' AND length({_STRIP.format("coalesce(l.text, '')")}) > 0 GROUP BY 1, 2) "
    "SELECT x.doc_id, section_index, cargo, numero, total_pages, md5(coalesce(whole, '')) AS digest FROM x LEFT JOIN tt USING (doc_id, key)".replace("ORDER BY page_number)", "ORDER BY l.page_number)")
)
def result_sections(spark, d):
    """The sections of the result file; their whole texts as digests."""
    blocks = cut(_blocks(spark, d))
    marked = _marked(spark, d)
    consolidated = cut(sg.consolidate(blocks))
    own = process.consolidated_pages(blocks, sg.section_pages(marked), consolidated)
    r = reports.result_sections(consolidated, own, _pages(spark, d, "engine_used", "text"))
    return r.select("doc_id", "section_index", "cargo", "numero", "total_pages", F.md5("full_text").alias("digest"))


# -------------------------------------- delimiters that stand in the tables

#: Phrases of a page that stand at its edges in the test tables; the catalogue's own don't occur there.
_LOCAL = replace(DEFAULT, delimiters=("certificado de trabajo", "humo negro", "gestion de calidad"))


def _local(sql: str) -> str:
    return _shared(sql).replace(_DELIM, ", ".join(f"'{w}'" for w in _LOCAL.delimiters))


@query("WITH @latest, @delimiter SELECT doc_id, page_number FROM del3 WHERE is_delimiter", _local)
def delimiters_local(spark, d):
    """Delimiter pages by another list of phrases."""
    return _pages(spark, d, _delimiter(_LOCAL)).where("is_delimiter").select(*pg.KEYS)


@query("WITH @latest, @delimiter, @marked SELECT doc_id, page_number FROM cut", _local)
def cut_points_local(spark, d):
    return sg.cut_points(tables(spark, d, "separators")[0].where("NOT es_separadora"), _pages(spark, d, _delimiter(_LOCAL)).where("is_delimiter"))


@query("WITH @latest, @delimiter, @marked SELECT k.doc_id, k.sec AS section_index, min(k.start) AS separator_page, min(k.page_number) AS first, max(k.page_number) AS last, count(*) AS total_pages FROM kept k GROUP BY ALL", _local)
def segment_local(spark, d):
    """Sections that also end at delimiter pages."""
    return sg.sections(_marked(spark, d, _LOCAL))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
