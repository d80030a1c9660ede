"""Page quality: recorded recognition results to page rows, metrics, routing, overriding, labels, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.config import DEFAULT, Config
from folioscope.functions import text as tx

KEYS = ["doc_id", "page_number"]


def latest(pages: DataFrame, keys: Sequence[str] = KEYS, by: str = "ingested_at") -> DataFrame:
    """One row for each key, the last delivered; extra columns go along. Rows without the ordering column are taken as they are."""
    rest = [c for c in pages.columns if c not in keys]
    order = F.struct(F.col(by).isNotNull(), by) if by in pages.columns else F.struct(*[F.col(c).cast("string") for c in rest[:1]])
    picked = pages.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in rest])


def valid_scores(scores: Column) -> Column:
    """Scores without nulls and NaN; null for none at all is an empty array."""
    return F.coalesce(F.filter(scores, lambda x: x.isNotNull() & ~F.isnan(x)), F.array().cast("array<double>"))


def kept_pairs(texts: Column, scores: Column) -> Column:
    """Structs (text, score) of lines that aren't blank.

    Lines and scores go in parallel up to the shorter; a score that is no
    number counts as 0; without any scores the lines are kept with none.
    """
    texts, scores = F.coalesce(texts, F.array().cast("array<string>")), F.coalesce(scores, F.array().cast("array<string>"))
    n = F.when(F.size(scores) == 0, F.size(texts)).otherwise(F.least(F.size(texts), F.size(scores)))
    pairs = F.transform(F.slice(texts, 1, n), lambda t, i: F.struct(t.alias("text"), F.when(F.size(scores) > 0, F.coalesce(F.get(scores, i).try_cast("double"), F.lit(0.0))).alias("score")))
    return F.filter(pairs, lambda p: p["text"].isNotNull() & ~tx.blank(p["text"]))


def discard_rate(det: Column, rec: Column) -> Column:
    """Share of detections that were not recognised; negative if more were; 0 without detections."""
    return F.when(det > 0, (det - rec) / det).otherwise(F.lit(0.0))


def score_metrics(df: DataFrame, scores: str, keys: Sequence[str], config: Config = DEFAULT) -> DataFrame:
    """Mean, median, least, greatest, population deviation and number of low scores of each row's array.

    An array function per row, without exploding or shuffling; all metrics but
    the count are null where there is no score.
    """
    s = F.array_sort(valid_scores(F.col(scores)))
    n = F.size("__s")
    total = F.aggregate("__s", F.lit(0.0), lambda a, x: a + x)
    df = df.withColumn("__s", s).withColumn("__mean", F.when(n > 0, total / n))
    middle = F.when(n > 0, (F.get("__s", F.floor((n - 1) / 2).cast("int")) + F.get("__s", F.floor(n / 2).cast("int"))) / 2)
    deviation = F.when(n > 0, F.sqrt(F.aggregate("__s", F.lit(0.0), lambda a, x: a + (x - F.col("__mean")) * (x - F.col("__mean"))) / n))
    return df.select(
        *keys,
        F.col("__mean").alias("conf_promedio"), middle.alias("conf_mediana"), F.when(n > 0, F.get("__s", F.lit(0))).alias("conf_min"), F.when(n > 0, F.element_at("__s", -1)).alias("conf_max"),
        deviation.alias("conf_std"), F.size(F.filter("__s", lambda x: x < config.least_confidence)).alias("lineas_baja_confianza"),
    )


def from_recognition(raw: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Page rows of raw recognition results (doc_id, page_number, image_path, rec_texts, rec_scores, dt_polys, angle).

    Missing arrays are empty and a missing angle is 0; a result without any
    line, text and detection is an error row that keeps its page. Where the
    results have columns ``failure`` and ``seconds``, a failure is the reason
    of its error row and the seconds are the page's times.
    """
    times = [F.col("seconds").alias("tiempo_paddle"), F.lit(None).cast("double").alias("tiempo_qwen"), F.coalesce("seconds", F.lit(0.0)).alias("tiempo_total")] if "seconds" in raw.columns else []
    failure = F.col("failure") if "failure" in raw.columns else F.lit(None).cast("string")
    texts = F.coalesce("rec_texts", F.array().cast("array<string>"))
    pairs = raw.withColumn("__p", kept_pairs(texts, F.col("rec_scores").cast("array<string>"))).withColumn("det_count", F.coalesce(F.size("dt_polys"), F.lit(0))).withColumn("rec_count", F.size(texts))
    pairs = pairs.withColumn("det_count", F.greatest("det_count", F.lit(0))).withColumn("lines", F.transform("__p", lambda p: p["text"])).withColumn("line_scores", F.filter(F.transform("__p", lambda p: p["score"]), lambda x: x.isNotNull()))
    empty = (F.col("rec_count") == 0) & (F.col("det_count") == 0)
    base = pairs.select(
        *KEYS, "image_path", F.when(empty, "error").otherwise("paddle").alias("engine_used"), F.when(empty, F.coalesce(failure, F.lit("paddle_empty_result"))).alias("fallback_reason"),
        F.array_join("lines", "\n").alias("text"), "lines", "line_scores", "det_count", "rec_count",
        discard_rate(F.col("det_count"), F.col("rec_count")).alias("tasa_descarte"), F.coalesce("angle", F.lit(0)).alias("angle_detected"), F.lit(False).alias("tiene_tabla"), *times,
    )
    return score_metrics(base, "line_scores", base.columns, config)


def line_count(lines: Column) -> Column:
    return F.size(F.coalesce(tx.kept_lines(lines), F.array().cast("array<string>")))


def needs_second_pass(config: Config = DEFAULT) -> Column:
    """Error pages, pages without confidence and pages with few lines stay; others go on low confidence and many discards."""
    low = (F.col("conf_promedio") < config.least_confidence) & (F.col("tasa_descarte") > config.most_discard)
    return F.coalesce((F.col("engine_used") != "error") & F.col("conf_promedio").isNotNull() & (line_count(F.col("lines")) > config.separator_lines) & low, F.lit(False))


def second_pass_reason(config: Config = DEFAULT) -> Column:
    """Why a page is read again; empty for pages that are not."""
    return F.when(needs_second_pass(config), reason_text(F.col("conf_promedio"), F.col("tasa_descarte"))).otherwise("")


def reason_text(confidence: Column, discard: Column) -> Column:
    return F.concat(F.lit("confianza baja ("), tx.fixed(confidence, 3), F.lit(") y descarte alto ("), tx.fixed(discard * 100, 1), F.lit("%)"))


def header_tags() -> Column:
    """Engine with its sign, confidence where there is one, angle where the page was turned."""
    sign = F.when(F.col("engine_used") == "paddle", "🔵 ").when(F.col("engine_used") == "qwen", "🟠 ").when(F.col("engine_used") == "error", "🔴 ").otherwise("")
    conf = F.when(F.col("conf_promedio").isNotNull(), F.concat(F.lit(" · conf "), tx.fixed(F.col("conf_promedio"), 3))).otherwise("")
    return F.concat(sign, "engine_used", conf, F.when(F.col("angle_detected") != 0, F.concat(F.lit(" · "), F.col("angle_detected").cast("string"), F.lit("°"))).otherwise(""))


def legacy_advice(config: Config = DEFAULT) -> Column:
    return F.when((F.col("conf_promedio") < config.least_confidence) | (F.col("tasa_descarte") > config.legacy_discard), "reroute").when(F.col("lineas_baja_confianza") > 0, "evaluate").otherwise("use")


def override(first: DataFrame, second: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """First-pass rows replaced by second-pass rows of their page, also by error rows; columns and row number of the first pass."""
    rest = [c for c in first.columns if c not in keys]
    new = second.select(*keys, F.struct(*rest).alias("__new"))
    return first.select(*keys, F.struct(*rest).alias("__old")).join(new, list(keys), "left").select(*keys, F.coalesce("__new", "__old").alias("r")).select(*keys, *[F.col(f"r.`{c}`").alias(c) for c in rest])


def page_status(config: Config = DEFAULT) -> Column:
    """What a report says of a page."""
    paddle = F.when(F.col("conf_promedio") < config.least_confidence, "conf baja").when(F.col("tasa_descarte") > config.most_discard, "descarte alto").when(F.col("lineas_baja_confianza") > 0, F.concat(F.col("lineas_baja_confianza").cast("string"), F.lit(" líneas bajas"))).otherwise("ok")
    return F.when(F.col("engine_used") == "error", tx.or_default(F.col("fallback_reason"), "error")).when(F.col("engine_used") == "paddle", paddle).otherwise("qwen")


def document_status(errors: Column, confidence: Column, config: Config = DEFAULT) -> Column:
    return F.when(errors > 0, "red").when(confidence < config.least_confidence, "yellow").otherwise("green")


def documents(pages: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One row per file: pages by engine, unweighted mean of page confidences (0 without any), time, status."""
    n = lambda e: F.count_if(F.col("engine_used") == e)
    out = pages.groupBy("doc_id").agg(
        F.count("*").alias("total_pages"), n("paddle").alias("pages_paddle"), n("qwen").alias("pages_qwen"), n("error").alias("pages_error"),
        F.coalesce(F.avg("conf_promedio"), F.lit(0.0)).alias("conf_promedio_documento"), F.sum("tiempo_total").alias("tiempo_total"),
    )
    return out.withColumn("status", document_status(F.col("pages_error"), F.col("conf_promedio_documento"), config))


def texts_in_parts(pages: DataFrame, keep_blank: bool, keys: Sequence[str] = ("doc_id",), part_pages: int = 256) -> DataFrame:
    """Text in page order by parts of a bounded number of pages, joined by an empty line; error pages are left out.

    The whole text of a file is its parts in order; no task ever holds more
    than one part.
    """
    ok = F.coalesce(F.col("engine_used") != "error", F.lit(True)) & F.col("text").isNotNull()
    rows = pages.where(ok if keep_blank else ok & ~tx.blank(F.col("text")))
    return rows.groupBy(*keys, F.floor(F.col("page_number") / part_pages).cast("int").alias("part")).agg(F.count("*").alias("n_pages"), F.expr("listagg(text, '\n\n') WITHIN GROUP (ORDER BY page_number)").alias("text"))


def text_by_page(pages: DataFrame, part_pages: int = 256) -> DataFrame:
    """Maps page to text, by parts of a file; of a repeated page one text is kept."""
    one = pages.groupBy("doc_id", "page_number").agg(F.max("text").alias("text"))
    return one.groupBy("doc_id", F.floor(F.col("page_number") / part_pages).cast("int").alias("part")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("page_number", F.coalesce("text", F.lit("")).alias("text"))))).alias("texts"))


def low_entries(config: Config = DEFAULT) -> Column:
    """Array of (line_no, line, score) of a first-pass page's lines of low confidence; empty for other pages."""
    zipped = F.arrays_zip(F.col("lines").alias("line"), F.col("line_scores").alias("score"))
    numbered = F.transform(zipped, lambda z, i: F.struct((i + 1).alias("line_no"), z["line"].alias("line"), z["score"].alias("score")))
    low = F.filter(numbered, lambda x: x["score"] < config.least_confidence)
    return F.when((F.col("engine_used") == "paddle") & (F.col("lineas_baja_confianza") > 0), low)


def low_lines(pages: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Lines of low confidence of first-pass pages, with their 1-based number."""
    return pages.select(*KEYS, F.inline(low_entries(config)))


def low_note(config: Config = DEFAULT) -> Column:
    """What a report says of a page whose low lines have no scores of their own."""
    n = F.col("lineas_baja_confianza")
    return F.concat(F.lit("("), n.cast("string"), F.lit(" "), tx.plural(n, "línea", "líneas"), F.lit(f" bajo {config.least_confidence})"))


def content_pages(rows: DataFrame) -> DataFrame:
    """Pages of sections that hold content: not the separator page itself, no error, not blank. ``rows``: page_number, separator_page, engine_used, text."""
    return rows.where((F.col("page_number") != F.col("separator_page")) & (F.col("engine_used") != "error") & ~tx.blank(F.coalesce("text", F.lit(""))))


def first_pages(rows: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` pages of each group. Spark limits the groups before it shuffles them, so a large group is no large task."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("page_number"))).where(F.col("__n") <= n).drop("__n")


def histogram(pages: DataFrame, keys: Sequence[str], config: Config = DEFAULT) -> DataFrame:
    """Scores in half-open bins; scores below the first and at or above the last bound are in no bin."""
    bounds = config.histogram
    bin_of = F.expr("CASE " + " ".join(f"WHEN s >= {a} AND s < {b} THEN {i}" for i, (a, b) in enumerate(zip(bounds, bounds[1:]))) + " END")
    s = pages.select(*keys, F.explode(valid_scores(F.col("line_scores"))).alias("s")).withColumn("bin", bin_of)
    total = s.groupBy(*keys).agg(F.count("*").alias("total"))
    low = F.element_at(F.array(*[F.lit(b) for b in bounds]), F.col("bin") + 1)
    return s.where("bin is not null").groupBy(*keys, "bin").agg(F.count("*").alias("n")).join(total, list(keys)).select(*keys, low.alias("low"), "n", F.round(F.col("n") * 100 / F.col("total"), 4).alias("percent"))


def line_table(raw: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Each recognised line with its score, angle, polygon, box and status, by position.

    ``raw``: doc_id, page_number, rec_texts, rec_scores, angles, polys and, if
    there are any, boxes of two corners; shorter arrays are filled with nulls,
    a missing angle reads N/A.
    """
    zipped = F.arrays_zip(F.col("rec_texts").alias("text"), F.col("rec_scores").alias("score"), F.col("angles").alias("angle"), F.col("polys").alias("poly"), (F.col("boxes") if "boxes" in raw.columns else F.array().cast("array<array<array<int>>>")).alias("box"))
    rows = raw.select(*KEYS, F.posexplode(zipped).alias("pos", "z"))
    score = F.col("z.score").try_cast("double")
    return rows.select(
        *KEYS, (F.col("pos") + 1).alias("line_no"), F.col("z.text").alias("text"), score.alias("score"), F.coalesce(F.col("z.angle").cast("string"), F.lit("N/A")).alias("angle"),
        tx.polygon(F.col("z.poly")).alias("polygon"), tx.box(F.col("z.box")).alias("box"), F.when(score >= config.least_confidence, "ok").otherwise("warn").alias("status"),
    )


def angle_counts(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """How many lines have each orientation."""
    return raw.select(*keys, F.explode("angles").alias("angle")).groupBy(*keys, "angle").agg(F.count("*").alias("n"))


def low_share(config: Config = DEFAULT) -> Column:
    """Percentage of recognised lines of low confidence; 0 where nothing was recognised."""
    return F.when(F.col("rec_count") > 0, F.col("lineas_baja_confianza") * 100 / F.col("rec_count")).otherwise(F.lit(0.0))


def throughput(tokens: Column, seconds: Column) -> Column:
    """Tokens a second of a model call; null without time."""
    return F.when(seconds > 0, tokens / seconds)
