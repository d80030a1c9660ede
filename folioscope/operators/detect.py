"""Separator pages: candidates, block delimiters, the classifier's reply, and the cascade of both arbiters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.config import DEFAULT, Config
from folioscope.functions import fuzzy
from folioscope.functions import text as tx


def is_candidate(lines: Column, config: Config = DEFAULT) -> Column:
    """Whether a page may separate sections: few lines, a role word, none of the excluded phrases."""
    none = F.array().cast("array<string>")
    clean = F.filter(F.transform(F.coalesce(lines, none), tx.strip), lambda x: x.isNotNull() & (F.length(x) > 2) & ~tx.is_digits(x))

    def judged(clean: Column) -> Column:
        few = (F.size(clean) >= 1) & (F.size(clean) <= config.separator_lines)
        signs = lambda t: F.size(F.array_distinct(F.filter(F.split(F.replace(t, F.lit(" "), F.lit("")), ""), lambda c: c != "")))
        said = lambda f: tx.contains_any(f, config.role_words) & ~tx.contains_any(f, config.no_separator)
        return few & tx.bind(F.array_join(clean, " "), lambda t: (F.length(t) >= 10) & (signs(t) > 2) & tx.bind(tx.fold(t), said))

    # cleaning takes away only numbers and short lines; without a role word in the whole page there is none in the rest
    whole = tx.fold(F.array_join(F.coalesce(lines, none), " "))
    return F.when(tx.bind(whole, lambda t: tx.contains_any(t, [w.split(" ")[0] for w in config.role_words])), tx.bind(clean, judged)).otherwise(F.lit(False))


def is_delimiter(lines: Column, config: Config = DEFAULT) -> Column:
    """Whether a page begins a thematic block: a delimiting phrase and not too many lines that say something."""
    none = F.array().cast("array<string>")
    telling = lambda kept: F.filter(F.transform(kept, tx.strip), lambda x: (F.length(x) > 3) & ~tx.is_digits(x) & ~F.replace(x, F.lit(" "), F.lit("")).rlike(r"^[-.—*=]+$"))
    judged = lambda kept: (F.size(telling(kept)) <= config.delimiter_lines) & tx.bind(tx.fold(F.array_join(kept, " ")), lambda t: tx.contains_any(t, config.delimiters))
    # the phrase's first word first: lines are looked at one by one only where there is one
    first = tx.bind(tx.fold(F.array_join(F.coalesce(lines, none), " ")), lambda t: tx.contains_any(t, [p.split(" ")[0] for p in config.delimiters]))
    return F.when(first, tx.bind(F.coalesce(tx.kept_lines(lines), none), judged)).otherwise(F.lit(False))


def verdict(raw: Column) -> Column:
    """Struct (es_separadora, cargo, confianza) of a classifier's raw reply.

    Thoughts, backticks and a leading ``json`` are removed and the rest is
    parsed strictly. A value counts as true as in the reply's own language:
    non-empty strings, non-zero numbers, non-empty lists. Null, broken and
    non-object replies are (false, '', 'error').
    """
    body = tx.strip(F.regexp_replace(tx.after_thought(raw), r"^`+|`+$", ""))
    body = tx.strip(F.when(body.startswith("json"), F.substring(body, 5, 1 << 30)).otherwise(body))
    v = F.try_parse_json(body)
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    field = lambda name: F.try_variant_get(v, f"$.{name}", "variant")
    kind = lambda x: F.coalesce(F.schema_of_variant(x), F.lit("VOID"))
    said, cargo, sure = field("es_separadora"), field("cargo"), field("confianza")
    as_string = lambda x: F.try_variant_get(x, "$", "string")
    true = (
        F.when(kind(said) == "BOOLEAN", F.coalesce(F.try_variant_get(said, "$", "boolean"), F.lit(False)))
        .when(kind(said) == "STRING", F.length(as_string(said)) > 0)
        .when(kind(said).startswith("ARRAY"), as_string(said) != "[]")
        .when(kind(said).startswith("OBJECT"), as_string(said) != "{}")
        .when(kind(said) == "VOID", F.lit(False))
        .otherwise(F.coalesce(F.try_variant_get(said, "$", "double") != 0, F.lit(False)))
    )
    empty = (kind(cargo) == "VOID") | as_string(cargo).isin("", "false", "0", "0.0", "[]", "{}")
    none = F.try_variant_get(v, "$.confianza", "variant").isNull()
    # a missing confidence is low, a null one is the word for nothing
    text = F.when(none, "baja").when(kind(sure) == "VOID", "none").otherwise(F.lower(as_string(sure)))
    return F.when(
        is_object,
        F.struct(true.alias("es_separadora"), F.when(empty, "").otherwise(as_string(cargo)).alias("cargo"), text.alias("confianza")),
    ).otherwise(F.struct(F.lit(False).alias("es_separadora"), F.lit("").alias("cargo"), F.lit("error").alias("confianza")))


def accepted(v: Column) -> Column:
    """A classifier's yes of at least middle confidence with a role."""
    return v["es_separadora"] & v["confianza"].isin("alta", "media") & ~tx.blank(v["cargo"])


def evaluate(candidates: DataFrame, replies: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Candidates (doc_id, page_number, text) judged by the classifier's reply, else by similarity to a role, else discarded.

    A candidate without a reply counts as one with a broken reply. Of several
    replies of a page the greatest text is taken.
    """
    one = replies.groupBy("doc_id", "page_number").agg(F.max("raw_reply").alias("raw_reply")).select("doc_id", "page_number", verdict(F.col("raw_reply")).alias("__r"))
    none = F.struct(F.lit(False).alias("es_separadora"), F.lit("").alias("cargo"), F.lit("error").alias("confianza"))
    # the similarity is computed for those only that the classifier did not accept
    rows = candidates.join(one, ["doc_id", "page_number"], "left").withColumn("__v", F.coalesce("__r", none))
    rows = rows.withColumn("__yes", accepted(F.col("__v"))).withColumn("__c", F.when(~F.col("__yes"), tx.match_candidates(F.coalesce("text", F.lit("")))))
    rows = rows.select("doc_id", "page_number", "__yes", F.col("__v.cargo").alias("__cargo"), F.col("__v.confianza").alias("__sure"), "__c")
    rows = fuzzy.with_first_role(rows, "__c", "__f", config.roles, config.fuzzy_score)
    raw = F.when(F.col("__yes"), F.col("__cargo")).otherwise(F.coalesce("__f", F.lit("")))
    return rows.select(
        "doc_id", "page_number", (F.col("__yes") | F.col("__f").isNotNull()).alias("es_separadora"), raw.alias("cargo_detectado"), tx.normal_role(raw, config).alias("cargo_normalizado"),
        F.col("__sure").alias("confianza_qwen"), F.when(F.col("__yes"), "qwen").when(F.col("__f").isNotNull(), "fuzzy_fallback").otherwise("descartada").alias("metodo"),
    )
