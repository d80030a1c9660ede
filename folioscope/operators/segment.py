"""Sections between separators, trimmed at cut points, and their consolidation by role.

A window over a whole file would put a file with a third of all pages into one
task. Running values are therefore computed in two steps: a window within
blocks of pages, and one over the blocks' totals, which are few and narrow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.config import DEFAULT, Config
from folioscope.functions import text as tx


def marked(pages: DataFrame, separators: DataFrame, cuts: DataFrame) -> DataFrame:
    """(doc_id, page_number, is_sep, is_cut) of every page row: whether it is a separator page, and a cut point.

    Pages with a column ``is_delimiter`` are cut points where it is true.
    """
    s = separators.select("doc_id", "page_number").distinct().withColumn("is_sep", F.lit(True))
    c = cuts.select("doc_id", "page_number").distinct().withColumn("is_cut", F.lit(True))
    delimiter = F.coalesce(F.col("is_delimiter"), F.lit(False)) if "is_delimiter" in pages.columns else F.lit(False)
    rows = pages.select("doc_id", "page_number", delimiter.alias("d")).join(s, ["doc_id", "page_number"], "left").join(c, ["doc_id", "page_number"], "left")
    return rows.select("doc_id", "page_number", F.coalesce("is_sep", F.lit(False)).alias("is_sep"), (F.col("d") | F.col("is_cut").isNotNull()).alias("is_cut"))


def running(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Adds to each page the number of separators up to it (sec), the page of the last one (start) and of the last cut point (last_cut).

    Rows of the same page count together.
    """
    block = F.floor(F.col("page_number") / config.block).cast("int")
    sep, cut = F.when(F.col("is_sep"), F.col("page_number")), F.when(F.col("is_cut"), F.col("page_number"))
    rows = rows.withColumn("block", block)
    totals = rows.groupBy("doc_id", "block").agg(F.count_if("is_sep").alias("n"), F.max(sep).alias("s"), F.max(cut).alias("c"))
    before = Window.partitionBy("doc_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("doc_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.max("s").over(before).alias("s0"), F.max("c").over(before).alias("c0"))
    here = Window.partitionBy("doc_id", "block").orderBy("page_number").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("n", F.sum(F.col("is_sep").cast("int")).over(here)).withColumn("s", F.max(sep).over(here)).withColumn("c", F.max(cut).over(here))
    joined = rows.join(offsets, ["doc_id", "block"])
    return joined.select("doc_id", "page_number", "is_sep", "is_cut", (F.col("n") + F.col("n0")).cast("int").alias("sec"), F.coalesce("s", "s0").alias("start"), F.greatest("c", "c0").alias("last_cut"))


def section_pages(rows: DataFrame, trim: bool = True, config: Config = DEFAULT) -> DataFrame:
    """(doc_id, section_index, page_number): pages from a separator to the next one, up to the first cut point after the separator."""
    r = running(rows, config).where("sec > 0")
    kept = r.where("last_cut IS NULL OR last_cut <= start") if trim else r
    return kept.select("doc_id", F.col("sec").alias("section_index"), "page_number")


def sections(rows: DataFrame, trim: bool = True, config: Config = DEFAULT) -> DataFrame:
    """(doc_id, section_index, separator_page, first, last, total_pages) of every separator; one without pages has total 0."""
    r = running(rows, config).where("sec > 0")
    kept = F.col("last_cut").isNull() | (F.col("last_cut") <= F.col("start")) if trim else F.lit(True)
    page = F.when(kept, F.col("page_number"))
    one = r.groupBy("doc_id", "sec").agg(F.max("start").alias("separator_page"), F.count_if("is_sep").alias("k"), F.min(page).alias("first"), F.max(page).alias("last"), F.count(page).alias("total_pages"))
    # separators that stand twice on a page: the earlier section is there, but empty
    index = one.withColumn("section_index", F.explode(F.sequence(F.col("sec") - F.col("k").cast("int") + 1, F.col("sec"))))
    own = F.col("section_index") == F.col("sec")
    return index.select("doc_id", "section_index", "separator_page", F.when(own, F.col("first")).alias("first"), F.when(own, F.col("last")).alias("last"), F.when(own, F.col("total_pages")).otherwise(F.lit(0).cast("bigint")).alias("total_pages"))


def orphans(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Pages in no section: before the first separator, or from a cut point up to the next separator."""
    return running(rows, config).where("sec = 0 OR last_cut > start").select("doc_id", "page_number")


def cut_points(discarded: DataFrame, delimiters: DataFrame) -> DataFrame:
    """Pages that end a section without beginning one: discarded candidates and delimiter pages, each once."""
    return discarded.select("doc_id", "page_number").unionByName(delimiters.select("doc_id", "page_number")).distinct()


def ranked(df: DataFrame, name: str, order: str, tie: str, config: Config = DEFAULT) -> DataFrame:
    """Adds the 1-based rank within the file, in two steps like ``running``."""
    df = df.withColumn("__b", F.floor(F.col(order) / config.block).cast("int"))
    before = Window.partitionBy("doc_id").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = df.groupBy("doc_id", "__b").agg(F.count("*").alias("__n")).select("doc_id", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"))
    return df.withColumn("__r", F.row_number().over(Window.partitionBy("doc_id", "__b").orderBy(order, tie))).join(offsets, ["doc_id", "__b"]).withColumn(name, (F.col("__r") + F.col("__n0")).cast("int")).drop("__b", "__r", "__n0")


def consolidate(blocks: DataFrame) -> DataFrame:
    """Sections of the same role of a file as one, in the order of their first separator.

    ``blocks``: doc_id, cargo, cargo_raw, numero, separator_page, first, last,
    total_pages, has_tables. Role and raw role are those of the first block;
    the number of the post is read from the role where there are several
    blocks. Ranges of blocks are collected per file and role, so their number
    is that of the role's separators in one file.
    """
    keyed = blocks.withColumn("key", tx.group_key(F.coalesce("cargo", F.lit(""))))
    first = lambda c: F.min_by(c, F.struct("separator_page", F.coalesce("first", "separator_page")))
    out = keyed.groupBy("doc_id", "key").agg(
        first("cargo").alias("cargo"), first("cargo_raw").alias("cargo_raw"), first("numero").alias("numero_first"), F.min("separator_page").alias("separator_page"),
        F.sum("total_pages").alias("total_pages"), F.bool_or("has_tables").alias("has_tables"), F.count("*").alias("n_blocks"),
        F.array_sort(F.collect_list(F.struct(F.coalesce("first", "separator_page").alias("start"), F.coalesce("last", "separator_page").alias("end"), "separator_page"))).alias("bloques_origen"),
    )
    return ranked(out, "section_index", "separator_page", "key").select(
        "doc_id", "section_index", "key", "cargo", "cargo_raw", F.when(F.col("n_blocks") > 1, tx.post_number(F.col("cargo"))).otherwise(F.col("numero_first")).alias("numero"),
        "separator_page", "total_pages", "has_tables", "n_blocks", "bloques_origen",
    )


def ranges_label(blocks: str = "bloques_origen"):
    """``1–2; 7–8`` of an array of ranges."""
    return F.array_join(F.transform(blocks, lambda b: F.concat(b["start"].cast("string"), F.lit("–"), b["end"].cast("string"))), "; ")


def document_type(consolidated: DataFrame) -> DataFrame:
    """B for files in which any role has several blocks, else A."""
    return consolidated.groupBy("doc_id").agg(F.max("n_blocks").alias("most_blocks"), F.count("*").alias("n_roles")).withColumn("doc_type", F.when(F.col("most_blocks") > 1, "B").otherwise("A"))
