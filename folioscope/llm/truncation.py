"""Problem 2: text values cut before their end, in pure SQL.

Word trigrams of all values are counted, in all and by how many tokens follow
them up to the end of their value. Line breaks and signs are tokens like
words, so the counts learn by themselves how pages end: page numbers, running
lines, table rows, signatures and roles. The final trigrams of each value are
joined with these counts:

* A last trigram that is far rarer than one with a longer last word in the same
  place ends within a word or number.
* Else the last trigram decides, if its counts say enough: the value is cut if
  an upper confidence bound of the trigram's share of ends is below ``RARELY``,
  and whole if a lower bound is above. If neither, the last two tokens decide,
  then the last word.
* Where all of these are too rare (names), the trigrams before are asked in
  turn whether they ever stand about so near to an end.

Evidence is relative throughout, so a value is judged alike in small and large
tables once the counts are clear. An ellipsis, a broken character and a hyphen
at a line's end are no tokens. Numbers are known by their shape, so a date or
an amount that lacks its last digits differs from whole ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.session import cut, spread

#: Shares of ends below which a last trigram, and one some tokens before the end, almost never stands there.
RARELY, NEARLY = {"text": 0.005, "fallback_reason": 0.05}, {"text": 0.01, "fallback_reason": 0.05}
#: Width of the confidence bounds in standard deviations, and ends of other values without which nothing counts as an end.
SURE, LEAST_ENDS = 2.0, 3
#: How many times more often the longer word must stand in the place of a last word: if that one ends values only, and otherwise.
LONGER, LONGER_MIXED = 5, 20
#: Trigrams before the last one that are asked, and tokens by which their distance from the end may differ.
BEFORE, APART = 5, 2
#: Characters from which the last tokens are taken; where they don't hold enough, the whole value.
TAIL = 400

_TOKEN = r"\pL+|0(?:[.,/:+]?0+)*|(?<!\.)\.(?!\.)|\n(?=.)|[^\s\pL0.…\x{FFFD}]"
# words broken across lines are joined, digits are all the same, a line break is one sign
_TOKENS = (
    "regexp_extract_all(regexp_replace(translate(lower(regexp_replace({0}, r'(?<=\\pL)[-\\x{{AD}}\\x{{2010}}\\x{{2011}}\\xAC][ \\t]*\\r?\\n\\s*(?=\\p{{Ll}})', '')), '123456789', '000000000'), r'\\s*\\n\\s*', '\\n'), r'"
    + _TOKEN.replace("{", "{{").replace("}", "}}")
    + "', 0)"
)
_PADDED = "concat(array('^', '^', '^'), {0})"
_KEPT = BEFORE + APART + 3

_VALUES = """
SELECT doc_id, page_number, field, value, source
FROM @pages LATERAL VIEW stack(2, 'text', text, 'fallback_reason', fallback_reason) AS field, value
WHERE value IS NOT NULL AND length(trim(value)) > 0"""

# A tail is enough if it holds more tokens than are kept, so that its first, perhaps partial one is not among them.
# Exploding an array of one value binds it, so that what it is made of is not computed for each use.
_TAILS = f"""
SELECT doc_id, page_number, field, source, slice(p, greatest(size(p) - {_KEPT} + 1, 1), {_KEPT}) AS t
FROM (SELECT *, {_PADDED.format("if(length(value) <= " + str(TAIL) + " OR size(short) > " + str(_KEPT) + " + 1, short, " + _TOKENS.format("value") + ")")} AS q
      FROM ({_VALUES}) LATERAL VIEW explode(array({_TOKENS.format(f"substr(rtrim(value), -{TAIL})")})) AS short) LATERAL VIEW explode(array(q)) AS p
WHERE size(p) > 3"""

_ENDS = 2.0, 3
#: How many times more often the longer word must stand in the place of a last word: if that one ends values only, and otherwise.
LONGER, LONGER_MIXED = 5, 20
#: Trigrams before the last one that are asked, and tokens by which their distance from the end may differ.
BEFORE, APART = 5, 2
#: Characters from which the last tokens are taken; where they don't hold enough, the whole value.
TAIL = 400

_TOKEN = r"\pL+|0(?:[.,/:+]?0+)*|(?<!\.)\.(?!\.)|\n(?=.)|[^\s\pL0.…\x{FFFD}]"
# words broken across lines are joined, digits are all the same, a line break is one sign
_TOKENS = (
    "regexp_extract_all(regexp_replace(translate(lower(regexp_replace({0}, r'(?<=\\pL)[-\\x{{AD}}\\x{{2010}}\\x{{2011}}\\xAC][ \\t]*\\r?\\n\\s*(?=\\p{{Ll}})', '')), '123456789', '000000000'), r'\\s*\\n\\s*', '\\n'), r'"
    + _TOKEN.replace("{", "{{").replace("}", "}}")
    + "', 0)"
)
_PADDED = "concat(array('^', '^', '^'), {0})"
_KEPT = BEFORE + APART + 3

_VALUES = """
SELECT doc_id, page_number, field, value, source
FROM @pages LATERAL VIEW stack(2, 'text', text, 'fallback_reason', fallback_reason) AS field, value
WHERE value IS NOT NULL AND length(trim(value)) > 0"""

# a tail is enough if it holds more tokens than are kept, so that its first, perhaps partial one is not among them
_TAILS = f"""
SELECT doc_id, page_number, field, source, slice(p, greatest(size(p) - {_KEPT} + 1, 1), {_KEPT}) AS t
FROM (SELECT *, {_PADDED.format("x")} AS p
      FROM (SELECT *, if(length(value) <= {TAIL} OR size(short) > {_KEPT} + 1, short, {_TOKENS.format("value")}) AS x
            FROM (SELECT *, {_TOKENS.format(f"substr(rtrim(value), -{TAIL})")} AS short FROM ({_VALUES}))))
WHERE size(p) > 3"""

_ENDS = ", ".join(f"count_if(k = {k}) AS e{k}" for k in range(BEFORE + APART + 1))
_NEAR = "CASE k " + " ".join(f"WHEN {k} THEN " + " + ".join(f"e{j}" for j in range(max(0, k - APART), k + APART + 1)) for k in range(1, BEFORE + 1)) + " END"
_BY_FIELD = lambda x: "CASE field " + " ".join(f"WHEN '{f}' THEN {v}D" for f, v in x.items()) + " END"


def _bound(ends: str, n: str, sign: str) -> str:
    """A confidence bound (Wilson's) of the share of ends among the other occurrences; without any, no bound at all."""
    m, s = f"greatest({n} - 1, 0)", f"greatest({ends} - 1, 0)"
    z = SURE * SURE
    share = f"(({s} + {z / 2}D) {sign} {SURE}D * sqrt({s} * ({m} - {s}) / greatest({m}, 1)D + {z / 4}D)) / ({m} + {z}D)".replace("1)D", "1)")
    return f"if({n} > 1, {share}, {'1D' if sign == '+' else '0D'})"


def _verdict(ends: str, n: str, limit: str) -> str:
    """False for an end, true for no end, null if the counts don't say."""
    return f"CASE WHEN {_bound(ends, n, '-')} > {limit} AND {ends} > {LEAST_ENDS} THEN false WHEN {_bound(ends, n, '+')} <= {limit} THEN true END"


# the keys of a trigram, of its last two tokens and of its last token; of (field, w1, w2, w3)
_HEAD, _PAIR = "xxhash64(field, {0}, {1})", "xxhash64(field, {0})"
_AT = lambda k, back: f"t[size(t) - 1 - {k} - {back}]"
_KEY3 = lambda k: f"xxhash64({_HEAD.format(_AT(k, 2), _AT(k, 1))}, {_AT(k, 0)})"
_KEY2 = f"xxhash64({_PAIR.format(_AT(0, 1))}, {_AT(0, 0)})"
_KEY1 = f"xxhash64(field, {_AT(0, 0)})"

_QUERY = f"""
WITH tokens AS (SELECT field, p FROM ({_VALUES}) LATERAL VIEW explode(array({_PADDED.format(_TOKENS.format("value"))})) AS p),
trigrams AS (
  SELECT field, xxhash64(field, p[i - 2], p[i - 1]) AS head, xxhash64(field, p[i - 1]) AS tail, p[i] AS word
  FROM tokens LATERAL VIEW explode(sequence(3, greatest(size(p), 4) - 1)) AS i WHERE i < size(p)),
counts AS (SELECT field, head, tail, word, count(*) AS n FROM trigrams GROUP BY field, head, tail, word),
numbers AS (
  SELECT key, sum(n) AS n FROM counts LATERAL VIEW explode(array(xxhash64(head, word), xxhash64(tail, word), xxhash64(field, word))) AS key GROUP BY key),
longer AS (
  SELECT key, max(n) AS longest
  FROM (SELECT xxhash64(head, substr(word, 1, i)) AS key, n FROM (SELECT * FROM counts WHERE n >= {LONGER}) LATERAL VIEW explode(sequence(1, greatest(length(word) - 1, 1))) AS i)
  GROUP BY key),
final AS (
  SELECT k, {_KEY3("k")} AS key FROM @tails LATERAL VIEW explode(sequence(0, least({BEFORE + APART}, size(t) - 3))) AS k WHERE {_AT("k", 0)} <> '^'
  UNION ALL SELECT 0 AS k, key FROM @tails LATERAL VIEW explode(array({_KEY2}, {_KEY1})) AS key),
ends AS (SELECT key, {_ENDS} FROM final GROUP BY key),
known AS (SELECT e.*, n.n, l.longest FROM ends e JOIN numbers n ON e.key = n.key LEFT JOIN longer l ON e.key = l.key),
last AS (
  SELECT doc_id, page_number, field, source, {_AT(0, 0)} AS word, m, key, if(m = 3, transform(sequence(1, {BEFORE}), k -> if(size(t) - 3 >= k AND {_AT("k", 0)} <> '^', {_KEY3("k")}, NULL)), NULL) AS before
  FROM @tails LATERAL VIEW posexplode(array({_KEY1}, {_KEY2}, {_KEY3(0)})) AS m0, key LATERAL VIEW explode(array(m0 + 1)) AS m),
level AS (
  SELECT doc_id, page_number, field, l.source, l.word, l.m, before, k.n, k.e0, k.longest, {_verdict("k.e0", "k.n", _BY_FIELD(RARELY))} AS said
  FROM last l JOIN known k ON l.key = k.key),
first AS (
  SELECT doc_id, page_number, field, max(source) AS source, max(before) AS before,
         bool_or(m = 3 AND longest >= if(2 * e0 >= n, {LONGER}, {LONGER_MIXED}) * n) AND (max(word) RLIKE r'^\\pL' OR bool_and(m <> 2 OR coalesce(said, true))) AS within,
         max(CASE WHEN m = 3 THEN said END) AS said3, max(CASE WHEN m = 2 THEN said END) AS said2, max(CASE WHEN m = 1 AND NOT startswith(word, '0') THEN said END) AS said1
  FROM level GROUP BY doc_id, page_number, field),
decided AS (SELECT *, if(within, true, coalesce(said3, said2, said1)) AS cut FROM first),
earlier AS (
  SELECT doc_id, page_number, field, min_by(said, if(said IS NULL, NULL, k)) AS cut
  FROM (SELECT d.doc_id, d.page_number, d.field, d.k, {_verdict("(" + _NEAR + ")", "n", _BY_FIELD(NEARLY))} AS said
        FROM (SELECT doc_id, page_number, field, j + 1 AS k, key FROM decided LATERAL VIEW posexplode(before) AS j, key WHERE cut IS NULL AND key IS NOT NULL) d JOIN known x ON d.key = x.key)
  GROUP BY doc_id, page_number, field)
SELECT d.doc_id, d.page_number, d.field, d.source, coalesce(d.cut, e.cut, false) AS cut
FROM decided d LEFT JOIN earlier e ON d.cut IS NULL AND d.doc_id <=> e.doc_id AND d.page_number <=> e.page_number AND d.field = e.field
"""


def _sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """A query over tables written @name; braces are part of its patterns."""
    text = text.replace("{", "{{").replace("}", "}}")
    for name in tables:
        text = text.replace(f"@{name}", f"{{{name}}}")
    return spark.sql(text, **tables)


def judged(pages: DataFrame) -> DataFrame:
    """(doc_id, page_number, field, source, cut) of every value of the two fields that holds a word, number or sign.

    Null and blank values have no row and repeated deliveries one. A value
    whose last tokens stand nowhere else counts as whole. Needs doc_id,
    page_number, text, fallback_reason and source; other columns are ignored.
    """
    spark = pages.sparkSession
    values = spread(pages.select("doc_id", "page_number", "text", "fallback_reason", "source"))
    # a few tokens of each value, read several times
    tails = cut(_sql(spark, _TAILS, pages=values))
    return _sql(spark, _QUERY, pages=values, tails=tails)


def found(pages: DataFrame) -> DataFrame:
    return judged(pages).where("cut").select("doc_id", "page_number", "field")


def rates(pages: DataFrame) -> DataFrame:
    """For each source and field the number of values, of cut ones, and their share."""
    return judged(pages).groupBy("source", "field").agg(F.count("*").alias("n_values"), F.count_if("cut").alias("n_cut")).withColumn("share", F.round(F.col("n_cut") / F.col("n_values"), 6))
