"""Text functions as Column expressions, all evaluated in the JVM.

Spark's own ``trim``, ``initcap`` and regular digits differ from the semantics
needed here (Unicode space, capitals after any sign, superscript digits), so
each is composed from built-ins.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.config import DEFAULT, Config

_SPACE = r"[\s\p{Z}\x{1C}-\x{1F}\x{85}]"
_LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
_DIGITS = r"^[\p{Nd}²³¹⁰⁴-⁹₀-₉]+$"
_POST = r"n[°º]?\s*(\d+)"


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is evaluated once, however often ``f`` uses it, also within lambdas."""
    return F.element_at(F.transform(F.array(value), f), 1)


def strip(c: Column) -> Column:
    """Without Unicode space at both ends."""
    return F.regexp_replace(c, f"^{_SPACE}+|{_SPACE}+$", "")


def blank(c: Column) -> Column:
    return F.length(strip(c)) == 0


@functools.cache
def _plain_letters() -> tuple[str, str]:
    """All letters of the basic plane whose decomposition is one letter and marks, and these letters."""
    marked, plain = [], []
    for code in range(0x10000):
        c = chr(code)
        kept = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if kept != c and len(kept) == 1 and c.lower() == c:
            marked.append(c)
            plain.append(kept)
    return "".join(marked), "".join(plain)


def fold(c: Column) -> Column:
    """Lower case without accents (n for ñ)."""
    marked, plain = _plain_letters()
    return F.regexp_replace(F.translate(F.lower(c), marked, plain), r"\p{Mn}", "")


def title(c: Column) -> Column:
    """Each run of letters with a capital, wherever it begins."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{M}]+|[^\p{L}\p{M}]+)"), 0)
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 30))), "")


def normal_role(c: Column, config: Config = DEFAULT) -> Column:
    """A role with known misreadings replaced, in title case."""
    lowered = F.lower(strip(c))
    return title(functools.reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1].lower())), config.misreadings, lowered))


def is_digits(c: Column) -> Column:
    return c.rlike(_DIGITS)


def group_key(c: Column) -> Column:
    """Key under which sections of a role are consolidated; the number of the post in one spelling."""
    return F.regexp_replace(F.lower(strip(c)), _POST, "n°$1")


def post_number(c: Column) -> Column:
    """The number of the post, or null."""
    found = F.regexp_extract(F.lower(c), _POST, 1)
    return F.when(found != "", found)


def lines_of(c: Column) -> Column:
    """Lines at every Unicode line end; a last empty line is none."""
    return bind(F.split(c, _LINE_END), lambda p: F.when(F.length(F.element_at(p, -1)) == 0, F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0)))).otherwise(p))


def kept_lines(lines: Column) -> Column:
    """Lines that aren't blank; null ones are blank."""
    return F.filter(lines, lambda x: x.isNotNull() & ~blank(x))


def ngrams(lines: Column, n: int) -> Column:
    """``n`` neighbouring lines joined by a space; none if there are fewer."""
    grams = lambda x: F.transform(F.sequence(F.lit(1), F.greatest(F.size(x) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(x, i, n), " "))
    return bind(lines, lambda x: F.when(F.size(x) < n, F.array().cast("array<string>")).otherwise(grams(x)))


def match_lines(c: Column) -> Column:
    """Lines of a page that may hold a role: no numbers, no rules of dashes, no words of up to two letters."""
    stripped = F.filter(F.transform(lines_of(c), strip), lambda x: F.length(x) > 0)
    return F.filter(stripped, lambda x: ~is_digits(x) & ~x.rlike(r"^-+$") & ~((F.length(x) <= 2) & x.rlike(r"^\p{L}+$")))


def match_candidates(c: Column) -> Column:
    """What is compared with the roles, in order of priority: the text, the cleaned text, lines, pairs and triples."""
    return bind(match_lines(c), lambda lines: F.concat(F.array(c, F.array_join(lines, " ")), lines, ngrams(lines, 2), ngrams(lines, 3)))


def after_thought(c: Column) -> Column:
    """A model's reply after its last closing thought tag."""
    return strip(F.substring_index(c, "</think>", -1))


def contains_any(c: Column, phrases: Sequence[str]) -> Column:
    return functools.reduce(lambda x, y: x | y, [c.contains(p) for p in phrases], F.lit(False))


def md_escape(c: Column) -> Column:
    return strip(F.replace(F.replace(c, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")))


def preview(c: Column, n: int, line_end: str | None = None) -> Column:
    """The first ``n`` characters; line ends replaced by ``line_end`` if given."""
    cut = F.substring(c, 1, n)
    return cut if line_end is None else F.replace(cut, F.lit("\n"), F.lit(line_end))


def eta(seconds: Column) -> Column:
    """A duration as ``0s``, ``12s``, ``03m05s`` or ``01h02m03s``; below one second and null are ``0s``."""
    s = F.floor(F.coalesce(seconds, F.lit(0.0))).cast("bigint")
    h, m, r = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    two = lambda x: F.lpad(x.cast("bigint").cast("string"), 2, "0")
    return F.when(s <= 0, "0s").when(h > 0, F.concat(two(h), F.lit("h"), two(m), F.lit("m"), two(r), F.lit("s"))).when(m > 0, F.concat(two(m), F.lit("m"), two(r), F.lit("s"))).otherwise(F.concat(r.cast("string"), F.lit("s")))


def or_default(c: Column, default: str) -> Column:
    """Null and empty become the default."""
    return F.coalesce(F.when(c != "", c), F.lit(default))


def page_of_path(path: Column) -> Column:
    """The number after the last underscore of a file's stem, else 0."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    return F.coalesce(F.element_at(F.split(stem, "_"), -1).try_cast("int"), F.lit(0))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def polygon(points: Column) -> Column:
    """``(x,y) → (x,y)`` of an array of points."""
    return F.array_join(F.transform(points, lambda p: F.concat(F.lit("("), p[0].cast("string"), F.lit(","), p[1].cast("string"), F.lit(")"))), " → ")


def box(corners: Column) -> Column:
    """``x1,y1,x2,y2`` of an array of two or more points."""
    return F.array_join(F.transform(F.flatten(corners), lambda x: x.cast("string")), ",")


def fixed(c: Column, digits: int) -> Column:
    """A number with so many digits after the point, rounded half to even on its exact binary value; ``nan`` for no number.

    The shortest decimal text decides unless it lies just between two results;
    then the number's mantissa, an integer, is compared with the middle exactly.
    For numbers below a thousand million.
    """
    unit = 10**digits

    def of(a: Column) -> Column:
        scaled = a.cast("decimal(27,17)") * F.lit(unit).cast(f"decimal({digits + 1},0)")
        # the power of two that makes the number an integer
        k = F.when(a > 0, F.lit(53) - F.floor(F.log2(a)).cast("int")).otherwise(F.lit(0))
        return F.struct(F.floor(scaled).cast("bigint").alias("low"), (scaled - F.floor(scaled)).alias("rest"), k.alias("k"), a.alias("a"))

    def rounded(x: Column) -> Column:
        low, rest, k = x["low"], x["rest"], x["k"]
        power = lambda n: F.call_function("shiftleft", F.lit(1).cast("bigint"), n.cast("int")).cast("decimal(19,0)")
        two = power(F.least(k, F.lit(60))) * power(F.greatest(F.least(k - 60, F.lit(40)), F.lit(0))).cast("decimal(13,0)")
        exact = (x["a"] * F.pow(F.lit(2.0), k)).cast("bigint").cast("decimal(19,0)") * F.lit(unit * 10).cast(f"decimal({digits + 2},0)")
        middle = (low * 10 + 5).cast("decimal(15,0)") * two.cast("decimal(22,0)")
        up = F.when(rest != F.lit("0.5").cast("decimal(2,1)"), rest > F.lit("0.5").cast("decimal(2,1)")).when(exact != middle, exact > middle).otherwise(low % 2 == 1)
        n = low + up.cast("bigint")
        return F.concat(F.floor(n / unit).cast("bigint").cast("string"), F.lit("."), F.lpad((n % unit).cast("string"), digits, "0")) if digits else n.cast("string")

    text = F.concat(F.when(c < 0, "-").otherwise(""), bind(of(F.abs(c)), rounded))
    return F.when(F.isnan(c), "nan").otherwise(text)


def plural(n: Column, one: str, many: str) -> Column:
    """The word for one or for several."""
    return F.when(n == 1, one).otherwise(many)
