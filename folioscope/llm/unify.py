"""Problem 3: one consistent form for text that looks the same.

The plain form is the compatibility normalisation in composed form, with
look-alike letters of other scripts replaced by the Latin letter they imitate,
every kind of space replaced by the ordinary one and default-ignorable
characters and controls removed. Look-alikes are replaced in words that mix
them with Latin letters or hold nothing else; words of another script stay. The key form is the plain form after full case folding,
with runs of spaces collapsed; two texts that look the same have equal keys.

The degree and ordinal signs are legitimate and stay as they are, although
compatibility normalisation alone would turn the ordinal ones into letters.

Values are normalised once per distinct value of an Arrow batch, in place: no
row is shuffled, and a role repeated in a third of all rows costs next to nothing.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters of other scripts (or rare Latin letters) that are drawn
# like a Latin letter, by the letter they are drawn like.
LOOKALIKES = {
    "A": "АΑᎪꓮ", "B": "ВΒᏴꓐ", "C": "СϹᏟꓚ", "D": "Ꭰꓓ", "E": "ЕΕᎬꓰ", "F": "Ϝꓝ", "G": "ԌᏀꓖ", "H": "НΗᎻꓧ",
    "I": "ІΙӀꓲ", "J": "ЈͿᎫꓙ", "K": "КΚᏦꓗ", "L": "Ꮮꓡ", "M": "МΜϺᎷꓟ", "N": "Νꓠ", "O": "ОΟՕꓳ", "P": "РΡᏢꓑ",
    "Q": "Ԛ", "R": "Ꭱꓣ", "S": "ЅՏᏚꓢ", "T": "ТΤᎢꓔ", "U": "Սꓴ", "V": "ѴᏙꓦ", "W": "ԜᎳꓪ", "X": "ХΧꓫ", "Y": "ҮΥꓬ", "Z": "ΖᏃꓜ",
    "a": "аαɑ", "b": "Ьᖯ", "c": "сϲᴄ", "d": "ԁ", "e": "еҽ", "f": "ẝ", "g": "ɡց", "h": "һհ", "i": "іιıɩ", "j": "јϳ",
    "k": "κк", "l": "ӏǀ", "m": "ⅿм", "n": "ոпη", "o": "оοօᴏ", "p": "рρ", "q": "ԛգ", "r": "гᴦ", "s": "ѕꜱ", "t": "т",
    "u": "υսᴜц", "v": "νѵᴠ", "w": "ѡԝᴡ", "x": "хχ", "y": "уүγ", "z": "ᴢ",
}
_TO_LATIN = {ord(x): latin for latin, like in LOOKALIKES.items() for x in like}
# characters that are their own plain form, and runs of others
_SIMPLE = re.compile(r"[\n\x20-\x7e¡¿°ºª«»\xc0-\xff]*+")
_OTHER = re.compile(r"[^\n\x20-\x7e¡¿°ºª«»\xc0-\xff]+")


# Ranges of the Unicode property Default_Ignorable_Code_Point.
_DEFAULT_IGNORABLE = [
    (0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F),
    (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
]


@cache
def _ignorable() -> dict[int, None]:
    """Default-ignorable code points, and controls that have no width."""
    out = {c for a, z in _DEFAULT_IGNORABLE for c in range(a, z + 1)}
    out |= {c for c in range(0x20) if c not in (9, 10, 11, 12, 13, 0x1C, 0x1D, 0x1E, 0x1F)} | set(range(0x7F, 0xA0)) - {0x85}
    return dict.fromkeys(out)


_LIKE = re.compile("[" + "".join(map(chr, _TO_LATIN)) + "]")
_LETTERS = re.compile(r"\w+")


def _latin(m: re.Match[str]) -> str:
    """A word with its look-alikes replaced, if it mixes them with Latin letters or holds no other letters."""
    letters = [c for c in m[0] if c.isalpha()]
    other = [c for c in letters if ord(c) not in _TO_LATIN]
    return m[0].translate(_TO_LATIN) if len(other) < len(letters) and (not other or any(ord(c) < 0x250 or 0x1E00 <= ord(c) < 0x1F00 for c in other)) else m[0]


@cache
def _spaces() -> dict[int, str]:
    out = {c: " " for c in range(0x3001) if chr(c).isspace()}
    return out | {0x2800: " ", 0x3164: " "}


def plain_form(text: str | None) -> str | None:
    """The plain form of one text; null stays null, empty stays empty."""
    if text is None or _SIMPLE.fullmatch(text):
        return text
    text = text.translate(_spaces()).translate(_ignorable())
    text = unicodedata.normalize("NFC", _OTHER.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text))
    if _LIKE.search(text):
        text = _LETTERS.sub(_latin, text)
    return unicodedata.normalize("NFC", text).translate(_spaces()).translate(_ignorable())


def key_form(text: str | None) -> str | None:
    """The form for comparisons: plain, fully case-folded, spaces collapsed and trimmed."""
    return None if text is None else " ".join(unicodedata.normalize("NFC", (plain_form(text) or "").casefold()).split())


def _forms(values: pd.Series) -> pd.DataFrame:
    each = {v: (plain_form(v), key_form(v)) for v in values.dropna().unique()}
    return pd.DataFrame([each.get(v, (None, None)) for v in values], columns=["plain", "key"], index=values.index)


def unify(df: DataFrame, column: str | Column, plain: str = "plain", key: str = "key") -> DataFrame:
    """``df`` with the plain and key form of a text column.

    Null texts get null forms and empty ones empty forms; rows, their number
    and all other columns stay as they are. The new columns replace columns of
    the same name.
    """
    value = F.col(column) if isinstance(column, str) else column
    rest = [c for c in df.columns if c not in (plain, key)]
    held = df.select(*rest, F.pandas_udf(_forms, "plain string, key string")(value.cast("string")).alias("__forms"))
    return held.select(*rest, F.col("__forms.plain").alias(plain), F.col("__forms.key").alias(key))


def found(separators: DataFrame, sections: DataFrame) -> DataFrame:
    """Rows whose role differs in characters from its plain form; one row for each key, however often it was delivered."""
    parts = [
        separators.select(F.lit("separators").alias("tbl"), "doc_id", F.col("page_number").alias("row_no"), F.col("cargo_normalizado").alias("value")),
        sections.select(F.lit("sections").alias("tbl"), "doc_id", F.col("section_index").alias("row_no"), F.col("cargo_raw").alias("value")),
    ]
    rows = unify(parts[0].unionByName(parts[1]), "value")
    return rows.where("value <> plain").select("tbl", "doc_id", "row_no").distinct()


def roles(separators: DataFrame, sections: DataFrame) -> DataFrame:
    """Each distinct role of either table with its consistent form and its number of rows; null roles are left out."""
    values = separators.select(F.lit("separators").alias("tbl"), F.col("cargo_normalizado").alias("value")).unionByName(sections.select(F.lit("sections").alias("tbl"), F.col("cargo_raw").alias("value")))
    counted = values.where("value is not null").groupBy("tbl", "value").agg(F.count("*").alias("n_rows"))
    return unify(counted, "value").select("tbl", "value", "plain", "key", "n_rows")
