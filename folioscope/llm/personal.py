"""Problem 4: personal information in free text, replaced by typed placeholders.

Regular expressions propose spans; checksums (modulo 11 of tax numbers, Luhn
of cards, modulo 97 of bank accounts) and the words before a span raise or
lower its score, and spans of any kind that reach ``LEAST_SCORE`` are kept.
Names are proposed after titles and set phrases, and by runs of words from a
lexicon of name words that a first pass over all texts learns from those
phrases: words that stand mostly in names. The most frequent of them are sent
to the executors; where there are more, each text gets its own others by a join.

Texts keep their characters, so positions are those of the given text; a line
break counts as a space and a word may be broken by a hyphen at a line's end.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.session import cut, spread

LEAST_SCORE = 2
#: A name word: seen so often after a title or phrase, with this share of all its capitalised uses within names.
NAME_SEEN, NAME_SHARE = 2, 0.2
#: Size bound of the lexicon that is sent to the executors; texts get the words beyond it by a join.
MOST_NAMES = 300_000
KINDS = {"name": "[NOMBRE]", "email": "[CORREO]", "phone": "[TELEFONO]", "id_number": "[IDENTIDAD]", "address": "[DIRECCION]"}

_UP = "A-ZÁÉÍÓÚÜÑÀÈÌÒÙÂÊÔÃÕÇ"
_LOW = "a-záéíóúüñàèìòùâêôãõç"
_HYPHEN = "[-­‐‑¬]"
_WORD = rf"[{_UP}{_LOW}][{_UP}{_LOW}'’]*(?:{_HYPHEN}\s*\n\s*[{_UP}{_LOW}]+)?"
_CAP = rf"(?:[{_UP}]\.|[{_UP}][{_UP}{_LOW}'’]+(?:{_HYPHEN}\s*\n\s*[{_UP}{_LOW}]+)?)"
_SEQUENCE = rf"{_CAP}(?:,?\s{{1,3}}{_CAP}){{1,5}}"
# Titles, and phrases after which a person is named.
_TITLES = r"(?:[Ii]ng|[Aa]rq|[Ss]ra?|[Dd]ra?|[Ll]ic|[Bb]ach|[Tt]éc|ING|ARQ)\.|[Ff]irmado:|[Ff]do\.:?|[Aa]tentamente,"
_PHRASES = (
    r"suscrit[oa],|representante\s+(?:común|legal),|residente|maestro|ingenier[oa]|arquitect[oa]|testigo|comunicarse\s+con|a\s+favor\s+de|a\s+nombre\s+de|de\s+manos\s+de|"
    r"(?:herman|prim|espos|cuñad|tí|hij|soci)[oa]|señor[a]?|don|doña|ciudadan[oa]|identificad[oa]\s+como|supervisor[a]?|inspector[a]?"
)
_AFTER = re.compile(rf"(?:(?:^|(?<=[\s(]))(?:{_TITLES})|\b(?:{_PHRASES}))\s{{1,3}}({_SEQUENCE})")
_TITLE_LOW = re.compile(rf"(?:^|(?<=[\s(]))(?:{_TITLES})\s{{1,3}}({_WORD}(?:,? {{1,3}}{_WORD}){{1,4}})[ \t]*(?:\n|$)")
# Words of firms, offices and places that are no part of a person's name.
_FIRMS = set(
    "sac srl eirl sa saa consorcio grupo constructora constructores ingeniería ingenieria proyectos consultores empresa junta municipalidad gobierno unidad programa ministerio banco "
    "universidad oficina dirección direccion gerencia asociación asociacion comité comite obra obras supervisor especialista jefe coordinador residente gerente ingeniero administrador "
    "médico monitor asistente inspector topógrafo dibujante enfermero villa santa alto nuevo pampa san señor dni ruc cel celular telf teléfono telefono correo email pasaporte carnet código codigo domicilio de del la las los el y en se".split()
)
_FIRM_END = re.compile(r"\s*,?\s*(?:S\.\s?A\.|S\.\s?R\.\s?L|E\.\s?I\.\s?R\.\s?L|S\.A\b)")

_MAIL = re.compile(
    r"(?<![\w.+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_])?\s{0,2}(?:@|\(at\)|\[at\]|\[arroba\]|\(arroba\)|\sarroba\s)\s{0,2}[A-Za-z0-9]+(?:-\s?[A-Za-z0-9]+)*(?:\.[A-Za-z0-9]+(?:-[A-Za-z0-9]+)*)*\.[A-Za-z]{2,}"
)
_SEP = r"[ .\n-]{0,2}"
_PHONE = re.compile(
    rf"(?<![\w.,/-])(?:(?:\+\s?51|0051){_SEP})?(?:9\d{{2}}{_SEP}\d{{3}}{_SEP}\d{{3}}|\(0\d{{1,2}}\)\s?\d{{3}}{_SEP}\d{{3,4}}|0\d{{2}}-\s?\d{{6}}|0\d{{1,2}}-\s?\d{{3}}-?\s?\d{{3,4}})(?![\d/]|[.,-]\d)"
)
_NUMBER = re.compile(r"(?<![\w.,/-])(?:\d{11}|\d{8}-\d|\d{8}|\d{2}\.\d{3}\.\d{3}|\d{4}\s\d{4}|\d{9}|[A-Z]{1,2}\d{6,8}|\d(?:[ -]?\d){12,19}|[A-Z]{2}\d{2}(?:\s?[A-Z0-9]{4}){3,7}\s?[A-Z0-9]{0,3})(?![\w/]|[.,-]\d)")
_STREET = re.compile(
    r"(?<![\w@.])(?<![-­‐‑¬]\n)(?<![-­‐‑¬] \n)(?:(?:(?:[Aa]v|[Jj]r|[Cc]a|[Pp]sje|[Pp]je|AV|JR|PSJE|CALLE|[Cc]l)\.|[Aa]v(?:enida)?|AVENIDA|[Jj]ir[oó]n|JIR[OÓ]N|[Cc]alle|CALLE|[Pp]asaje|PASAJE|[Pp]rolongaci[oó]n|[Cc]arretera|[Mm]alec[oó]n|[Aa]lameda)\s{1,3}"
    r"(?:[^\W\d_][\w.'’]*(?:[-­‐‑¬]\s*\n\s*\w+)?[ \n]{1,3}){1,6}(?:(?:N[°ºo]\.?|[Nn]ro\.?|NRO\.?|#)\s{0,2})?\d{1,5}\b"
    r"|(?:[Mm]z|MZ|[Mm]anzana|MANZANA)\.?\s{1,3}[A-Za-z0-9]{1,3}['’]?\s{1,3},?(?:[Ll]ote|[Ll]t\.?|LOTE)\s{1,3}\d{1,4})"
)
_STREET_TAIL = re.compile(
    rf"(?:,?\s{{1,3}}(?:(?:[Ii]nt|[Dd]pto|[Oo]f|[Uu]rb|URB|[Pp]iso)\.?|AA\.\s?HH\.?)\s{{1,3}}(?:\d+|{_CAP}(?:\s{{1,2}}{_CAP}){{0,2}}))*(?:\s?[,-]\s{{1,3}}(?:(?:Villa|Santa|Alto|Nuevo|Pampa|San)\s{{1,2}})?{_CAP})?"
)
_BROKEN = re.compile(rf"{_HYPHEN}\s*\n\s*")
# Words before a number that say what it is.
_SAYS_PHONE = re.compile(r"cel(?:ular)?\b|tel[eé]?f|fono|m[oó]vil|llama|n[uú]mero\s+es|whats|contact|comun[ií]c", re.I)
_SAYS_MAIL = re.compile(r"correo|e-?mail|escrib|buz[oó]n|contact|comun[ií]c", re.I)
_SAYS_PLACE = re.compile(r"domicili|direcci[oó]n|resid|viv[ieí]|ubicad|sit[oa]\s|local", re.I)
# a road that works are done on, a page of the web
_SAYS_WORKS = re.compile(r"(?:tramo|progresiva|construcci[oó]n|mejoramiento|rehabilitaci[oó]n|mantenimiento)\s+(?:de\s+)?(?:la\s+|el\s+)?$", re.I)
_SAYS_WEB = re.compile(r"(?:https?|ftp)://\S*$|www\.\S*$", re.I)
_SAYS_ID = re.compile(r"\bd\.?\s?n\.?\s?i\b|documento|identi|\bruc\b|r\.u\.c|pasaporte|carn[eé]|c[eé]dula|extranjer|contribuyente|tarjeta|cuenta|\bcci\b|iban", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def ruc(digits: str) -> bool:
    """The check digit of an 11-digit tax number."""
    total = sum(int(c) * w for c, w in zip(digits, (5, 4, 3, 2, 7, 6, 5, 4, 3, 2)))
    return (11 - total % 11) % 10 == int(digits[10])


def _before(text: str, at: int, n: int = 45) -> str:
    return _BROKEN.sub("", text[max(0, at - n) : at])


def _id_score(span: str, before: str) -> int:
    said = 2 if _SAYS_ID.search(before[-32:]) else -1 if _SAYS_PHONE.search(before[-20:]) else 0
    bare = re.sub(r"[\s.-]", "", span)
    if bare.isdigit():
        if len(bare) == 11:
            return said + (2 if bare[:2] in ("10", "15", "16", "17", "20") and ruc(bare) else 0)
        if len(bare) in (8, 9):
            return said
        if 13 <= len(bare) <= 19:
            return said + (1 if luhn(bare) else -1)
        return said if len(bare) == 20 else 0
    if re.fullmatch(r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}", bare) and mod97(bare):
        return said + 2
    return said if re.fullmatch(r"[A-Z]{1,2}\d{6,8}", bare) else 0


def _mail_score(span: str, before: str) -> int:
    """A plain address with a domain is enough by itself; spelt-out signs need the words of one, or no space around; a part of a web address is none."""
    score = 2 if "@" in span or re.search(r"[(\[]", span) else 1
    return score + (1 if _SAYS_MAIL.search(before) else 0) - (3 if _SAYS_WEB.search(before) else 0)


def _place_score(span: str, before: str) -> int:
    """A street or block with its number, where it does not say that works are done on it."""
    return 2 + (1 if _SAYS_PLACE.search(before) else 0) - (2 if _SAYS_WORKS.search(before) else 0)


def _name_score(known: int, titled: bool, phrased: bool) -> int:
    """A title, or two name words, are enough; a phrase or a single name word needs the other."""
    return 2 * titled + phrased + min(known, 2)


def fold(word: str) -> str:
    return _BROKEN.sub("", word).lower().strip(".'’")


def name_votes(text: str, votes: Counter, others: Counter) -> None:
    """Adds the words of names after titles and phrases to ``votes`` and all other capitalised words to ``others``."""
    inside: list[tuple[int, int]] = []
    for m in _AFTER.finditer(text):
        if not _FIRM_END.match(text, m.end()):
            ws = [fold(w) for w in re.findall(_WORD, m[1])]
            if not _FIRMS & set(ws):
                votes.update(w for w in ws if len(w) > 2)
                inside.append(m.span(1))
    at = 0
    for a, b in [*inside, (len(text), len(text))]:
        others.update(_CAPITALISED(text[at:a]))
        at = b


_CAPITALISED = re.compile(rf"(?<=[^.\n]\s)[{_UP}][{_UP}{_LOW}]{{2,}}").findall


def lexicon(texts: DataFrame) -> DataFrame:
    """(word, seen): name words learnt from a column ``text``. One pass; only word counts are shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        votes: Counter[str] = Counter()
        others: Counter[str] = Counter()
        for b in batches:
            for t in b["text"]:
                if t:
                    name_votes(t, votes, others)
            if len(others) > 500_000:
                yield _counted(votes, others)
                votes, others = Counter(), Counter()
        yield _counted(votes, others)

    counts = texts.select("text").mapInPandas(run, "word string, seen bigint, other bigint").groupBy("word").agg(F.sum("seen").alias("seen"), F.sum("other").alias("other"))
    return counts.where(f"seen >= {NAME_SEEN} AND seen >= {NAME_SHARE} * (seen + other)").select("word", "seen")


def _counted(votes: Counter, others: Counter) -> pd.DataFrame:
    lower: Counter[str] = Counter()
    for w, n in others.items():
        lower[w.lower()] += n
    words = sorted({*votes, *lower})
    return pd.DataFrame({"word": pd.Series(words, dtype=object), "seen": [votes[w] for w in words], "other": [lower[w] for w in words]}).astype({"seen": "int64", "other": "int64"})


_TOKENS = re.compile(rf"[{_UP}{_LOW}][{_UP}{_LOW}'’]*(?:{_HYPHEN}\s*\n\s*[{_UP}{_LOW}]+)?").finditer


def _names(text: str, names: frozenset[str], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    for m in _AFTER.finditer(text):
        a, b = m.span(1)
        ws = [fold(w) for w in re.findall(_WORD, m[1])]
        if _FIRM_END.match(text, b) or not ws or ws[0] in _FIRMS:
            continue
        known = sum(w in names for w in ws)
        titled = re.match(_TITLES, m[0]) is not None
        if _name_score(known, titled and not (_FIRMS & set(ws)), not titled or known > 0) >= LEAST_SCORE:
            # a next line that begins with no name word is a role or an office
            for w in re.finditer(_WORD, m[1]):
                if w.start() and (fold(w[0]) in _FIRMS or "\n" in m[1][: w.start()] and fold(w[0]) not in names and m[1][: w.start()].rstrip(" \n")[-1:] != "," and known >= 2):
                    b = a + len(m[1][: w.start()].rstrip(" ,\n"))
                    break
            yield a, b
    for m in _TITLE_LOW.finditer(text):
        ws = [fold(w) for w in re.findall(_WORD, m[1])]
        if sum(w in names for w in ws) >= 1 and ws[0] not in _FIRMS:
            yield m.span(1)
    # runs of name words wherever they are
    run: list[tuple[int, int, bool]] = []
    for m in _TOKENS(text):
        w = m[0]
        known = (_BROKEN.sub("", w) if "\n" in w else w).lower() in names
        initial = len(w) == 1 and w.isupper() and text[m.end() : m.end() + 1] == "."
        if known or initial:
            if run and not re.fullmatch(r"\.?,?\s{1,3}(?:\n\s*)?|\s*\n\s*", text[run[-1][1] : m.start()]):
                yield from _run(run)
                run = []
            run.append((m.start(), m.end(), known))
        elif run:
            yield from _run(run)
            run = []
    yield from _run(run)


def _run(run: list[tuple[int, int, bool]]) -> Iterator[tuple[int, int]]:
    while run and not run[-1][2]:
        run = run[:-1]
    known = sum(k for _, _, k in run)
    # an initial counts as a name word beside one
    if _name_score(known + (len(run) > known and known > 0), False, False) >= LEAST_SCORE:
        yield run[0][0], run[-1][1]


def spans(text: str | None, names: frozenset[str]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every personal item, in order and without overlaps; none for null and empty texts."""
    if not text:
        return []
    proposed: list[tuple[int, int, str]] = []
    if "@" in text or "arroba" in text or "at" in text and ("(at)" in text or "[at]" in text):
        proposed += [(*m.span(), "email") for m in _MAIL.finditer(text) if _mail_score(m[0], _before(text, m.start())) >= LEAST_SCORE]
    for m in _STREET.finditer(text):
        if _place_score(m[0], _before(text, m.start())) >= LEAST_SCORE:
            proposed.append((m.start(), _STREET_TAIL.match(text, m.end()).end(), "address"))
    for m in _PHONE.finditer(text):
        before = _before(text, m.start())
        shaped = m[0][0] in "+(" or m[0].startswith("0051")
        score = (2 if shaped else 1) + (2 if _SAYS_PHONE.search(before) else 0) - (2 if _SAYS_ID.search(before[-20:]) else 0)
        if score >= LEAST_SCORE:
            proposed.append((*m.span(), "phone"))
    for m in _NUMBER.finditer(text):
        if _id_score(m[0], _before(text, m.start())) >= LEAST_SCORE:
            proposed.append((*m.span(), "id_number"))
    proposed += [(a, b, "name") for a, b in _names(text, names, [])]
    proposed.sort(key=lambda x: (x[0], -x[1]))
    out: list[tuple[int, int, str]] = []
    for p in proposed:
        if not out or p[0] >= out[-1][1]:
            out.append(p)
        elif out[-1][2] == p[2] == "name" and p[1] > out[-1][1]:
            out[-1] = (out[-1][0], p[1], "name")
    return out


def redact(text: str | None, found: list[tuple[int, int, str]]) -> str | None:
    """The text with each span replaced by its kind's placeholder."""
    if not text or not found:
        return text
    out, at = [], 0
    for a, b, kind in found:
        out += [text[at:a], KINDS[kind]]
        at = b
    return "".join([*out, text[at:]])


def texts(pages: DataFrame, sections: DataFrame) -> DataFrame:
    """(tbl, doc_id, page_number, text) of both tables' non-empty texts."""
    a = pages.select(F.lit("pages").alias("tbl"), "doc_id", "page_number", "text")
    b = sections.select("doc_id", F.explode("pages").alias("p")).select(F.lit("sections").alias("tbl"), "doc_id", F.col("p.page_number").alias("page_number"), F.col("p.text").alias("text"))
    return spread(a.unionByName(b).where(F.length("text") > 0))


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(i, w) for i, t in zip(b["key"], b["text"]) for w in {(_BROKEN.sub("", m[0]) if "\n" in m[0] else m[0]).lower() for m in _TOKENS(t)} | {fold(x) for x in re.findall(_WORD, t)}]
        yield pd.DataFrame(rows, columns=["key", "word"])


def _with_names(source: DataFrame) -> tuple[DataFrame, Broadcast]:
    """The texts with a column ``own``, their name words beyond those that are sent to all; and these."""
    words = cut(lexicon(source))
    n = words.count()
    top = words if n <= MOST_NAMES else words.orderBy(F.desc("seen"), "word").limit(MOST_NAMES)
    names = frozenset(r.word for r in top.select("word").toLocalIterator())
    shared = source.sparkSession.sparkContext.broadcast(names)
    if n <= MOST_NAMES:
        return source.withColumn("own", F.lit(None).cast("array<string>")), shared
    least = top.agg(F.min(F.struct("seen", F.col("word")))).first()[0].seen
    # ties at the bound may be sent and joined as well, which changes nothing
    rest = words.where(F.col("seen") <= least).select("word")
    keyed = source.withColumn("key", F.xxhash64("text"))
    own = keyed.select("key", "text").mapInPandas(_words, "key bigint, word string").join(rest, "word", "left_semi").groupBy("key").agg(F.collect_set("word").alias("own"))
    return keyed.join(own, "key", "left").drop("key"), shared


def _of(names: frozenset[str], own) -> frozenset[str]:
    return names if own is None or not len(own) else names | frozenset(own)


def found(pages: DataFrame, sections: DataFrame) -> DataFrame:
    """One row per occurrence: tbl, doc_id, page_number, start_pos (0-based, in characters), kind."""
    source, names = _with_names(texts(pages, sections))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(t, d, p, a, k) for t, d, p, text, own in zip(b["tbl"], b["doc_id"], b["page_number"], b["text"], b["own"]) for a, _, k in spans(text, _of(names.value, own))]
            yield pd.DataFrame(rows, columns=["tbl", "doc_id", "page_number", "start_pos", "kind"])

    return source.mapInPandas(run, "tbl string, doc_id string, page_number int, start_pos int, kind string").distinct()


def redacted(pages: DataFrame, sections: DataFrame) -> DataFrame:
    """The same texts with typed placeholders, and the number of items replaced; repeated deliveries once."""
    source, names = _with_names(texts(pages, sections))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hits = [spans(t, _of(names.value, own)) for t, own in zip(b["text"], b["own"])]
            yield b[["tbl", "doc_id", "page_number"]].assign(text=[redact(t, h) for t, h in zip(b["text"], hits)], n_items=[len(h) for h in hits])

    out = source.mapInPandas(run, "tbl string, doc_id string, page_number int, text string, n_items int")
    return out.dropDuplicates(["tbl", "doc_id", "page_number", "text"])
