"""Problem 6: free-entered values mapped to a list of reference entries.

The reference entries and their alias paths (abbreviated or feminine heads,
entries without their short words, inverted entries) are put into one trie,
spelt as folded letters without spaces. A Levenshtein automaton with adjacent
transpositions, simulated bit-parallel with one integer for each number of
errors, walks the trie and returns every entry within a distance that depends
on the length of the entry's own part (its head and short words excluded).
Values are searched once per distinct value.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.unify import plain_form

# Spanish words that carry no meaning of their own in a role.
SHORT = {"de", "del", "en", "la", "las", "el", "los", "y", "e", "a", "al", "para", "por", "con"}
# Ways in which the head of a role is written.
HEADS = {
    "especialista": ["esp", "espec", "especial", "experto", "experta", "profesional especialista", "especialidad"],
    "residente": ["resid", "res", "residencia", "ing residente"],
    "asistente": ["asist", "asis", "asistencia", "asistenta"],
    "jefe": ["jefatura", "jefa", "jef"],
    "coordinador": ["coord", "coordinadora", "coordinacion"],
    "gerente": ["gte", "ger", "gerencia", "gerenta"],
    "supervisor": ["sup", "superv", "supervisora", "supervision"],
    "ingeniero": ["ing", "ingeniera"],
    "administrador": ["adm", "admin", "administradora", "administracion"],
    "medico": ["med", "medica"],
    "enfermero": ["enf", "enfermera"],
    "topografo": ["top", "topog", "topografa"],
    "dibujante": ["dib", "dibuj"],
    "inspector": ["insp", "inspectora", "inspeccion"],
    "monitor": ["mon", "monit", "monitora", "monitoreo"],
}
#: Reference entries in one trie, and shares into which the rows of a value are spread.
BLOCK, SALTS = 20_000, 16
_POST = re.compile(r"[\s,;(-]*\b(?:n(?:ro|[uú]m(?:ero)?|o)?\s*[°º.]*|#)\s*\d+\s*\)?\s*$", re.I)
_TRAIL = re.compile(r"(?:[\s,;.(-]*\b(?:propuest[oa]|titular|suplente|altern[oa]|(?:lote|tramo|item|ítem|frente|grupo)\s*\d+)\b[\s).]*)+$", re.I)
_LEAD = re.compile(r"^\s*(?:(?:\d+\s*[.)-]+|cargo\s*:|puesto\s*:|rol\s*:|profesional\s+clave\s*:?|personal\s+clave\s*:?|el\s+|la\s+)\s*)+", re.I)
_TITLE = re.compile(r"^\s*(?:ing|arq|sr|sra|dr|dra|lic|bach|tec)\s*\.\s*(?=\S)", re.I)
_DIGITS = str.maketrans({"0": "o", "1": "i", "5": "s", "@": "a", "$": "s", "|": "l", "3": "e", "4": "a", "6": "o", "8": "b", "2": "z"})


def _fold(text: str) -> str:
    text = unicodedata.normalize("NFD", (plain_form(text) or "").casefold())
    return "".join(c for c in text if not unicodedata.combining(c))


def _letters(text: str) -> str:
    return "".join(c for c in text if c.isalpha())


def clean_value(value: str) -> str:
    """The value without the number of the post, labels and remarks, folded, with signs read for letters put back."""
    text = _fold(value).strip()
    for _ in range(3):
        before = text
        text = _LEAD.sub("", _TRAIL.sub("", _POST.sub("", text)))
        if text == before:
            break
    text = re.sub(r"(?<=[a-z])\((?=[a-z])", "c", text)
    return " ".join(w.translate(_DIGITS) if any(c.isalpha() for c in w) else w for w in text.split())


def allowed(n: int) -> int:
    """Errors allowed in an entry whose own part has ``n`` letters."""
    return 1 if n <= 6 else 2 if n <= 10 else 3 if n <= 18 else 4


class Trie:
    """Reference entries with alias paths; ``search`` returns every entry within its own distance."""

    def __init__(self, entries: list[tuple[int, str]], spell=str):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.spell = spell
        for cargo_id, text in entries:
            for path, most in self._paths(text):
                self._add(spell(path), cargo_id, most)
        self.deepest = max((m for e in self.ends for _, m in e), default=0)
        #: letters of the longest value that may be near an entry
        self.longest = max((len(spell(path)) for _, text in entries for path, _ in self._paths(text)), default=0) + self.deepest

    @staticmethod
    def _paths(text: str) -> set[tuple[str, int]]:
        words = _letters_words(text)
        if not words:
            return set()
        head, rest = words[0], words[1:]
        own = [w for w in rest if w not in SHORT]
        most = allowed(len("".join(own)) + len(head) // 2)
        lead = []
        while rest and rest[0] in SHORT:
            lead.append(rest[0])
            rest = rest[1:]
        paths = set()
        for h in [head, *HEADS.get(head, [])]:
            h = h.replace(" ", "")
            for prep in {"".join(lead), "", "de" if lead else "", "en" if lead else ""}:
                for tail in {"".join(rest), "".join(own)}:
                    paths.add((h + prep + tail, most))
                    if rest:
                        paths.add((tail + h + prep, most))
            # an entry may also be inverted at a later word: "Marcha, Supervisor de Puesta en"
            for i in range(1, len(rest)):
                if rest[i] not in SHORT:
                    for front in (lead + rest[:i], [w for w in rest[:i] if w not in SHORT], [w for j, w in enumerate(lead + rest[:i]) if w not in SHORT or j < len(lead + rest[:i]) - 1]):
                        paths.add(("".join(rest[i:]) + h + "".join(front), most))
        return paths

    def _add(self, path: str, cargo_id: int, most: int) -> None:
        node = 0
        for c in path:
            nxt = self.children[node].get(c)
            if nxt is None:
                nxt = len(self.children)
                self.children.append({})
                self.ends.append([])
                self.children[node][c] = nxt
            node = nxt
        if (cargo_id, most) not in self.ends[node]:
            self.ends[node].append((cargo_id, most))

    def search(self, word: str, errors: int | None = None) -> dict[int, int]:
        """Entries by id, each with its least number of errors, at most ``errors`` and at most what its length allows."""
        word = self.spell(word)
        k = self.deepest if errors is None else min(errors, self.deepest)
        n = len(word)
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i + 1
        goal, full = 1 << n, (1 << n + 1) - 1
        found: dict[int, int] = {}
        # a state: for each number of errors, the set of positions of the word that can be reached
        start = [((1 << e + 1) - 1) & full for e in range(k + 1)]
        stack = [(0, start, None, "")]
        while stack:
            node, state, before, last = stack.pop()
            for cargo_id, most in self.ends[node]:
                for e in range(min(most, k) + 1):
                    if state[e] & goal:
                        found[cargo_id] = min(e, found.get(cargo_id, 99))
                        break
            for c, child in self.children[node].items():
                hit = masks.get(c, 0)
                new = [(state[0] << 1) & hit]
                for e in range(1, k + 1):
                    x = (state[e] << 1) & hit | state[e - 1] | state[e - 1] << 1 | new[e - 1] << 1
                    if before is not None:
                        # the word has this letter where the path had the one before, and the other way round
                        x |= ((before[e - 1] << 1 & hit) << 1) & masks.get(last, 0)
                    new.append(x & full)
                if any(new):
                    stack.append((child, new, state, c))
        return found


def _letters_words(text: str) -> list[str]:
    return [w for w in (_letters(x) for x in _fold(text).split()) if w]


def skeleton(word: str) -> str:
    """Letter groups that scanning confuses with one letter, as that letter, in values and entries alike."""
    return word.replace("rn", "m").replace("ri", "n").replace("cl", "d").replace("vv", "w").replace("ii", "u")


@lru_cache(maxsize=4)
def tries(entries: tuple[tuple[int, str], ...]) -> tuple[Trie, Trie]:
    return Trie(list(entries)), Trie(list(entries), skeleton)


def match(value: str | None, trie: tuple[Trie, ...]) -> list[tuple[int, int]]:
    """All entries within their distance, as (entry, distance), nearest first; none for an empty value.

    Entries that are near only where confused letter groups count as equal
    come after those that are near as they are written.
    """
    return [(cargo_id, e) for _, e, cargo_id in ranked(value, trie)]


def ranked(value: str | None, trie: tuple[Trie, ...]) -> list[tuple[int, int, int]]:
    """(level, distance, entry) of all entries within their distance; the level is the place of the first trie that has it."""
    text = clean_value(value or "")
    forms = [text]
    if (bare := _TITLE.sub("", text)) != text:
        forms.append(bare)
    best: dict[int, tuple[int, int]] = {}
    for word in {_letters(f) for f in forms} - {""}:
        for level, t in enumerate(trie):
            if len(t.spell(word)) <= t.longest:
                for cargo_id, e in t.search(word).items():
                    best[cargo_id] = min((level, e), best.get(cargo_id, (99, 99)))
    return sorted((level, e, cargo_id) for cargo_id, (level, e) in best.items())


def map_values(values: DataFrame, reference: DataFrame) -> DataFrame:
    """Each distinct non-empty ``value`` with ``cargo_id`` (-1 without a match or with two equally near), its distance and all candidates.

    ``reference`` (cargo_id, cargo_oficial) is searched in blocks of at most
    ``BLOCK`` entries, each a trie of its own; the nearest of all blocks counts.
    An empty list leaves every value unmatched. Null and blank values are left
    out. Distinct values are spread over all cores, as each costs a search.
    """
    entries = reference.select("cargo_id", "cargo_oficial").where("cargo_id is not null and cargo_oficial is not null").distinct()
    blocks = max(1, -(-entries.count() // BLOCK))
    n = 2 * values.sparkSession.sparkContext.defaultParallelism
    distinct = values.select(F.col("value").cast("string").alias("value")).where("trim(value) <> ''").distinct().repartition(n, "value")
    found = None
    for i in range(blocks):
        own = tuple(sorted((r.cargo_id, r.cargo_oficial) for r in entries.where(F.pmod(F.xxhash64("cargo_id"), F.lit(blocks)) == i).collect()))

        def run(batches: Iterator[pd.DataFrame], own=own) -> Iterator[pd.DataFrame]:
            trie = tries(own)
            for b in batches:
                yield pd.DataFrame({"value": b["value"], "hits": [[{"level": g, "distance": e, "cargo_id": c} for g, e, c in ranked(v, trie)] for v in b["value"]]})

        part = distinct.mapInPandas(run, "value string, hits array<struct<level:int,distance:int,cargo_id:int>>")
        found = part if found is None else found.unionByName(part)
    if blocks > 1:
        found = found.groupBy("value").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
    first, second = F.get("hits", F.lit(0)), F.get("hits", F.lit(1))
    clear = first.isNotNull() & (second.isNull() | (F.struct(first["level"], first["distance"]) < F.struct(second["level"], second["distance"])))
    return found.select(
        "value", F.when(clear, first["cargo_id"]).otherwise(-1).alias("cargo_id"), F.when(clear, first["distance"]).alias("distance"), F.transform("hits", lambda h: F.struct(h["cargo_id"], h["distance"])).alias("candidates")
    )


def _rows(separators: DataFrame, sections: DataFrame) -> DataFrame:
    a = separators.select(F.lit("separators").alias("tbl"), "doc_id", F.col("page_number").alias("row_no"), F.col("cargo_detectado").alias("value"))
    b = sections.select(F.lit("sections").alias("tbl"), "doc_id", F.col("section_index").alias("row_no"), F.col("cargo_raw").alias("value"))
    return a.unionByName(b).where("trim(value) <> ''").distinct()


def found(separators: DataFrame, sections: DataFrame, reference: DataFrame) -> DataFrame:
    """Each non-empty role with its entry of the list, -1 where the list has none."""
    rows = _rows(separators, sections)
    # a value may be in a third of all rows: its rows are spread, and the mapping is repeated for each share of them
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "row_no"), F.lit(SALTS)))
    mapped = map_values(rows, reference).select("value", "cargo_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("__salt"))
    return salted.join(mapped, ["value", "__salt"]).select("tbl", "doc_id", "row_no", "cargo_id").distinct()


def unmatched(separators: DataFrame, sections: DataFrame, reference: DataFrame) -> DataFrame:
    """The values without an entry, with their number of rows and the entries that were equally near."""
    rows = _rows(separators, sections)
    counted = rows.groupBy("value").agg(F.count("*").alias("n_rows"))
    return map_values(counted, reference).where("cargo_id < 0").join(counted, "value").select("value", "n_rows", F.array_join(F.transform("candidates", lambda c: c.cargo_id.cast("string")), ",").alias("near"))
