"""Problem 8: evaluation passages inside the corpus.

Every stretch of ``WORDS`` words of a test passage may be altered in up to
``ERRORS`` words. It is split by the pigeonhole rule into one piece more than
that, of ``PIECE`` words, so an occurrence keeps at least one piece unaltered
and, by the q-gram count, ``WORDS - PIECE + 1 - PIECE * ERRORS`` runs of that
length. Documents are scanned once for exact pieces (a hash table of all pieces
of the test items); hits near one diagonal are chained, and the stretches of a
chain are verified with Myers' bit-parallel edit distance over characters.

Two rules say which verified stretches count, and neither looks at what kind of
words they hold:

* A place of a document belongs to the item that shares most pieces with the
  words around it (to several, if they share equally many), so a phrase that
  many items use is no evidence for all of them.
* Formulas are no leaks: sentences that several passages hold, and words of a
  passage that many distinct texts hold without the rest of it. A document that
  holds most of a passage never makes its words a formula, so an item may leak
  into any number of documents, and copies of a text count once.

The test set is the stated query set: it is sent to the executors in blocks of
bounded size, one block after the other; the corpus is never shuffled, only
verified stretches are.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.unify import plain_form
from folioscope.session import cut, spread

WORDS, PIECE, ERRORS = 20, 3, 5
#: Most edits of a stretch, as a share of its characters.
EDITS = 0.25
#: Least words, from the first to the last that stand unaltered or misread, that a document must hold of an item outside formulas.
LEAST_WORDS = 20
#: Words of a passage are a formula if so many distinct texts, and this share of all documents, hold them without most of the passage.
FORMULA_LEAST, FORMULA_SHARE = 20, 0.005
#: Test items that are sent to the executors at once.
BLOCK = 5000

_BROKEN = re.compile("[-­‐‑¬][ \t ]*\r?\n\\s*")
_WORD = re.compile(r"\w+")
_MARKS = re.compile("[̀-ͯ]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def _folded(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFD", plain_form(text) or "")
        text = _MARKS.sub("", text)
    return text.casefold()


def _byte_table() -> tuple[bytes, re.Pattern[bytes]]:
    """For texts of Latin letters: each byte's folded letter, a space for what belongs to no word; and the bytes that don't fold to one byte."""
    out, odd = bytearray(256), bytearray()
    for i in range(256):
        f = _folded(chr(i))
        if len(f) == 1 and _WORD.fullmatch(f):
            try:
                out[i] = f.encode("latin-1")[0]
                continue
            except UnicodeEncodeError:
                pass
        out[i] = 32
        if _WORD.search(f) or not f:
            odd.append(i)
    return bytes(out), re.compile(b"[" + re.escape(bytes(odd)) + b"]")


_BYTES, _ODD = _byte_table()


def words_of(text: str | None) -> list[str]:
    """Folded words: broken words joined, case, accents and look-alikes removed."""
    if not text:
        return []
    text = _BROKEN.sub("", text)
    try:
        raw = text.encode("latin-1")
        if not _ODD.search(raw):
            return raw.translate(_BYTES).decode("latin-1").split()
    except UnicodeEncodeError:
        pass
    return _WORD.findall(_folded(text))


def myers(pattern: str, text: str, most: int) -> int:
    """Least number of edits of ``pattern`` to any part of ``text``; ``most + 1`` if more than ``most``."""
    m = len(pattern)
    if not m:
        return 0
    equal: dict[str, int] = {}
    for i, c in enumerate(pattern):
        equal[c] = equal.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    up, down, score, best = full, 0, m, m
    for c in text:
        x = equal.get(c, 0)
        v = x | down
        h = (((x & up) + up) ^ up) | x
        plus = down | ~(h | up) & full
        minus = up & h
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best = score
                if not best:
                    return 0
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | ~(v | plus) & full
        down = plus & v
    return best if best <= most else most + 1


class Chain:
    """Hits (k in the document, p in the item) of one item near one diagonal, in the document's order."""

    __slots__ = ("item", "ks", "ps")

    def __init__(self, item: int, k: int, p: int):
        self.item, self.ks, self.ps = item, [k], [p]


class Items:
    """A block of test items with the table of their pieces; items are known by their place in the block."""

    def __init__(self, items: list[tuple[list[str], set[int]]]):
        """``items``: the words of each, and the places of words that belong to formulas."""
        self.words = [w for w, _ in items]
        self.pieces: dict[tuple[str, str, str], list[tuple[int, int]]] = defaultdict(list)
        for i, (w, formula) in enumerate(items):
            for k, piece in enumerate(zip(w, w[1:], w[2:])):
                if not (k in formula and k + PIECE - 1 in formula):
                    self.pieces[piece].append((i, k))
        self.pieces = {piece: (np.array([i for i, _ in at]), np.array([p for _, p in at])) for piece, at in self.pieces.items()}
        #: by item the characters before each word, spaces included
        self.chars = [[0, *accumulate(len(x) + 1 for x in w)] for w in self.words]
        #: least pieces of a stretch within the error budget, by the q-gram count
        sizes = [min(WORDS, len(w)) for w in self.words]
        self.least = [max(1, n - PIECE + 1 - PIECE * (n * ERRORS // WORDS)) for n in sizes]
        self.fewest = min(self.least, default=1)

    def chains(self, w: list[str]) -> list[Chain]:
        """Chains with enough hits for a stretch within the error budget."""
        table, least = self.pieces, self.least
        at = [(k, hit) for k, piece in enumerate(zip(w, w[1:], w[2:])) if (hit := table.get(piece)) is not None]
        if len(at) < self.fewest:
            return []
        ks = np.repeat(np.array([k for k, _ in at]), [len(hit[0]) for _, hit in at])
        items, ps = np.concatenate([hit[0] for _, hit in at]), np.concatenate([hit[1] for _, hit in at])
        # a chain's hits lie on few diagonals: those of an item with too few hits around theirs are left out first
        band = items.astype(np.int64) << 32 | (ps - ks + (1 << 20)) // (2 * ERRORS)
        bands, back, n = np.unique(band, return_inverse=True, return_counts=True)
        near = n.copy()
        beside = np.flatnonzero(np.diff(bands) == 1)
        near[beside] += n[beside + 1]
        near[beside + 1] += n[beside]
        keep = near[back] >= self.fewest
        done: list[Chain] = []
        live: dict[int, list[Chain]] = {}
        for k, item, p in zip(ks[keep].tolist(), items[keep].tolist(), ps[keep].tolist()):
            old = live.get(item)
            if old is None:
                live[item] = [Chain(item, k, p)]
                continue
            d, ended = p - k, False
            for c in old:
                gap = k - c.ks[-1]
                if gap > WORDS // 2:
                    ended = True
                elif gap and -ERRORS <= d - c.ps[-1] + c.ks[-1] <= ERRORS:
                    c.ks.append(k)
                    c.ps.append(p)
                    break
            else:
                if ended:
                    # chains that nothing can join any more
                    done += [c for c in old if k - c.ks[-1] > WORDS // 2 and len(c.ks) >= least[item]]
                    live[item] = old = [c for c in old if k - c.ks[-1] <= WORDS // 2]
                old.append(Chain(item, k, p))
        return done + [c for item, old in live.items() for c in old if len(c.ks) >= least[item]]

    def owned(self, chains: list[Chain]) -> list[Chain]:
        """Chains with those hits only at whose place no chain has more hits within half a stretch on either side."""
        most: dict[int, int] = {}
        supports = []
        for c in chains:
            ks, lo, hi, support = c.ks, 0, 0, []
            for k in ks:
                while ks[lo] < k - WORDS // 2:
                    lo += 1
                while hi < len(ks) and ks[hi] <= k + WORDS // 2:
                    hi += 1
                support.append(hi - lo)
                if hi - lo > most.get(k, 0):
                    most[k] = hi - lo
            supports.append(support)
        out = []
        for c, support in zip(chains, supports):
            own = [i for i, (k, n) in enumerate(zip(c.ks, support)) if n == most[k]]
            if len(own) >= self.least[c.item]:
                c.ks, c.ps = [c.ks[i] for i in own], [c.ps[i] for i in own]
                out.append(c)
        return out

    def held(self, text: str | None) -> dict[int, set[int]]:
        """By item the places of its words that verified stretches hold, from their first to their last unaltered or misread word."""
        w = words_of(text)
        out: dict[int, set[int]] = defaultdict(set)
        chains = self.owned(self.chains(w))
        # the item that each word of the document belongs to, -1 if several
        owner: dict[int, int] = {}
        for c in chains:
            for k in c.ks:
                for j in range(k, k + PIECE):
                    owner[j] = c.item if owner.get(j, c.item) == c.item else -1
        for c in chains:
            if at := self.verified(w, c, owner):
                out[c.item] |= at
        return out

    def most_edits(self, item: int, s: int, size: int, pairs: list[tuple[int, int]], w: list[str]) -> int:
        """A bound of a stretch's distance: all characters between unaltered pieces; often small enough without a table."""
        chars = self.chars[item]
        p, k = pairs[0]
        edits = chars[p] - chars[s]
        for q, j in pairs[1:]:
            if q - p != j - k or q - p > PIECE:
                if j < k:
                    return 1 << 30
                # from the first word that the piece before doesn't hold to this piece
                edits += max(chars[q] - chars[min(q, p + PIECE)], sum(len(x) + 1 for x in w[min(j, k + PIECE) : j])) + (abs((q - p) - (j - k)) * 20 if min(q - p, j - k) < PIECE else 0)
            p, k = q, j
        return edits + chars[s + size] - chars[p + PIECE]

    def verified(self, w: list[str], c: Chain, owner: dict[int, int]) -> set[int]:
        own = self.words[c.item]
        size = min(WORDS, len(own))
        least = self.least[c.item]
        out: set[int] = set()
        pairs = sorted(zip(c.ps, c.ks))
        ps = [p for p, _ in pairs]
        for s in range(max(0, ps[0] - size + PIECE), min(len(own) - size, ps[-1]) + 1):
            a, z = bisect_left(ps, s), bisect_left(ps, s + size - PIECE + 1)
            if z - a < least:
                continue
            if self.most_edits(c.item, s, size, pairs[a:z], w) > int(EDITS * (self.chars[c.item][s + size] - self.chars[c.item][s] - 1)):
                diagonals = [k - p for p, k in pairs[a:z]]
                pattern = " ".join(own[s : s + size])
                part = w[max(0, s + min(diagonals) - 2) : s + size + max(diagonals) + 2]
                most = int(EDITS * len(pattern))
                if myers(pattern, " ".join(part), most) > most:
                    continue
            before = _extent(own[s : ps[a]][::-1], [w[j] if owner.get(j, c.item) == c.item else "" for j in range(pairs[a][1] - 1, max(-1, pairs[a][1] - 1 - size), -1)])
            p, k = ps[z - 1] + PIECE, pairs[z - 1][1] + PIECE
            out.update(range(ps[a] - before, p + _extent(own[p : s + size], [w[j] if owner.get(j, c.item) == c.item else "" for j in range(k, min(len(w), k + size))])))
        return out


def _alike(a: str, b: str) -> bool:
    """Whether two words are the same but for some misread characters."""
    return a == b or abs(len(a) - len(b)) <= 2 and len(a) > 3 and myers(a, b, len(a) // 3) <= len(a) // 3


def _extent(own: list[str], w: list[str]) -> int:
    """How many words go on beside an unaltered piece: equal or misread ones, and a single other one before an equal one; an empty word belongs to another item."""
    n = 0
    while n < min(len(own), len(w)):
        if _alike(own[n], w[n]):
            n += 1
        elif w[n] and n + 1 < min(len(own), len(w)) and own[n + 1] == w[n + 1]:
            n += 2
        else:
            break
    return n


def _prepared(items: DataFrame) -> DataFrame:
    """(item_id, variant, words, formula, n): each distinct passage with the places of its sentences that other passages hold too (none for passages of which most stands elsewhere), and a running number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for item, variant, passage in zip(b["item_id"], b["variant"], b["passage"]):
                at = 0
                for s in _SENTENCE.split(passage):
                    ws = words_of(s)
                    rows.append((item, variant, at, ws))
                    at += len(ws)
            yield pd.DataFrame(rows, columns=["item_id", "variant", "at", "ws"])

    rows = items.where("item_id is not null and passage is not null").select("item_id", "passage").distinct().withColumn("variant", F.xxhash64("passage"))
    sentences = rows.mapInPandas(run, "item_id int, variant bigint, at int, ws array<string>").where("size(ws) > 0")
    said = sentences.withColumn("key", F.xxhash64("ws"))
    shared = said.groupBy("key").agg(F.count_distinct("item_id").alias("holders"))
    said = said.join(shared, "key").withColumn("own", F.when(F.col("holders") > 1, F.sequence("at", F.col("at") + F.size("ws") - 1)).otherwise(F.array().cast("array<int>")))
    whole = said.groupBy("item_id", "variant").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "ws"))), lambda x: x["ws"])).alias("words"), F.flatten(F.collect_list("own")).alias("formula"),
    )
    return whole.withColumn("formula", F.when(2 * F.size("formula") < F.size("words"), F.col("formula")).otherwise(F.array().cast("array<int>")))


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, words): each document with each item of which it holds enough outside formulas, and how many words.

    Null and empty texts and passages, and passages of fewer than ``PIECE``
    words, match nothing; repeated rows count once; of an item with several
    passages each counts. Extra columns are ignored.
    """
    spark = documents.sparkSession
    ready = cut(_prepared(items))
    n_blocks = -(-ready.count() // BLOCK)
    texts = spread(documents.select("doc_id", "text", F.xxhash64("text").alias("text_key")).where("doc_id is not null and length(text) > 0"))
    found = None
    for i in range(n_blocks):
        block = ready.where(F.pmod(F.xxhash64("item_id", "variant"), F.lit(n_blocks)) == i).collect()
        shared = spark.sparkContext.broadcast([(r.item_id, r.variant, list(r.words), set(r.formula)) for r in block])

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            known = shared.value
            table = Items([(w, f) for _, _, w, f in known])
            for b in batches:
                out = []
                for doc_id, text, text_key in zip(b["doc_id"], b["text"], b["text_key"]):
                    for item, at in table.held(text).items():
                        item_id, variant, ws, _ = known[item]
                        out.append((doc_id, text_key, item_id, variant, sorted(at), 2 * len(at) >= len(ws), min(LEAST_WORDS, len(ws))))
                yield pd.DataFrame(out, columns=["doc_id", "text_key", "item_id", "variant", "at", "most", "least"])

        # written at once, so only one block is on the driver at a time
        part = cut(texts.mapInPandas(run, "doc_id bigint, text_key bigint, item_id int, variant bigint, at array<int>, most boolean, least int"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "doc_id bigint, item_id int, words int")
    total = documents.count()
    least = max(FORMULA_LEAST, FORMULA_SHARE * total)
    # one row for each distinct text and item, so that copies of a text are no formula
    once = found.select("text_key", "item_id", "variant", "most", "at").dropDuplicates(["text_key", "item_id", "variant"])
    counted = once.select("item_id", "variant", "most", F.explode("at").alias("x")).groupBy("item_id", "variant", "x").agg(F.count_if(~F.col("most")).alias("alone"), F.count("*").alias("n"))
    formula = counted.where((F.col("alone") >= least) & (2 * F.col("alone") > F.col("n"))).groupBy("item_id", "variant").agg(F.collect_list("x").alias("formula"))
    own = found.join(formula, ["item_id", "variant"], "left").withColumn("own", F.array_except("at", F.coalesce("formula", F.array().cast("array<int>"))))
    longest = "aggregate(array_sort(own), (-9, 0, 0), (s, x) -> (x, if(x = s.col1 + 1, s.col2 + 1, 1), greatest(s.col3, if(x = s.col1 + 1, s.col2 + 1, 1))), s -> s.col3)"
    return own.where(F.expr(longest) >= F.col("least")).groupBy("doc_id", "item_id").agg(F.max(F.size("own")).alias("words"))


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(documents, items).select("doc_id", "item_id")


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Each test item that leaked, with the number of documents it is in."""
    n = leaks(documents, items).groupBy("item_id").agg(F.count("*").alias("n_documents"))
    return items.select("item_id", "suite").distinct().join(n, "item_id")
