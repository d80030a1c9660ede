"""Problem 1: noise of scanned pages, found by line and repaired into paragraphs.

One pass over the pages counts words, edge lines by file, and words with a
hyphen of their own. Three boosted models then work on these counts:

* words: correction candidates of a word with digits or signs in it come from
  an inverted join over character q-grams (each word posts its rarest q-grams,
  as many as the edits can spoil and one more, so no word within one edit, or
  two of a word of ``LONG`` letters, is lost, whatever was misread as what), and
  those of every word from a join over a spelling in which all that scanning is
  known to confuse is equal (so no word is lost, however many such confusions
  there are). Other letters alone, as in names and inflections, are no
  misreading that can be told. A boosted
  ranker over how scanning confuses letters and how much more frequent the
  candidate is chooses the replacement. It is trained on frequent words that
  were spoilt artificially and on pairs of real words that are close.
* furniture: a boosted classifier over pairs of a line and its file (on how
  many of the file's pages the line stands at an edge, in how many files, at
  which share elsewhere) tells running lines from headings. It is trained on
  large files, thinned to small ones, whose lines are clear.
* joins: a boosted classifier over a line's last piece and the next line's
  first tells a broken word from a compound's own hyphen.

Nothing is sent to the executors but the models and the words that make up at
least ``FREQUENT_SHARE`` of the corpus, so at most its inverse many; other
words are joined by shuffle. Pages get the running lines of their file by
blocks of pages, so a file with a third of all pages is spread.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.boost import Boosted
from folioscope.llm.leak import myers
from folioscope.session import cut, spread

#: A word with this share of all words is known to the executors.
FREQUENT_SHARE = 1e-5
#: Lines at either end of a page that may be furniture, and pages in a block of a file.
EDGE, BLOCK = 4, 512
#: q of the q-grams, and the letters from which on a word may be two edits from its correction, not one.
Q, LONG = 3, 8
#: Bounds of the samples that the models are trained on.
TRAIN_WORDS, TRAIN_FILES = 2000, 400
LEAST_WORD = 4

# What scanning makes of a letter.
CONFUSIONS = [
    ("a", "@"), ("o", "0"), ("ó", "6"), ("ó", "0"), ("e", "c"), ("n", "ri"), ("i", "1"), ("i", "l"), ("í", "l"), ("s", "5"), ("t", "f"), ("c", "("), ("u", "v"), ("d", "cl"), ("l", "1"),
    ("m", "rn"), ("b", "6"), ("g", "9"), ("z", "2"), ("rn", "m"), ("cl", "d"), ("ó", "@"), ("á", "@"), ("e", "6"), ("e", "@"), ("h", "b"), ("l", "i"), ("l", "|"), ("i", "|"),
]
_BY_WRONG: dict[str, list[str]] = defaultdict(list)
for _right, _wrong in CONFUSIONS:
    _BY_WRONG[_wrong].append(_right)



def _classes() -> dict[str, str]:
    """By letter or sign the first one of those that it is confused with, directly or through others."""
    first: dict[str, str] = {}
    for a, b in CONFUSIONS:
        if len(a) == len(b) == 1:
            x, y = first.setdefault(a, a), first.setdefault(b, b)
            first.update({k: x for k, v in first.items() if v == y})
    return first


_CLASS = _classes()
#: Longer confusions in classes, in the order of their use: none ends as another begins, so the result doesn't depend on the places.
_LONGER = sorted({("".join(_CLASS.get(c, c) for c in max(x, key=len)), min(x, key=len)) for x in CONFUSIONS if len(x[0]) != len(x[1])}, key=lambda x: (x[1] == "m", x))

_HYPHEN = "-­‐‑¬"
_BROKEN = re.compile(f"[{_HYPHEN}][ \t]*\n\\s*")
_MAIL = re.compile(r"\S*@\S+\.\S+|\S+\(at\)\S+|\S+_\S+")
_WORD = re.compile(r"(?:[0-9@(](?=[^\W\d_]{2}))?[^\W\d_](?:[\w@|]|\((?=\w))*")
_COMPOUND = re.compile(r"[^\W\d_]{2,}-[^\W\d_]{2,}(?!-)")
_PAGE_NO = re.compile(r"[\W_]*(?:(?:p[áa]g(?:ina)?|folio|fol|hoja|f[sj]?|p)\b[\s.:]*)?(?:n[°º.]\s*)?[\doOlIS]{0,2}\d[\doOlI]{0,5}(?:\s*(?:/|de|-)\s*[\doOlI]*\d[\doOlI]*)?[\W_]*", re.I)
# the end of a sentence (a year, an amount) or the number of a post, alone on a line
_NO_PAGE = re.compile(r"\s*(?:[\d,.+-]*\d\.|N[°ºo.]\s*\d+)\s*", re.I)
_LAST = re.compile(rf"([^\W\d_]+)[{_HYPHEN}]\s*$")
_FIRST = re.compile(r"\s*([^\W\d_]+)")


def words_of(lines: list[str]) -> list[str]:
    """Lower-case words of a page with broken words joined; addresses of mail and the like left out."""
    text = _BROKEN.sub("", "\n".join(lines))
    if "@" in text or "(at)" in text or "_" in text:
        text = _MAIL.sub(" ", text)
    return [w for w in _WORD.findall(text.lower()) if len(w) >= 2 and sum(c.isdigit() for c in w) * 2 <= len(w)]


def template(line: str) -> str:
    """An edge line without digits, signs, case and spacing."""
    return " ".join(re.findall(r"[^\W\d_]+", line.lower()))


def page_number_line(line: str) -> bool:
    return _PAGE_NO.fullmatch(line) is not None and _NO_PAGE.fullmatch(line) is None


def edges(lines: list[str]) -> list[int]:
    """Indexes of a page's first and last lines."""
    n = len(lines)
    return [*range(min(EDGE, n)), *range(max(EDGE, n - EDGE), n)]


def _clean(lines) -> list[str]:
    return [] if lines is None else ["" if x is None else x for x in lines]


def counted(pages: DataFrame) -> DataFrame:
    """(kind, a, b, n) in one pass and one shuffle of partial counts: words (w), compounds (c), edge lines of a file (e), pages of a file's blocks (p)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[tuple[str, str, str]] = Counter()
        words: Counter[str] = Counter()
        for batch in batches:
            for doc, page, lines in zip(batch["doc_id"], batch["page_number"], batch["lines"]):
                lines = _clean(lines)
                if not lines:
                    continue
                words.update(words_of(lines))
                counts.update(("c", m.lower(), "") for x in lines if "-" in x for m in _COMPOUND.findall(x))
                doc = "" if doc is None else doc
                block = 0 if page != page or page is None else int(page) // BLOCK
                counts["p", doc, str(block)] += 1
                for t in {template(lines[i]) for i in edges(lines) if not page_number_line(lines[i])}:
                    if t:
                        counts["e", doc, t] += 1
            if len(counts) + len(words) > 400_000:
                yield _frame(counts, words)
                counts, words = Counter(), Counter()
        yield _frame(counts, words)

    out = spread(pages.select("doc_id", "page_number", "lines").where("size(lines) > 0")).mapInPandas(run, "kind string, a string, b string, n bigint")
    return out.groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))


def _frame(counts: Counter, words: Counter) -> pd.DataFrame:
    rows = [(*k, n) for k, n in counts.items()] + [("w", w, "", n) for w, n in words.items()]
    return pd.DataFrame(rows, columns=["kind", "a", "b", "n"])


# ---------------------------------------------------------------- words


def explained(wrong: str, right: str, most: int) -> tuple[int, int]:
    """Least confusions that turn ``right`` into ``wrong`` and the signs among them; (99, 0) if they don't."""
    if abs(len(wrong) - len(right)) > most:
        return 99, 0
    reach = {(0, 0): (0, 0)}
    for _ in range(len(wrong) + len(right)):
        done = reach.get((len(wrong), len(right)))
        new: dict[tuple[int, int], tuple[int, int]] = {}
        for (i, j), (n, s) in reach.items():
            if i == len(wrong) or j == len(right):
                if i == len(wrong) and j == len(right):
                    new[i, j] = min((n, s), new.get((i, j), (99, 0)))
                continue
            if wrong[i] == right[j]:
                new[i + 1, j + 1] = min((n, s), new.get((i + 1, j + 1), (99, 0)))
            if n < most:
                for w in (wrong[i], wrong[i : i + 2]):
                    for r in _BY_WRONG.get(w, ()):
                        if right.startswith(r, j):
                            at = (i + len(w), j + len(r))
                            new[at] = min((n + 1, s + (not w.isalpha())), new.get(at, (99, 0)))
        if new == reach or not new:
            break
        reach = new
    done = reach.get((len(wrong), len(right)))
    return done if done is not None else (99, 0)


def grams(word: str) -> set[str]:
    # accents are lost or spoilt with their letter, so q-grams keep them
    padded = f"##{word}##"
    return {padded[i : i + Q] for i in range(len(padded) - Q + 1)}


def folded(word: Column) -> Column:
    """A spelling that is the same for a word and whatever scanning may make of it."""
    out = F.translate(word, "".join(_CLASS), "".join(_CLASS.values()))
    for longer, letter in _LONGER:
        out = F.replace(out, F.lit(longer), F.lit(letter))
    return out


def pair_features(wrong: str, n_wrong: int, right: str, n_right: int) -> list[float]:
    most = 1 + len(wrong) // 4
    steps, signs = explained(wrong, right, most)
    return [steps, signs, myers(right, wrong, 9), np.log((n_right + 1) / (n_wrong + 1)), np.log(n_right + 1), len(right), float(wrong.isalpha()), steps / len(right), abs(len(wrong) - len(right))]


def spoil(word: str, dice: np.random.Generator) -> str:
    """A word with random confusions at up to four places."""
    free = len(word)
    # from right to left, so that no letter is spoilt twice
    places = sorted({int(i) for i in dice.integers(len(word), size=int(dice.choice([1, 1, 2, 2, 3, 4])))}, reverse=True)
    for i in places:
        usable = [(r, w) for r, w in CONFUSIONS[:20] if word.startswith(r, i) and i + len(r) <= free]
        if usable:
            r, w = usable[int(dice.integers(len(usable)))]
            word = word[:i] + w + word[i + len(r) :]
            free = i
    return word


def signed(word: str, dice: np.random.Generator) -> str:
    """A word with any digits or signs in place of as many letters as may be edited."""
    for i in dice.integers(len(word), size=int(dice.integers(1, 3)) if len(word) >= LONG else 1):
        word = word[:i] + "0123456789@|"[int(dice.integers(12))] + word[i + 1 :]
    return word


def train_ranker(frequent: list[tuple[str, int]]) -> Boosted | None:
    """Ranker of corrections from the most frequent words; none without enough of them."""
    usable = [(w, n) for w, n in frequent if len(w) >= LEAST_WORD and w.isalpha()][:TRAIN_WORDS]
    if len(usable) < 20:
        return None
    dice, signs = np.random.default_rng(3), np.random.default_rng(7)
    held = dict(frequent)
    x, y = [], []
    index: dict[str, list[str]] = defaultdict(list)
    for w, _ in usable:
        for g in grams(w):
            index[g].append(w)
    for w, n in usable:
        for _ in range(3):
            wrong = spoil(w, dice)
            if wrong != w and wrong not in held:
                x.append(pair_features(wrong, max(1, int(n * 10 ** -dice.uniform(1.2, 4))), w, n))
                y.append(1)
        close = Counter(v for g in grams(w) for v in index[g] if v != w)
        for v, shared in close.most_common(3):
            # two real words, one of them rare or frequent by chance
            x.append(pair_features(w, max(1, int(n * 10 ** -dice.uniform(0, 4))), v, held[v]))
            y.append(0)
        # a word with one ordinary other letter, as names and inflections have
        i = int(dice.integers(len(w)))
        other = w[:i] + "abdegimnoprstu"[int(dice.integers(14))] + w[i + 1 :]
        if other != w and explained(other, w, 3)[0] == 99:
            x.append(pair_features(other, max(1, int(n * 10 ** -dice.uniform(1, 4))), w, n))
            y.append(0)
        # digits and signs in place of letters, and a number that stands with the word
        odd = signed(w, signs)
        if odd not in held and _WORD.fullmatch(odd) and explained(odd, w, 1 + len(w) // 4)[0] == 99:
            x.append(pair_features(odd, max(1, int(n * 10 ** -signs.uniform(1.2, 4))), w, n))
            y.append(1)
        number = str(signs.integers(1, 99))
        x.append(pair_features(w + number if signs.random() < 0.7 else number[:1] + w, max(1, int(n * 10 ** -signs.uniform(1, 4))), w, n))
        y.append(0)
    return Boosted(trees=40).fit(np.array(x), np.array(y)) if len(set(y)) == 2 else None


def corrections(words: DataFrame, ranker: Boosted | None) -> DataFrame:
    """(word, fix): words (word, n) that are another word misrecognised."""
    spark = words.sparkSession
    schema = "word string, fix string"
    if ranker is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(ranker)
    usable = words.where(F.length("word").between(LEAST_WORD, 40)).withColumn("folded", folded(F.col("word")))
    # shorter words only stand with numbers
    posted = words.where(F.length("word").between(LEAST_WORD - 1, 40)).select("word", "n", F.expr(f"explode(array_distinct(transform(sequence(1, length(word) + 2), i -> substr(concat('##', word, '##'), i, {Q}))))").alias("gram"))
    common = posted.groupBy("gram").agg(F.count("*").alias("df"))
    rank = Window.partitionBy("word").orderBy("df", "gram")
    # a word posts for the longest one that may be an edit of it
    posted = posted.join(common, "gram").withColumn("place", F.row_number().over(rank)).where(f"place <= if(length(word) >= {LONG - 2}, {2 * Q + 1}, {Q + 1})").select("gram", "word", "n")
    plain = F.col("word").rlike(r"^\p{L}+$")
    letters = (F.col("n") >= 2) & plain
    chosen = [F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("right"), F.col("b.n").alias("n_right")]
    edits = F.levenshtein(F.col("a.word"), F.col("b.word"), 2)
    frequent = (F.col("a.n") * 10 <= F.col("b.n")) & (F.length("b.word") >= LEAST_WORD)
    # the word without its number needn't be so much more frequent
    numbered = (F.col("a.n") < F.col("b.n")) & (F.regexp_replace("a.word", r"^\d+|\d+$", "") == F.col("b.word"))
    near = posted.where((F.length("word") >= LEAST_WORD) & ~plain).alias("a").join(posted.where(letters).alias("b"), (F.col("a.gram") == F.col("b.gram")) & (frequent | numbered) & (F.abs(F.length("a.word") - F.length("b.word")) <= 2))
    near = near.where(edits.between(0, F.when(F.length("a.word") >= LONG, 2).otherwise(1))).select(*chosen, F.lit(True).alias("near"))
    alike = usable.alias("a").join(usable.where(letters).alias("b"), (F.col("a.folded") == F.col("b.folded")) & frequent).select(*chosen, F.lit(False).alias("near"))
    pairs = near.unionByName(alike).groupBy("word", "n", "right", "n_right").agg(F.max("near").alias("near"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            seen = [(*k, pair_features(*k), near) for *k, near in zip(p["word"], p["n"], p["right"], p["n_right"], p["near"])]
            keep = [k for k in seen if k[5] or k[4][0] < 99]
            score = shared.value.probability(np.array([k[4] for k in keep])) if keep else []
            out = []
            for (w, n, r, m, x, _), s in zip(keep, score):
                if x[0] == 99 and w.strip("0123456789") == r:
                    # a word and its number stay as they are, if that is no known confusion of another word
                    out.append((w, w, False, 2.0, m))
                elif s >= 0.5 and m >= 10 * n and len(r) >= LEAST_WORD:
                    out.append((w, r, x[0] < 99, float(s), m))
            yield pd.DataFrame(out, columns=["word", "right", "listed", "score", "n_right"])

    ranked = pairs.mapInPandas(run, "word string, right string, listed boolean, score double, n_right bigint")
    return ranked.groupBy("word").agg(F.max_by("right", F.struct("listed", F.round("score", 1), "n_right", "right")).alias("fix")).where("fix != word")


# ------------------------------------------------------------ furniture


def line_features(t: str, n: int, pages: int, files: int, mean: float, prior: tuple[float, float]) -> list[float]:
    return [n, pages, n / max(1, pages), np.log1p(files), mean if files > 1 else -1.0, *prior, len(t), len(t.split())]


def train_furniture(rows: list[tuple[str, str, int, int, int, float]]) -> tuple[Boosted | None, dict[str, float]]:
    """From (file, line, n, pages, files, mean share elsewhere) of sampled files; also each first and last word's share of clear running lines."""
    clear = [(r, float(r[2] / r[3] >= 0.35)) for r in rows if r[3] >= 15 and not 0.2 < r[2] / r[3] < 0.35 and (r[2] / r[3] >= 0.35 or r[4] > 2 or r[2] <= 2)]
    first: dict[str, list[float]] = defaultdict(list)
    for r, y in clear:
        ws = r[1].split()
        first["^" + ws[0]].append(y)
        first["$" + ws[-1]].append(y)
    prior = {w: (sum(v) + 0.2) / (len(v) + 1) for w, v in first.items()}
    dice = np.random.default_rng(4)
    x, y = [], []
    for (_, t, n, pages, files, mean), label in clear:
        for small in (pages, int(dice.integers(1, 4)), int(dice.integers(4, 12))):
            k = int(dice.binomial(small, n / pages))
            if k:
                ws = t.split()
                x.append(line_features(t, k, small, files, mean, (prior["^" + ws[0]], prior["$" + ws[-1]])))
                y.append(label)
    return (Boosted(trees=50).fit(np.array(x), np.array(y)) if len(set(y)) == 2 else None), prior


def running_lines(counts: DataFrame) -> DataFrame:
    """(doc_id, block, running): for each block of a file's pages the templates of its running lines."""
    spark = counts.sparkSession
    blocks = counts.where("kind = 'p'").select(F.col("a").alias("doc_id"), F.col("b").cast("int").alias("block"), "n")
    pages = blocks.groupBy("doc_id").agg(F.sum("n").alias("pages"))
    lines = counts.where("kind = 'e'").select(F.col("a").alias("doc_id"), F.col("b").alias("line"), "n").join(pages, "doc_id")
    spread = lines.groupBy("line").agg(F.count("*").alias("files"), F.sum(F.col("n") / F.col("pages")).alias("shares"))
    lines = lines.join(spread, "line").select("doc_id", "line", "n", "pages", "files", ((F.col("shares") - F.col("n") / F.col("pages")) / F.greatest(F.col("files") - 1, F.lit(1))).alias("mean"))
    lines = cut(lines)
    files = lines.where("pages >= 15").select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(TRAIN_FILES)
    # of the long tail of single lines a bounded share is enough for training
    sample = lines.join(F.broadcast(files), "doc_id").withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("n"), "line"))).where("place <= 60").drop("place")
    model, prior = train_furniture([tuple(r) for r in sample.toLocalIterator()])
    shared = spark.sparkContext.broadcast((model, prior))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, prior = shared.value
        for b in batches:
            # a line that stands once in a large file is no running line, whatever else it is
            b = b[(b["n"] >= 2) | (b["pages"] <= 6)]
            share = b["n"] / b["pages"]
            if model is None:
                keep = (share >= 0.35) & (b["n"] >= 2)
            elif len(b):
                x = [line_features(t, n, p, f, m, (prior.get("^" + t.split()[0], 0.15), prior.get("$" + t.split()[-1], 0.15))) for t, n, p, f, m in zip(b["line"], b["n"], b["pages"], b["files"], b["mean"])]
                keep = model.probability(np.array(x)) >= 0.5
            else:
                keep = np.zeros(0, bool)
            yield b.loc[keep, ["doc_id", "line"]]

    chosen = lines.mapInPandas(run, "doc_id string, line string").groupBy("doc_id").agg(F.collect_set("line").alias("running"))
    return blocks.select("doc_id", "block").join(chosen, "doc_id")


# ---------------------------------------------------------------- joins


def join_features(left: str, right: str, sign: str, n_joined: int, n_compound: int, n_left: int, n_right: int) -> list[float]:
    return [np.log1p(n_joined), np.log1p(n_compound), np.log1p(n_left), np.log1p(n_right), float(sign == "-"), len(left), len(right), np.log1p(n_joined) - np.log1p(n_compound)]


def train_joins(frequent: dict[str, int], compounds: dict[str, int]) -> Boosted | None:
    """From frequent words split anywhere and compounds split at their own hyphen."""
    dice = np.random.default_rng(6)
    x, y = [], []
    for w in [w for w in frequent if len(w) >= 5 and w.isalpha()][:TRAIN_WORDS]:
        i = int(dice.integers(2, len(w) - 2))
        left, right = w[:i], w[i:]
        for sign in "-¬":
            known = dice.random() < 0.8  # a word may be too rare to be known
            x.append(join_features(left, right, sign, frequent[w] if known else 0, 0, frequent.get(left, 0), frequent.get(right, 0)))
            y.append(1)
    for c, n in list(compounds.items())[:TRAIN_WORDS]:
        left, right = c.split("-")
        x += [join_features(left, right, "-", frequent.get(left + right, 0), n, frequent.get(left, 0), frequent.get(right, 0))] * 3
        y += [0] * 3
    return Boosted(trees=30, least=2).fit(np.array(x), np.array(y)) if len(set(y)) == 2 else None


def broken(left: str, right: str, sign: str, known: dict[str, int], compounds: dict[str, int], model: Boosted | None) -> bool:
    """Whether ``left`` and ``right`` are one word that was broken."""
    if sign != "-":
        return True
    if model is None:
        return f"{left}-{right}" not in compounds
    return bool(model.probability(np.array([join_features(left, right, sign, known.get(left + right, 0), compounds.get(f"{left}-{right}", 0), known.get(left, 0), known.get(right, 0))]))[0] >= 0.5)


# ----------------------------------------------------------------- pages


class Reader:
    """What an executor knows: frequent words, frequent compounds, the join model."""

    def __init__(self, known: dict[str, int], spoilt: set[str], compounds: dict[str, int], joins: Boosted | None):
        self.known, self.compounds, self.joins = known, compounds, joins
        self.sure = {w for w in known if w not in spoilt}
        self.cache: dict[tuple[str, str, str], bool] = {}

    def furniture(self, lines: list[str], running: list[str]) -> dict[int, str]:
        out: dict[int, str] = {}
        held = set(running)
        for i in edges(lines):
            if not lines[i].strip():
                continue
            if page_number_line(lines[i]):
                out[i] = "page_no"
                continue
            t = template(lines[i])
            if t in held or any(abs(len(t) - len(r)) <= 3 and len(r) >= 8 and myers(r, t, len(r) // 6) <= len(r) // 6 for r in running):
                out[i] = "running"
        return out

    def breaks(self, lines: list[str], furniture: dict[int, str]) -> dict[int, tuple[str, str]]:
        """By line index the last and next first piece of a broken word."""
        out = {}
        for i, line in enumerate(lines[:-1]):
            if i in furniture or not line or line.rstrip()[-1:] not in _HYPHEN or not line.strip() or i + 1 in furniture:
                continue
            a, b = _LAST.search(line), _FIRST.match(lines[i + 1])
            if a and b and b[1][0].islower() or a and b and a[1].isupper() and b[1].isupper():
                key = (a[1].lower(), b[1].lower(), line.rstrip()[-1])
                if (hit := self.cache.get(key)) is None:
                    hit = broken(*key, self.known, self.compounds, self.joins)
                    if len(self.cache) < 200_000:
                        self.cache[key] = hit
                if hit:
                    out[i] = (a[1], b[1])
        return out

    def doubtful(self, lines: list[str], furniture: dict[int, str], breaks: dict[int, tuple[str, str]]) -> list[tuple[int, str, str, bool]]:
        """(line index, word, piece, last) of words that aren't surely right; of a broken word the piece on this line, and whether it is the last one."""
        out = []
        carried = ""
        for i, line in enumerate(lines):
            low = line.lower()
            if "@" in low or "(at)" in low or "_" in low:
                low = _MAIL.sub(" ", low)
            ws = _WORD.findall(low)
            if carried and ws:
                whole = carried + ws[0]
                if whole not in self.sure:
                    out += [(i - 1, whole, carried, False), (i, whole, ws[0], True)]
                ws = ws[1:]
            carried = ""
            if i in breaks and ws:
                carried = ws.pop()
            if i not in furniture:
                out += [(i, w, "", False) for w in ws if w not in self.sure and len(w) >= LEAST_WORD]
        return out


def _prepared(pages: DataFrame) -> tuple[DataFrame, DataFrame, Reader]:
    """Pages with the running lines of their file, corrections of words, and what executors know."""
    counts = cut(counted(pages))
    words = counts.where("kind = 'w'").select(F.col("a").alias("word"), "n")
    total = words.agg(F.sum("n")).first()[0] or 0
    known = {r.word: r.n for r in words.where(F.col("n") >= max(2, FREQUENT_SHARE * total)).toLocalIterator()}
    compounds = {r.a: r.n for r in counts.where((F.col("kind") == "c") & (F.col("n") >= max(2, FREQUENT_SHARE * total / 10))).toLocalIterator()}
    frequent = sorted(known.items(), key=lambda x: (-x[1], x[0]))
    fixes = cut(corrections(words, train_ranker(frequent)))
    spoilt = {r.word for r in fixes.join(words, "word").where(F.col("n") >= max(2, FREQUENT_SHARE * total)).select("word").toLocalIterator()}
    reader = Reader(known, spoilt, compounds, train_joins(known, compounds))
    held = spread(pages.where("size(lines) > 0").select("doc_id", "page_number", "lines")).withColumn("__doc", F.coalesce("doc_id", F.lit(""))).withColumn("__block", F.coalesce(F.expr(f"cast(floor(page_number / {BLOCK}) as int)"), F.lit(0)))
    running = running_lines(counts).select(F.col("doc_id").alias("__doc"), F.col("block").alias("__block"), "running")
    return held.join(running, ["__doc", "__block"], "left").select("doc_id", "page_number", "lines", "running"), fixes, reader


def _noise(pages: DataFrame, reader: Reader) -> DataFrame:
    """(doc_id, page_number, line_no, noise, word): noise is null for a word that has yet to be looked up."""
    shared = pages.sparkSession.sparkContext.broadcast(reader)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = shared.value
        for b in batches:
            out = []
            for doc, page, lines, running in zip(b["doc_id"], b["page_number"], b["lines"], b["running"]):
                lines = _clean(lines)
                furniture = r.furniture(lines, [] if running is None else list(running))
                breaks = r.breaks(lines, furniture)
                # a row without a word to look up gets one of its own, so that no key is hot
                out += [(doc, page, i + 1, kind, f"\0{doc}{page}{i}", "", False) for i, kind in furniture.items()]
                out += [(doc, page, i + 1, "hyphen", f"\0{doc}{page}{i}", "", False) for i in breaks]
                out += [(doc, page, i + 1, None, w, piece, last) for i, w, piece, last in set(r.doubtful(lines, furniture, breaks))]
            yield pd.DataFrame(out, columns=["doc_id", "page_number", "line_no", "noise", "word", "piece", "last"])

    return pages.mapInPandas(run, "doc_id string, page_number int, line_no int, noise string, word string, piece string, last boolean")


def found(pages: DataFrame) -> DataFrame:
    """Noisy lines: running, page_no, hyphen and misread, one row per line and kind.

    Pages without lines have no rows; null lines count as empty ones.
    """
    held, fixes, reader = _prepared(pages)
    rows = _noise(held, reader).join(fixes, "word", "left")
    rows = rows.where("noise is not null or fix is not null")
    # of a broken word only the spoilt piece's line is noisy
    rows = rows.where("noise is not null or not (last and endswith(fix, piece) or not last and length(piece) > 0 and startswith(fix, piece))")
    return rows.select("doc_id", "page_number", "line_no", F.coalesce("noise", F.lit("misread")).alias("noise")).distinct()


def repair(lines: list[str], furniture: dict[int, str], breaks: dict[int, tuple[str, str]], fixes: dict[str, str]) -> str:
    """Continuous paragraphs: furniture removed, broken words joined, misread words replaced.

    A paragraph ends after a line that is clearly shorter than the page's width
    and ends a sentence, before an indented line, and at headings.
    """
    body = [(i, x) for i, x in enumerate(lines) if i not in furniture and x.strip()]
    if not body:
        return ""
    width = sorted(len(x) for _, x in body)[int(0.8 * (len(body) - 1))]
    out: list[str] = []
    open_word = False
    for (i, x), before in zip(body, [None, *body]):
        piece = x.strip()
        new = before is None or x[:2].isspace() or len(before[1]) < 0.7 * width and (before[1].rstrip()[-1:] in ".:;!?" or before[1].isupper() or x.isupper())
        if out and open_word:
            out[-1] += piece
        elif not out or new:
            out.append(piece)
        else:
            out[-1] += " " + piece
        open_word = i in breaks
        if open_word:
            out[-1] = out[-1].rstrip().rstrip(_HYPHEN)

    def replaced(m: re.Match) -> str:
        fix = fixes.get(m[0].lower())
        return m[0] if fix is None else fix.upper() if m[0].isupper() and len(m[0]) > 1 else fix[0].upper() + fix[1:] if m[0][0].isupper() else fix

    return "\n\n".join(_WORD.sub(replaced, p) for p in out) if fixes else "\n\n".join(out)


def repaired(pages: DataFrame) -> DataFrame:
    """(doc_id, page_number, text): each page's lines as continuous paragraphs; repeated deliveries once, pages without lines empty."""
    held, fixes, reader = _prepared(pages)
    shared = pages.sparkSession.sparkContext.broadcast(reader)
    keyed = held.dropDuplicates(["doc_id", "page_number", "lines"])
    per_page = _noise(keyed, reader).where("noise is null").select("doc_id", "page_number", "word").distinct().join(fixes, "word").groupBy("doc_id", "page_number").agg(F.collect_list(F.struct("word", "fix")).alias("fixes"))
    d = per_page.select(F.col("doc_id").alias("__d"), F.col("page_number").alias("__p"), "fixes")
    joined = keyed.join(d, keyed["doc_id"].eqNullSafe(F.col("__d")) & keyed["page_number"].eqNullSafe(F.col("__p")), "left").select("doc_id", "page_number", "lines", "running", "fixes")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = shared.value
        for b in batches:
            texts = []
            for lines, running, fix in zip(b["lines"], b["running"], b["fixes"]):
                lines = _clean(lines)
                furniture = r.furniture(lines, [] if running is None else list(running))
                texts.append(repair(lines, furniture, r.breaks(lines, furniture), {} if fix is None else {f["word"]: f["fix"] for f in fix}))
            yield pd.DataFrame({"doc_id": b["doc_id"], "page_number": b["page_number"], "text": texts})

    whole = joined.mapInPandas(run, "doc_id string, page_number int, text string")
    empty = pages.where("coalesce(size(lines), 0) <= 0").select("doc_id", "page_number", F.lit("").alias("text")).distinct()
    return whole.unionByName(empty)
