"""Problem 9: abusive, hateful or sexual content by multiple-instance learning.

Labels belong to documents, offence to sentences. A sentence's score is a
logistic model over hashed features of its unmasked words; a document's score
combines those of its sentences by noisy-or, 1 - prod(1 - p). The model is
trained on the document labels through that combination, so it learns by
itself which sentences made the document offensive, and later points them out.
One such model is trained for each of the labels.

Training takes a bounded sample of labelled documents on the driver
(``MOST_LABELLED`` and ``MOST_CHARS``, drawn by hash when there are more);
scoring is a map over all whole documents.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.unify import plain_form
from folioscope.session import spread

#: Bounds of the training sample: documents, and characters of their texts.
MOST_LABELLED, MOST_CHARS = 20_000, 100_000_000
#: Shorter sentences are read together with the one before, or the next one.
LEAST_WORDS = 3
#: Offensive documents of the sample that a feature must occur in.
SUPPORT = 2
#: A document is offensive from this score on.
LEAST_SCORE = 0.5
CLEAN = "limpio"

_SENTENCE = re.compile(r"(?<=[.!?…])[\"')\]]*\s+(?=[^\s\d])|\n\s*\n|(?<=[.!?]{3})|(?<=[.!?])\n")
_SPACED = re.compile(r"(?<![^\W\d_])(?:[^\W\d_] ){2,}[^\W\d_](?![^\W\d_])")
# Signs written for letters.
_LETTERS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"})
# a capitalised word within a sentence: names of persons, places and firms are all one word
_NAME = re.compile(r"(?<=[^\s.!?¿¡:\"(]\s)(?:[^\W\d_a-zñáéíóúü][\w]*[a-zñáéíóúü]\w*|(?:[A-Z]\.){2,}|[A-Z]\.)")
_RUN = re.compile(r"([^\W\d_])\1+")
_WORDS = re.compile(r"[^\W_]+")
_BROKEN = re.compile("[-­‐‑¬][ \t]*\r?\n\\s*")


def sentences(text: str | None) -> list[str]:
    """Sentences of a whole text; lines that were wrapped are joined first, and short sentences to their neighbour."""
    if not text or not text.strip():
        return []
    text = _BROKEN.sub("", plain_form(text.replace("\r\n", "\n").replace("\r", "\n")) or "")
    out: list[str] = []
    short = False
    for s in (x.strip() for x in _SENTENCE.split(text)):
        if s:
            few = len(_WORDS.findall(s)) < LEAST_WORDS
            if out and (few or short):
                out[-1] += " " + s
            else:
                out.append(s)
            # the first ones may still be too short together
            short = few and len(out) == 1 and len(_WORDS.findall(out[0])) < LEAST_WORDS
    return out


def words(sentence: str) -> list[str]:
    """Folded words with spaced-out letters joined and signs in words read as letters; a masked letter stays ``*``."""
    sentence = _SPACED.sub(lambda m: m[0].replace(" ", ""), sentence)
    sentence = _NAME.sub("N", sentence)
    sentence = unicodedata.normalize("NFD", sentence.casefold())
    sentence = "".join(c for c in sentence if not unicodedata.combining(c))
    out = []
    for w in re.findall(r"[\w*@$|]+", sentence):
        if not w.isalpha() and any(c.isalpha() for c in w):
            w = w.translate(_LETTERS)
        # letters may be drawn out; every run of a letter becomes one letter, in all texts alike
        out.append("0" if w.isdigit() else _RUN.sub(r"\1", w))
    return out


def unmask(word: str, known: dict[int, dict[str, float]]) -> str:
    """A word with starred letters as the strongest known word of that length that fits, or as it is."""
    fits = [(w, x) for w, x in known.get(len(word), {}).items() if all(a in ("*", b) for a, b in zip(word, w))]
    return max(fits, key=lambda f: (f[1], f[0]))[0] if fits else word


@lru_cache(maxsize=200_000)
def _word_features(w: str) -> frozenset[int]:
    names = [f"w{w}"]
    if len(w) > 3 and w != "0":
        names += [f"c{x[i : i + 4]}" for x in (f" {w} ",) for i in range(len(x) - 3)]
    return frozenset(zlib.crc32(n.encode()) for n in names)


def features(ws: Sequence[str]) -> set[int]:
    """Hashed words, pairs of words and pieces of four letters, each once."""
    return {zlib.crc32(f"p{a} {b}".encode()) for a, b in zip(ws, ws[1:])}.union(*map(_word_features, set(ws)))


class Model:
    """Noisy-or over logistic sentence scores, one set of weights for each label."""

    def __init__(self, labels: Sequence[str], index: dict[int, int], weights: np.ndarray, bias: np.ndarray, known: dict[int, dict[str, float]]):
        self.labels, self.index, self.weights, self.bias, self.known = list(labels), index, weights, bias, known
        self.cache: dict[str, np.ndarray] = {}

    @classmethod
    def train(cls, texts: Sequence[str], targets: np.ndarray, labels: Sequence[str], steps: int = 400, rate: float = 0.05, decay: float = 2e-3) -> Model:
        """``targets``: for each text and label the share of raters that gave it.

        Only features that occur in ``SUPPORT`` offensive documents get a
        weight, so the names and places of a single one are not learnt.
        """
        bags: list[list[int]] = []
        distinct: dict[tuple[str, ...], int] = {}
        for t in texts:
            bags.append(sorted({distinct.setdefault(ws, len(distinct)) for s in sentences(t) if (ws := tuple(words(s)))}))
        sets = [features(ws) for ws in distinct]
        support: Counter[int] = Counter()
        word_support: Counter[str] = Counter()
        tuples = list(distinct)
        for i, bag in enumerate(bags):
            if targets[i].max() > 0:
                support.update(set().union(*(sets[s] for s in bag)) if bag else ())
                word_support.update({w for s in bag for w in tuples[s]})
        index = {f: j for j, f in enumerate(sorted(f for f, n in support.items() if n >= SUPPORT))}
        k, n = len(labels), len(sets)
        columns = [np.array([index[f] for f in x if f in index], np.int64) for x in sets]
        sizes = np.array([len(c) for c in columns])
        cols, rows = (np.concatenate(columns) if n else np.empty(0, np.int64)), np.repeat(np.arange(n), sizes.astype(np.int64))
        scale = 1 / np.sqrt(np.maximum(1, [len(x) for x in sets])) if n else np.empty(0)
        docs = np.repeat(np.arange(len(bags)), np.array([len(b) for b in bags], np.int64))
        member = np.concatenate([np.array(b, np.int64) for b in bags]) if docs.size else np.empty(0, np.int64)
        positive = targets.max(axis=1) > 0 if len(bags) else np.zeros(0, bool)
        weight = np.where(positive, max(1.0, (~positive).sum() / max(1, positive.sum())) ** 0.5, 1.0)[:, None]
        w, bias = np.zeros((len(index), k)), np.full(k, -4.0)
        m, v = np.zeros_like(w), np.zeros_like(w)
        gather = lambda values, at, size: np.stack([np.bincount(at, values[:, j], size) for j in range(k)], axis=1)
        for step in range(1, steps + 1 if index else 0):
            z = gather(w[cols], rows, n) * scale[:, None] + bias
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            none = gather(np.log1p(-np.minimum(p, 1 - 1e-9))[member], docs, len(bags))
            doc = np.clip(1 - np.exp(none), 1e-6, 1 - 1e-6)
            # slope of the log-likelihood by each sentence's logit
            slope = gather((weight * (targets - doc) / doc)[docs] * p[member], member, n)
            g = gather((slope * scale[:, None])[rows], cols, len(index)) - decay * len(bags) / 100 * w
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        known: dict[int, dict[str, float]] = {}
        for word, count in word_support.items():
            if count >= SUPPORT and (j := index.get(zlib.crc32(f"w{word}".encode()))) is not None and "*" not in word and len(word) > 2:
                known.setdefault(len(word), {})[word] = float(w[j].max())
        return cls(labels, index, w.astype(np.float32), bias, known)

    def sentence(self, sentence: str) -> np.ndarray:
        """Probability of each label."""
        ws = words(sentence)
        key = " ".join(ws)
        if (p := self.cache.get(key)) is None:
            if not ws:
                return np.zeros(len(self.labels))
            ws = [unmask(x, self.known) if "*" in x else x for x in ws]
            x = features(ws)
            at = np.array(sorted(self.index[f] for f in self.index.keys() & x), np.int64)
            z = self.weights[at].sum(axis=0) / np.sqrt(max(1, len(x))) + self.bias
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            if len(self.cache) < 100_000 and len(key) < 400:
                self.cache[key] = p
        return p

    def score(self, text: str | None) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The document's score for each label, each sentence's, and the sentences."""
        parts = sentences(text)
        if not parts:
            return np.zeros(len(self.labels)), np.zeros((0, len(self.labels))), []
        p = np.array([self.sentence(s) for s in parts])
        return 1 - np.prod(1 - p, axis=0), p, parts


def fit(documents: DataFrame, labelled: DataFrame) -> Model:
    """A model from all labels of at most ``MOST_LABELLED`` documents; without any label it scores everything near zero."""
    votes = labelled.where("doc_id is not null and label is not null").select("doc_id", "rater", "label").distinct().groupBy("doc_id").agg(F.collect_list("label").alias("labels"))
    # the ids are chosen first, so that only the sample's texts leave their place
    sample = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED)
    texts = documents.select("doc_id", "text").where("length(text) > 0").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
    rows, chars = [], 0
    for r in texts.orderBy(F.xxhash64("doc_id"), "doc_id").toLocalIterator():
        chars += len(r.text)
        if chars > MOST_CHARS:
            break
        rows.append(r)
    labels = sorted({x for r in rows for x in r.labels} - {CLEAN}) or ["abuso"]
    targets = np.array([[r.labels.count(x) / len(r.labels) for x in labels] for r in rows]).reshape(len(rows), len(labels))
    return Model.train([r.text for r in rows], targets, labels)


def scores(documents: DataFrame, labelled: DataFrame) -> DataFrame:
    """doc_id, source, score (noisy-or over sentences and labels), label, n_offending and the worst sentence of every document.

    Null, empty and blank texts score 0. Rows stay one for one.
    """
    model = documents.sparkSession.sparkContext.broadcast(fit(documents, labelled))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for b in batches:
            out = []
            for text in b["text"]:
                doc, each, parts = m.score(text)
                worst = each.max(axis=1) if parts else np.zeros(0)
                score = float(doc.max())
                out.append((score, m.labels[int(doc.argmax())] if score >= LEAST_SCORE else CLEAN, int((worst >= LEAST_SCORE).sum()), parts[int(worst.argmax())] if parts and score >= LEAST_SCORE else None))
            columns = list(zip(*out)) or [[], [], [], []]
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "score": columns[0], "label": columns[1], "n_offending": columns[2], "sentence": columns[3]})

    return spread(documents.select("doc_id", "source", "text")).mapInPandas(run, "doc_id bigint, source string, score double, label string, n_offending int, sentence string")


def found(documents: DataFrame, labelled: DataFrame) -> DataFrame:
    return scores(documents, labelled).where(F.col("score") >= LEAST_SCORE).select("doc_id").distinct()


def rates(documents: DataFrame, labelled: DataFrame) -> DataFrame:
    """For each source the documents, the offensive ones, their share and the mean score."""
    s = scores(documents, labelled).groupBy("source").agg(F.count("*").alias("n_documents"), F.count_if(F.col("score") >= LEAST_SCORE).alias("n_offensive"), F.round(F.avg("score"), 4).alias("mean_score"))
    return s.withColumn("share", F.round(F.col("n_offensive") / F.col("n_documents"), 6))
