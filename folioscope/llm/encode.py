"""Problem 7: the corpus as token ids of a public byte-level vocabulary.

A text is split by the vocabulary's pattern; each piece's bytes are read as
Latin-1 so that an Aho-Corasick automaton over characters finds the tokens
that begin at each place. The encoding is then built from left to right from
longest tokens. A token may follow another only if the merges of the
vocabulary, applied to the two together, would give just these two; that is
memoised. Where no token may follow, the last one is shortened to the next
token that is a prefix of it, and places that lead nowhere are never entered
twice, so the time is linear in the piece and the result that of the merges.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.session import spread

#: Fixed value: the public pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pieces whose encoding a worker keeps; the memory is bounded whatever the corpus.
KEPT_PIECES = 200_000


class Encoder:
    def __init__(self, path: str, pattern: str = PATTERN):
        self.ids: dict[str, int] = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    self.ids[base64.b64decode(token).decode("latin-1")] = int(rank)
        size = max(self.ids.values()) + 1
        self.tokens = [""] * size
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.tokens[i] = token
            self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        self.split = regex.compile(pattern).findall
        self.shorter = [-1] * size
        for token, i in self.ids.items():
            for n in range(len(token) - 1, 0, -1):
                if (j := self.ids.get(token[:n])) is not None:
                    self.shorter[i] = j
                    break
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(size)]
        self.merged: dict[tuple[int, int], int] = {}
        self.fits = lru_cache(maxsize=1_000_000)(self._fits)
        # by rank: the halves of a token have lower ranks, so all that decides about them is already known
        for i in sorted(self.ids.values()):
            left = self.shorter[i]
            while left >= 0:
                right = self.ids.get(self.tokens[i][len(self.tokens[left]) :])
                if right is not None and left < i and right < i and self._fits(left, right):
                    self.parts[i] = (left, right)
                    self.merged[left, right] = i
                    break
                left = self.shorter[left]
        self.encode_piece = lru_cache(maxsize=KEPT_PIECES)(self._encode_piece)

    def _fits(self, left: int, right: int) -> bool:
        """Whether no merge joins any end of ``left`` with any start of ``right`` before both are complete."""
        bound = len(self.tokens)
        while True:
            if self.merged.get((left, right), bound) < bound:
                return False
            # take back the later of the two last merges; only earlier ones can still come before it
            first = left > right
            for take_left in (first, not first):
                if take_left:
                    inner = self.parts[left][1]
                    if inner != left:
                        bound, left = left, inner
                        break
                else:
                    inner = self.parts[right][0]
                    if inner != right:
                        bound, right = right + 1, inner
                        break
            else:
                return True

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        text = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        whole = self.ids.get(text)
        if whole is not None:
            return (whole,)
        n = len(text)
        longest = [-1] * n
        size = [0] * n
        tokens = self.tokens
        for end, i in self.automaton.iter(text):
            m = len(tokens[i])
            if m > size[end + 1 - m]:
                size[end + 1 - m], longest[end + 1 - m] = m, i
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            last = out[-1] if out else -1
            while token >= 0:
                end = at + len(tokens[token])
                if not dead[end] and (last < 0 or self.fits(last, token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                if at == n:
                    return tuple(out)
                token = longest[at]
            elif not out:
                raise ValueError("the vocabulary lacks a byte")
            else:
                dead[at] = 1
                token = out.pop()
                at -= len(tokens[token])
                token = self.shorter[token]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text without special tokens; none for an empty or null one."""
        out: list[int] = []
        for piece in self.split(text or ""):
            # a piece as long as a page (one run of signs) is not kept
            out += self.encode_piece(piece) if len(piece) < 64 else self._encode_piece(piece)
        return out


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str = PATTERN) -> Encoder:
    return Encoder(path, pattern)


def encode(documents: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` of every row: null and empty texts have an empty list, repeated rows one list each.

    A map over the rows without a shuffle. ``path`` is read by the executors
    and must exist there.
    """
    source = spread(documents.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_one = encoder(path, pattern).encode
        for b in batches:
            # many short lists: one flat column with offsets, never a Python list for the whole batch's ids
            offsets, flat = [0], []
            for t in b.column(1):
                flat.append(np.asarray(encode_one(t.as_py()), dtype=np.int32))
                offsets.append(offsets[-1] + len(flat[-1]))
            values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], names=[key, "ids"])

    return source.mapInArrow(run, f"`{key}` {source.schema['__key'].dataType.simpleString()}, ids array<int>")
