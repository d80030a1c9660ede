"""Similarity of roles: token-sorted indel similarity with a bit-parallel longest common subsequence, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence; one integer holds a row of the table."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & at.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - bin(row).count("1")


def token_sorted(text: str) -> str:
    return " ".join(sorted(text.lower().split()))


def ratio(a: str, b: str) -> float:
    """200 * common / total length of sorted strings; two empty ones are equal."""
    total = len(a) + len(b)
    return 200.0 * common_subsequence(a, b) / total if total else 100.0


@lru_cache(maxsize=8)
def _sorted_roles(roles: tuple[str, ...]) -> tuple[tuple[str, str], ...]:
    return tuple((r, token_sorted(r)) for r in roles)


@lru_cache(maxsize=50_000)
def best_role(candidate: str, roles: tuple[str, ...], least: float) -> str | None:
    """The most similar role of at least ``least``, the first of equals. Lengths alone rule out most."""
    text = token_sorted(candidate)
    best, found = least - 1e-9, None
    for role, sorted_role in _sorted_roles(roles):
        # the common part is at most the shorter one
        if 200.0 * min(len(text), len(sorted_role)) < best * (len(text) + len(sorted_role)):
            continue
        score = ratio(text, sorted_role)
        if score > best and (found is None or score > best + 1e-12):
            best, found = score, role
    return found


def with_first_role(df: DataFrame, candidates: str, name: str, roles: Sequence[str], least: float) -> DataFrame:
    """``df`` with an array of candidates in order of priority replaced by the role of the first that is similar enough to any; null if none is."""
    fixed = tuple(roles)
    schema = T.StructType([f for f in df.schema.fields if f.name not in (candidates, name)] + [T.StructField(name, T.StringType())])

    def one(items) -> str | None:
        for c in items if items is not None else ():
            # long texts hardly come twice
            if c is not None and (role := (best_role if len(c) < 500 else best_role.__wrapped__)(c, fixed, least)) is not None:
                return role
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = pd.Series([one(x) for x in b[candidates]], index=b.index, dtype=object)
            yield b.drop(columns=[candidates]).assign(**{name: found})[schema.names]

    return df.mapInPandas(run, schema)
