"""Problem 5: percentiles with bounded relative rank error that can be combined.

A relative-rank sketch is a stack of compactors. A compactor that is full keeps
its half next to the protected end and compacts sections from the other end
only: of neighbouring values one of two moves up a level with double weight.
Sections far from the protected end are compacted ever more often, so the rank
error is a share of the rank itself and the extreme values are exact.

A sketch here is a pair, one protecting low and one protecting high values, so
both the first and the last percentiles have multiplicative error (for section
size ``k`` and n values about sqrt(log n) / k). Groups of up to ``EXACT``
values are kept as they are and answered exactly.

Building and merging stream over partitions: a batch is sorted by group with
NumPy, partial sketches of one task are shuffled by group (in two rounds when
there are many tasks), and sorted partitions are merged group after group, so
no task ever holds a group's values.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT = 1024
SECTION = 32


class Compactors:
    """One end's relative-rank sketch; it protects the smallest values."""

    def __init__(self, k: int = SECTION, seed: int = 7):
        self.k, self.n = k, 0
        self.levels: list[np.ndarray] = [np.empty(0)]
        self.section: list[float] = [float(k)]
        self.sections: list[int] = [3]
        self.state: list[int] = [0]
        self.coin = np.random.default_rng(seed)

    def _width(self, i: int) -> int:
        return max(4, 2 * round(self.section[i] / 2))

    def _room(self, i: int) -> int:
        return 2 * self.sections[i] * self._width(i)

    def _grow(self) -> None:
        self.levels.append(np.empty(0))
        self.section.append(float(self.k))
        self.sections.append(3)
        self.state.append(0)

    def _compact(self, i: int) -> None:
        buffer = np.sort(self.levels[i])
        width = self._width(i)
        # how often the state ended in ones decides how many sections are compacted
        ones = (~self.state[i] & (self.state[i] + 1)).bit_length() - 1
        keep = max(self._room(i) // 2, self._room(i) - (ones + 1) * width)
        keep += (len(buffer) - keep) & 1
        tail = buffer[keep:]
        self.levels[i] = buffer[:keep]
        if i + 1 == len(self.levels):
            self._grow()
        self.levels[i + 1] = np.concatenate([self.levels[i + 1], tail[int(self.coin.integers(2)) :: 2]])
        self.state[i] += 1
        if self.state[i] >= 1 << (self.sections[i] - 1):
            narrow = self.section[i] / math.sqrt(2)
            if narrow >= 4:
                self.section[i], self.sections[i] = narrow, self.sections[i] * 2

    def _press(self) -> None:
        i = 0
        while i < len(self.levels):
            if len(self.levels[i]) >= self._room(i):
                self._compact(i)
            else:
                i += 1

    def add(self, values: np.ndarray) -> None:
        self.n += len(values)
        at = 0
        while at < len(values):
            take = max(1, self._room(0) - len(self.levels[0]))
            self.levels[0] = np.concatenate([self.levels[0], values[at : at + take]])
            at += take
            self._press()

    def merge(self, other: Compactors) -> None:
        self.n += other.n
        while len(self.levels) < len(other.levels):
            self._grow()
        for i, values in enumerate(other.levels):
            self.state[i] |= other.state[i]
            if other.sections[i] > self.sections[i]:
                self.section[i], self.sections[i] = other.section[i], other.sections[i]
            self.levels[i] = np.concatenate([self.levels[i], values])
        self._press()

    def weighted(self) -> tuple[np.ndarray, np.ndarray]:
        values = np.concatenate(self.levels)
        weights = np.concatenate([np.full(len(v), 1 << i, dtype=np.int64) for i, v in enumerate(self.levels)])
        order = np.argsort(values, kind="stable")
        return values[order], np.cumsum(weights[order])

    def pack(self) -> bytes:
        out = [struct.pack("<qii", self.n, self.k, len(self.levels))]
        for v, w, s, t in zip(self.levels, self.section, self.sections, self.state):
            out += [struct.pack("<dqqi", w, s, t, len(v)), np.ascontiguousarray(v, "<f8").tobytes()]
        return b"".join(out)

    @classmethod
    def unpack(cls, data: memoryview, at: int) -> tuple[Compactors, int]:
        n, k, levels = struct.unpack_from("<qii", data, at)
        at += 16
        out = cls(k, seed=n & 0xFFFF)
        out.n, out.levels, out.section, out.sections, out.state = n, [], [], [], []
        for _ in range(levels):
            w, s, t, m = struct.unpack_from("<dqqi", data, at)
            at += 28
            out.levels.append(np.frombuffer(data, "<f8", m, at))
            at += 8 * m
            out.section.append(w)
            out.sections.append(s)
            out.state.append(t)
        return out, at


class Sketch:
    """Percentiles of one group: the values themselves up to ``EXACT`` of them, then the two ends' compactors."""

    def __init__(self, k: int = SECTION):
        self.k, self.n = k, 0
        self.values: list[np.ndarray] = []
        self.ends: tuple[Compactors, Compactors] | None = None

    def add(self, values: np.ndarray) -> None:
        self.n += len(values)
        if self.ends is None:
            self.values.append(values)
            if self.n <= EXACT:
                return
            self.ends = (Compactors(self.k), Compactors(self.k, 11))
            values, self.values = np.concatenate(self.values), []
        self.ends[0].add(values)
        self.ends[1].add(-values)

    def merge(self, data: bytes) -> None:
        if len(data) % 8 == 0:
            return self.add(np.frombuffer(data, "<f8"))
        view = memoryview(data)
        low, at = Compactors.unpack(view, 0)
        high, _ = Compactors.unpack(view, at)
        if self.ends is None:
            held, self.values = self.values, []
            self.ends = (low, high)
            for v in held:
                low.add(v)
                high.add(-v)
        else:
            self.ends[0].merge(low)
            self.ends[1].merge(high)
        self.n = self.ends[0].n

    def pack(self) -> bytes:
        """Exact values as they are; else both ends and a filler that makes the length no multiple of eight."""
        if self.ends is None:
            return np.concatenate(self.values or [np.empty(0)]).astype("<f8").tobytes()
        data = self.ends[0].pack() + self.ends[1].pack()
        return data + b"\0" * (1 + (len(data) % 8 == 7))

    def quantiles(self, qs: Sequence[float]) -> list[float | None]:
        """Values whose rank is the least that covers the share; null for an empty group."""
        if not self.n:
            return [None] * len(qs)
        if self.ends is None:
            v = np.sort(np.concatenate(self.values))
            return [float(v[min(self.n - 1, max(0, math.ceil(q * self.n) - 1))]) for q in qs]
        (low, low_sum), (high, high_sum) = self.ends[0].weighted(), self.ends[1].weighted()
        out = []
        for q in qs:
            rank = max(1, math.ceil(q * self.n))
            if q <= 0.5:
                out.append(float(low[min(len(low) - 1, int(np.searchsorted(low_sum, rank)))]))
            else:
                back = self.n - rank + 1
                out.append(-float(high[min(len(high) - 1, int(np.searchsorted(high_sum, back)))]))
        return out


def _grouped(batch: pa.RecordBatch | pa.Table, n_keys: int) -> Iterator[tuple[tuple, int, int]]:
    """Runs of equal keys in a batch that is sorted by them."""
    if not batch.num_rows:
        return
    change = np.zeros(batch.num_rows, bool)
    change[0] = True
    for i in range(n_keys):
        codes = batch.column(i)
        codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
        codes = codes.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        change[1:] |= codes[1:] != codes[:-1]
    starts = np.flatnonzero(change)
    keys = [batch.column(i).take(pa.array(starts)).to_pylist() for i in range(n_keys)]
    for key, a, b in zip(zip(*keys), starts, [*starts[1:], batch.num_rows]):
        yield key, int(a), int(b)


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def build(df: DataFrame, keys: Sequence[str], values: str, k: int = SECTION) -> DataFrame:
    """Partial sketches (keys, n, sketch) of an array column of doubles, several for a group.

    Nulls, NaN and infinite values are left out; a group without any value has
    no row. Null keys are a group of their own.
    """
    source = df.select(*keys, F.expr(f"transform(filter(`{values}`, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')), x -> double(x))").alias("__values"))
    source = source.where("size(__values) > 0")
    kinds = T.StructType([*source.schema.fields[: len(keys)], T.StructField("n", T.LongType()), T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(kinds)
        held: dict[tuple, Sketch] = {}
        for b in batches:
            order = pa.compute.sort_indices(b.select(range(len(keys))), sort_keys=[(c, "ascending") for c in keys])
            b = pa.Table.from_batches([b]).take(order).combine_chunks()
            lists = b.column(len(keys)).combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for key, a, z in _grouped(b, len(keys)):
                sketch = held.get(key)
                if sketch is None:
                    sketch = held[key] = Sketch(k)
                sketch.add(flat[offsets[a] : offsets[z]].copy())
            if sum(s.n if s.ends is None else 4 * EXACT for s in held.values()) > 4_000_000:
                yield _emit([(*key, s.n, s.pack()) for key, s in held.items()], schema)
                held = {}
        if held:
            yield _emit([(*key, s.n, s.pack()) for key, s in held.items()], schema)

    return source.mapInArrow(run, kinds)


def merge(sketches: DataFrame, keys: Sequence[str], k: int = SECTION) -> DataFrame:
    """One sketch for each group of ``keys`` from partial ones, of any partitions or days.

    With many shuffle partitions a hot group is first merged in salted parts,
    so that no task reads more partial sketches of a group than the root of
    their number.
    """
    kinds = T.StructType([*[sketches.schema[c] for c in keys], T.StructField("n", T.LongType()), T.StructField("sketch", T.BinaryType())])

    def round_of(df: DataFrame, salted: bool) -> DataFrame:
        by = [*keys, "__salt"] if salted else [*keys]
        out = T.StructType([*kinds.fields[: len(keys)], *([T.StructField("__salt", T.IntegerType())] if salted else []), *kinds.fields[len(keys) :]])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = _arrow(out)
            last, sketch, done = None, None, []
            for b in batches:
                data = b.column(len(by) + 1)
                for key, a, z in _grouped(b, len(by)):
                    if sketch is None or key != last:
                        if sketch is not None:
                            done.append((*last, sketch.n, sketch.pack()))
                        last, sketch = key, Sketch(k)
                    for i in range(a, z):
                        sketch.merge(data[i].as_py())
                if len(done) > 5000:
                    yield _emit(done, schema)
                    done = []
            if sketch is not None:
                done.append((*last, sketch.n, sketch.pack()))
            if done:
                yield _emit(done, schema)

        return df.select(*by, "n", "sketch").repartition(*by).sortWithinPartitions(*by).mapInArrow(run, out)

    parts = int(sketches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fan = math.isqrt(parts) if parts > 400 else 1
    if fan > 1:
        sketches = round_of(sketches.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(fan)).cast("int")), True)
    return round_of(sketches, False)


def percentiles(sketches: DataFrame, keys: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """``keys``, ``n`` and a column for each share, of merged sketches."""
    kinds = T.StructType([*[sketches.schema[c] for c in keys], T.StructField("n", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in shares]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for data in b.column(len(keys) + 1):
                s = Sketch()
                s.merge(data.as_py())
                rows.append(s.quantiles(list(shares.values())))
            columns = list(zip(*rows)) if rows else [[] for _ in shares]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys) + 1], *[pa.array(c, pa.float64()) for c in columns]], schema=_arrow(kinds))

    return sketches.select(*keys, "n", "sketch").mapInArrow(run, kinds)


#: Names and shares of the percentiles reported by the queries.
SHARES = {"p01": 0.01, "p05": 0.05, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
KEYS = ["metric", "engine_used", "source", "day"]


def score_sketches(pages: DataFrame) -> DataFrame:
    """Merged sketches of line_scores and conf_promedio by engine, source and day of ingested_at.

    A page that was delivered again counts once, on the day of its first
    delivery. Scores of a page (or its mean) on a 0-100 scale are brought to
    0-1; zeros count; nulls and NaN don't.
    """
    first = pages.groupBy("doc_id", "page_number").agg(F.min_by(F.struct("engine_used", "source", "line_scores", "conf_promedio"), F.struct(F.col("ingested_at").isNull(), "ingested_at")).alias("r"), F.min("ingested_at").alias("at"))
    arrays = first.select(
        F.col("r.engine_used").alias("engine_used"), F.col("r.source").alias("source"), F.to_date("at").alias("day"),
        F.col("r.line_scores").alias("s"), F.array("r.conf_promedio").alias("c"),
    )
    rows = arrays.select("engine_used", "source", "day", F.explode(F.array(F.struct(F.lit("line_scores").alias("metric"), F.col("s").alias("v")), F.struct(F.lit("conf_promedio").alias("metric"), F.col("c").alias("v")))).alias("m"))
    rows = rows.select(F.col("m.metric").alias("metric"), "engine_used", "source", "day", F.col("m.v").alias("v"))
    rows = rows.withColumn("top", F.expr("array_max(filter(v, y -> y is not null and not isnan(y)))")).withColumn("v", F.when(F.col("top") > 1, F.expr("transform(v, x -> x / 100)")).otherwise(F.col("v")))
    return merge(build(rows, KEYS, "v"), KEYS)
