import math

import numpy as np
import pytest

from folioscope.llm import quantiles as qu


def rank_error(values, answer, q):
    """Distance of the answer's ranks from the asked rank, relative to the nearer end."""
    v = np.sort(values)
    target = max(1, math.ceil(q * len(v)))
    lo, hi = np.searchsorted(v, answer, "left") + 1, np.searchsorted(v, answer, "right")
    off = max(0, lo - target, target - hi)
    return off / min(target, len(v) - target + 1)


@pytest.mark.parametrize("seed", range(3))
def test_relative_error_and_merging(seed):
    dice = np.random.default_rng(seed)
    parts = [dice.lognormal(0, 2, n) for n in (50_000, 3, 2000, 120_000, 0, 700)]
    merged = qu.Sketch()
    for p in parts:
        s = qu.Sketch()
        for a in range(0, len(p), 777):
            s.add(p[a : a + 777])
        merged.merge(s.pack())
        merged = (lambda t: (t.merge(merged.pack()), t)[1])(qu.Sketch())
    values = np.concatenate(parts)
    assert merged.n == len(values) and len(merged.pack()) < 120_000
    qs = [0.0001, 0.001, 0.01, 0.1, 0.5, 0.9, 0.99, 0.999, 0.9999]
    for q, a in zip(qs, merged.quantiles(qs)):
        assert rank_error(values, a, q) < 0.06, q
    assert merged.quantiles([0, 1]) == [values.min(), values.max()]


def test_small_groups_are_exact_and_ties():
    s = qu.Sketch()
    s.add(np.array([3.0, 1.0, 2.0]))
    assert s.quantiles([0.0, 0.5, 1.0]) == [1.0, 2.0, 3.0] and qu.Sketch().quantiles([0.5]) == [None]
    t = qu.Sketch()
    t.add(np.full(50_000, 0.25))
    assert t.quantiles([0.01, 0.5, 0.99]) == [0.25] * 3


def test_groups(spark):
    rows = [("d", 1, "e", "s", [0.5, None, float("nan"), 0.9], 0.7, "2025-01-01"), ("d", 1, "e", "s", [0.5, None, float("nan"), 0.9], 0.7, "2025-01-05"), ("d", 2, "e", "s", [50.0, 90.0], 70.0, "2025-01-01"), ("d", 3, "e", "s", [], None, "2025-01-01"), ("d", 4, "e", None, None, None, "2025-01-02"), ("d", 5, "e", "s", [0.0], 0.0, "2025-01-02")]
    p = spark.createDataFrame(rows, "doc_id string, page_number int, engine_used string, source string, line_scores array<double>, conf_promedio double, t string").selectExpr("*", "cast(t as timestamp) ingested_at", "1 as n")
    daily = qu.score_sketches(p)
    got = {(r.metric, str(r.day)): (r.n, r.p01, r.p50, r.p99) for r in qu.percentiles(daily, qu.KEYS, qu.SHARES).collect()}
    assert got == {("line_scores", "2025-01-01"): (4, 0.5, 0.5, 0.9), ("conf_promedio", "2025-01-01"): (2, 0.7, 0.7, 0.7), ("line_scores", "2025-01-02"): (1, 0.0, 0.0, 0.0), ("conf_promedio", "2025-01-02"): (1, 0.0, 0.0, 0.0)}
    both = qu.percentiles(qu.merge(daily, ["metric"]), ["metric"], {"p50": 0.5})
    assert {(r.metric, r.n, r.p50) for r in both.collect()} == {("line_scores", 5, 0.5), ("conf_promedio", 3, 0.7)}
    assert qu.score_sketches(p.limit(0)).count() == 0


def test_many_partitions_merge_in_two_rounds(spark):
    df = spark.range(20_000).selectExpr("id % 2 as g", "array(double(id)) as v").repartition(8)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "401")
    try:
        r = qu.percentiles(qu.merge(qu.build(df, ["g"], "v"), ["g"]), ["g"], {"p50": 0.5}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {x.g: x.n for x in r} == {0: 10_000, 1: 10_000} and all(abs(x.p50 - 10_000) < 400 for x in r)
