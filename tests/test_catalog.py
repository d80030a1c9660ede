"""Every query of the catalogue against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from folioscope.plans import catalog

TABLES = "/root/testdata/sf0.001"
#: No page of the tables holds the catalogue's own phrases; ``delimiters_local`` has others.
EMPTY = {"delimiters"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in Path(TABLES).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return str([plain(x) for x in v]) if isinstance(v, list | tuple) else v if v is None else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_like_sql(spark, duck, name):
    df = catalog.queries()[name](spark, TABLES)
    r = duck.execute(catalog.oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == sorted(df.columns)
    got = rows_of(df.columns, df.collect())
    assert got == rows_of(names, r.fetchall()) and (got or name in EMPTY)
