from collections import Counter

import duckdb
import __spark_entry__ as entry

SMALLEST = "/root/testdata/sf0.001"


def test_ngrams_of_pages_with_any_number_of_lines(spark):
    got = Counter(tuple(r) for r in entry.queries()["ngrams"](spark, SMALLEST).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SMALLEST}/pages.parquet')")
    assert got == Counter(con.execute(entry.oracle_sql()["ngrams"]).fetchall())
    large = spark.read.parquet(f"{SMALLEST}/pages.parquet").where("size(lines) > 15").select("doc_id", "page_number").distinct()
    assert 0 < large.count() == len({k[:2] for k in got} & {tuple(r) for r in large.collect()})
    few = Counter(tuple(r) for r in entry.queries()["line_ngrams"](spark, SMALLEST).collect())
    assert few == Counter(con.execute(entry.oracle_sql()["line_ngrams"]).fetchall()) and few < got
