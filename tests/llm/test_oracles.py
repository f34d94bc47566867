"""Queries with SQL against DuckDB, over a given table and over planted and odd rows."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest

from tidewater.llm import queries

TABLES = {"op6_setsketch": "documents", "op8_url_rules": "pages"}
URLS = [None, "", "no scheme", "http://", "://x.org/a", "HTTP://WWW.Example.ORG/es/1", "http://example.org", "http://example.org?x=/es/", "http://org/", "http://notexample.org/es/", "a://b.com/de/?q#f",
    "http://xcom/fr/", "http://a-b--c.net//9/x%20?k=&=v&k=1234&k=12#", "http://a.net/\n?p\n=1#x\ny", "http://EXAMPLE.com/fr/É?ref=É", "http://a.net/x", "http://a.net/x"]
MANY = "&".join(f"p{k}=v{k}" for k in range(20))
URLS += [f"http://{h}/{p}?{MANY}" for h, p in [("a.org", "x"), ("b.com", "de/x")] * 15 + [("c.net", "y")] * 10] + [f"http://e.net/?p{k}=v{k}" for k in range(3)]


def texts() -> list[str | None]:
    """Short, empty and null texts; groups of copies, near copies and truncated ones around the threshold."""
    r = random.Random(6)
    out = [None, "", " \t\n", "one", "One", "one two", "ONE\x0btwo", "é É", "É É", "a b a b a", "b a b"]
    for _ in range(4):
        base = [f"w{r.randrange(400)}" for _ in range(r.randint(60, 140))]
        out += [" ".join(base)] * 3
        for n in range(1, 13):
            words = list(base)
            for _ in range(n):
                words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
            out += [" ".join(words), " ".join(base[: -2 * n])]
    return out


def same(spark, name: str, folder: str) -> int:
    with duckdb.connect() as c:
        c.execute(f"create view {TABLES[name]} as select * from '{folder}/{TABLES[name]}.parquet'")
        found = c.execute(queries.ORACLE_SQL[name])
        columns, want = [d[0] for d in found.description], found.fetchall()
    got = [tuple(r) for r in queries.QUERIES[name](spark, folder).select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return len(got)


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_given_tables(spark, name):
    assert same(spark, name, "/root/testdata/sf0.001") > 0


def test_planted_and_odd_rows(spark, tmp_path):
    pd.DataFrame({"doc_id": range(len(texts())), "text": texts()}).to_parquet(tmp_path / "documents.parquet")
    pd.DataFrame({"page_id": range(len(URLS)), "url": URLS, "html": ""}).to_parquet(tmp_path / "pages.parquet")
    assert same(spark, "op6_setsketch", str(tmp_path)) == len(texts())
    assert same(spark, "op8_url_rules", str(tmp_path)) == len(URLS)
