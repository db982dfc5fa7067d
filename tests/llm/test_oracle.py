"""Queries of this subpackage against their DuckDB SQL, on given and on awkward rows."""

import duckdb
import pytest

from ledgerloom.llm.oracle import ORACLES
from ledgerloom.llm.queries import QUERIES
from workload.check import oracle_connection, rows_of

SF = "/root/testdata/sf0.001"
PLAIN = " ".join(f"word{k} and" for k in range(40))
TEXTS = [None, "", " \t\n\x0b", "x " * 3_000, PLAIN, PLAIN.upper(), PLAIN.replace(" ", "## "),
         "- " + PLAIN.replace(" ", "\n- "), PLAIN.replace(" ", "...\n"), PLAIN.replace(" ", "…\n\n"),
         "same\n" * 30 + PLAIN, "12 3.4 [5] " * 9 + PLAIN, " ".join(w + " " + w for w in PLAIN.split()),
         PLAIN + "\n" + PLAIN, "é" * 900 + " " + PLAIN, ("a b c d e f g h i j k l m n o p q r s t " * 2)]
LINK = '<a class="x" href="https://bad.net/fr/">b</a>'
PAGES = [("http://WWW.Example.com/en/a?b", ""), ("https://m.example.com/en/", ""), (None, None),
         ("no scheme", LINK), ("https://bad.net/fr/1", "<A HREF='//friend.org/'>"), ("http://friend.org/x", LINK * 2),
         ("http://else.org#//x", "<a href='/y'>"), ("http://else.org#//x", ""), ("http://example.com", ""),
         ("ftp://a.com:8/p/q#f", '<a href="http://friend.org">'), ("http://far.org/", '<a href="http://friend.org">'),
         ("http://x.com/es/", '<a href=http://far.org/a>')]


def differences(spark, connection, folder, name):
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(ORACLES[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert got[0] == want[0] and len(got[1]) == len(want[1])
    return [(g, w) for g, w in zip(got[1], want[1]) if g != w]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_given_tables(spark, name):
    assert differences(spark, oracle_connection(SF), SF, name) == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_awkward_rows(spark, tmp_path, name):
    texts = [(k % 14, t, "ab"[k % 2], None) for k, t in enumerate(TEXTS)]
    texts += [(30 - k, t, None if k % 5 else "a", ("s", "t", "", None)[k % 4]) for k, t in enumerate(TEXTS[:12])]
    texts += [(40 + k, f"{PLAIN} Ünï_{k % 3}\x00rest", "a", "stu"[k % 3]) for k in range(12)]
    texts += [(None, PLAIN, "b", "s"), (None, None, "c", "only")]
    spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string").write.parquet(
        f"{tmp_path}/documents.parquet")
    labels = [(3, 1, 0), (3, 0, 1), (4, 1, None), (None, 1, 1), (41, None, 1), (99, 1, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    pages = [(k, *p) for k, p in enumerate(PAGES)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(
        f"{tmp_path}/pages.parquet")
    connection = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        connection.execute(f"create view {table} as from read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    assert differences(spark, connection, str(tmp_path), name) == []
