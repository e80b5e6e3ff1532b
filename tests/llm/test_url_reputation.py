from __future__ import annotations

import duckdb
import pytest

from ledgerlake.llm import url_reputation as u
from ledgerlake.llm.queries import QUERIES

CASES = {
    None: ("", "", None), "no scheme": ("", "", None), "": ("", "", None), "http://A.NET": ("a.net", "", None), "http://A.net/x?y#z": ("a.net", "/x", "net/"),
    "x://sub.example.net/en/1": ("sub.example.net", "/en/1", "example.net/en/"), "x://notexample.net/en/": ("notexample.net", "/en/", "net/"), "x://example.com/de/#/": ("example.com", "/de/", "example.com/de/"),
    "x://example.com/de": ("example.com", "/de", None), "x://a.org/fr/": ("a.org", "/fr/", "org/fr/"), "x://org/fr/2": ("org", "/fr/2", "org/fr/"), "a://b://c.net/": ("b:", "//c.net/", None), "://x.org?/fr/": ("x.org", "", None),
    "http://É.NET/\n/a": ("É.net", "/\n/a", "net/"),
}


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, x, 1) for i, x in enumerate(CASES)], "page_id long, url string, host int")
    got = {r.page_id: r for r in u.judge_urls(pages, spark.createDataFrame([], "page_id long, bad boolean")).collect()}
    for i, (url, want) in enumerate(CASES.items()):
        assert (got[i].host, got[i].path, got[i].rule) == want, url
        assert got[i].verdict == (u.RULES[want[2]] if want[2] else "allow")


def test_reputation_shrinks_and_blocks(spark):
    urls = [f"http://bad.one.com/{i}" for i in range(30)] + [f"http://good{i % 9}.two.com/{i}" for i in range(90)] + ["http://once.three.com/"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, None)], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, i < 30 or i == 120) for i in range(121)] + [(5, None), (None, True)], "page_id long, bad boolean")
    got = {r.page_id: r for r in u.judge_urls(pages, outcomes).collect()}
    assert len(got) == 122
    assert all(got[i].verdict == "block" for i in range(30))
    assert all(got[i].verdict == "allow" for i in range(30, 120))
    assert got[120].verdict == "allow"  # one bad page proves little


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert u.judge_urls(pages, spark.createDataFrame([], "page_id long, bad boolean")).count() == 0


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_matches_sql(spark, sf):
    d = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    want = sorted(con.sql(u.ORACLE).fetchall(), key=str)
    got = QUERIES["op7_url_reputation"](spark, d)
    assert [c[0] for c in con.sql(u.ORACLE).description] == got.columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
