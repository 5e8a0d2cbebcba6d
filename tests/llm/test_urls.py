import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import compare, duck  # noqa: E402

from gridpulse.llm import queries, urls  # noqa: E402

PAGES = "page_id long, url string, html string, host string, RULE string"


def pages(spark, *found):
    return spark.createDataFrame([(i, u, "", "clash", "clash") for i, u in enumerate(found)], PAGES)


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:end]


def plain(url, listed):
    host, path = plain_parts(url)
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.text))
        return host, path, best.text, best.verdict
    return host, path, None, "block" if host in listed else "allow"


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.COM/x?y#z", "http://a.com", "http://www.example.com/en/1", "http://example.com/en/",
    "http://b.example.com/en", "https://xexample.com/en/1", "http://n.net/es/1#a", "http://net/fr/", "http://n.net/it/", "//x.org/",
    "x://É.ORG?/a/://b", "a\nb://c.org/d\ne?f", "http://www.example.com/en/1", "http://bad.org/", "http://sub.bad.org/", "http://com/",
]


def test_rules_and_listed_hosts(spark):
    docs = pages(spark, *URLS)
    listed = spark.createDataFrame([("bad.org",), ("bad.org",), ("not.in.corpus",), (None,)], "key string")
    full, names = urls.judged(docs, queries.URL_RULES, listed)
    assert set(docs.columns) < set(full.columns)
    got = {r.page_id: tuple(r[n] for n in names) for r in full.collect()}
    assert got == {i: plain(u, {"bad.org"}) for i, u in enumerate(URLS)}


@pytest.mark.parametrize("listed, others", [(0, 50), (1, 0), (40, 3000), (500, 500), (900, 10)])
def test_cascade_is_exact(spark, listed, others):
    rows = [(f"k{i}", i < listed) for i in range(listed + others)]
    universe = spark.createDataFrame(rows, "key string, listed boolean")
    levels = urls.cascade(universe)
    found = universe.select("listed", urls.is_listed(F.col("key"), levels).alias("got"))
    assert found.filter("listed <> got").count() == 0
    assert (len(levels) == 0) == (listed == 0)


def test_a_list_too_long_for_a_plan(spark, monkeypatch):
    docs = pages(spark, *URLS)
    want, names = urls.judged(docs, [], F.col("key").contains("bad"))
    monkeypatch.setattr(urls, "MOST_BYTES", 0)
    got, _ = urls.judged(docs, [], F.col("key").contains("bad"))
    assert got.columns == want.columns
    order = ["page_id", *names]
    assert got.select(order).orderBy("page_id").collect() == want.select(order).orderBy("page_id").collect()


@pytest.mark.parametrize("listed, others, part", [(0, 20, 8), (40, 1500, 8), (300, 20, 50), (60, 0, 1000)])
def test_cascades_of_parts_are_exact(spark, monkeypatch, listed, others, part):
    monkeypatch.setattr(urls, "PART_KEYS", part)
    rows = [(f"k{i}", i < listed) for i in range(listed + others)] + [(None, True)]
    universe = spark.createDataFrame(rows, "key string, listed boolean")
    filters, parts = urls.cascades(universe)
    assert parts == max(1, -(-listed // part))
    placed = universe.withColumn("part", urls._part(F.col("key"), parts)).join(filters, "part", "left")
    found = placed.select("key", "listed", urls.is_listed_in_part(F.col("key"), F.col("levels")).alias("got")).collect()
    assert len(found) == len(rows)
    assert [r for r in found if r.got != (r.listed and r.key is not None)] == []


def test_empty(spark):
    full, _ = urls.judged(pages(spark, "x").limit(0), queries.URL_RULES, F.lit(True))
    assert full.count() == 0


def test_query_and_sql(spark, small):
    found = queries.QUERIES["op10_bloom_cascade_urls"](spark, small)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
    assert compare(found, duck(small), queries.ORACLE_SQL["op10_bloom_cascade_urls"]) is None
