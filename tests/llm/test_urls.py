import re

import pytest

import oracle
from talkloom.llm import q_urls, urls

PAGES = "page_id long, url string, host string, way int, label int"


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_rule(host, path, rules):
    best = (None, None)
    for verdict, rule in rules:
        of, start = rule.split("/", 1)
        if (host == of or host.endswith("." + of)) and path.startswith("/" + start) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return best


def rows(frame):
    assert frame.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_query_equals_sql(spark, size):
    folder = f"/root/testdata/{size}"
    got = oracle.spark_rows(q_urls.op12_urls(spark, folder))
    assert got == oracle.duck_rows(oracle.connect(folder), q_urls.OP12_SQL)


def paths(spark, rows):
    return spark.createDataFrame([(h, p, None, n, k, b) for h, p, n, k, b in rows], "host string, path string, ruled string, n long, known long, bad long")


def ways(spark, rows):
    return {(r["host"], r["path"]): r["way"] for r in urls.templates(paths(spark, rows)).collect()}


def test_variable_segments_become_wildcards(spark):
    many = [("a", f"/shop/item/{i}", 1, 0, 0) for i in range(100)] + [("a", f"/shop/{i}/x", 1, 0, 0) for i in range(4)] + [("a", "/shop/item", 5, 0, 0)]
    got = ways(spark, [*many, ("b", "/shop/item/1", 1, 0, 0), ("a", "/*", 50, 0, 0), ("a", "/shop/item/7/q/r/s", 60, 0, 0)])
    assert got["a", "/shop/item/3"] == "/shop/item/*" and got["a", "/shop/2/x"] == "/shop/*/x"
    assert got["a", "/shop/item"] == "/shop/item" and got["b", "/shop/item/1"] == "/*/*/*"
    assert got["a", "/*"] == "/***" and got["a", "/shop/item/7/q/r/s"] == "/shop/item/7/q/**"


def test_similar_branches_are_merged(spark):
    leaves = lambda name, n, bad, known=True: [("a", f"/{name}/{i}", 1, int(known), int(i < bad)) for i in range(n)]
    got = ways(spark, leaves("ads", 40, 40) + leaves("promo", 40, 39) + leaves("news", 40, 1) + leaves("blog", 40, 0) + leaves("new", 40, 0, known=False) + [("a", f"/deep/{i}/x", 1, 1, 0) for i in range(40)])
    assert got["a", "/ads/1"] == got["a", "/promo/1"] == "/ads/*"
    assert got["a", "/news/1"] == got["a", "/blog/1"] == "/blog/*"
    assert got["a", "/new/1"] == "/new/*" and got["a", "/deep/1/x"] == "/deep/*/x"


def test_rejection_by_labels(spark):
    pages = [(i, f"http://H.com/ads/{i}", "x", 0, 1 if i < 20 else None) for i in range(40)]
    pages += [(100 + i, f"http://h.com/news/{i}", "x", 0, 0 if i < 20 else None) for i in range(40)]
    pages += [(200 + i, f"http://h.com/else/{i}", "x", 0, None) for i in range(40)]
    got = {r[0]: r for r in rows(urls.judged(spark.createDataFrame(pages, PAGES), [("allow", "h.com/ads/7")], "label"))}
    assert {i for i, r in got.items() if r[4] == "block"} == set(range(40)) - {7}
    assert got[7] == (7, "h.com", "/ads/7", "h.com/ads/7", "allow")


def test_edges_and_rules(spark):
    assert rows(urls.judged(spark.createDataFrame([], PAGES), q_urls.RULES)) == []
    given = [None, "", "no scheme/en/", "://", "http://", "HTTP://WWW.Example.COM/en/x?q=/fr/", "http://example.com/en/", "http://a.example.com/en", "http://xnet/es/1"]
    given += ["http://a.net/es/1#/en/", "http://net/fr/", "http://É.NET?/es/", "http://a.com", "http://a.com/", "x://b://c.com/d", "http://a.com/" + "y/" * 5000, "http://a.net/fr/é\n/1"]
    given = given * 2 + ["http://long.org/" + "z" * 100_000, "http://a.org/***/*/**"]
    frame = spark.createDataFrame([(i, u, "x", 1, 1) for i, u in enumerate(given)] + [(None, "http://a.com/", "y", 2, None)], PAGES)
    got = rows(urls.judged(frame, q_urls.RULES))
    assert len(got) == len(given) + 1
    for page, host, path, rule, verdict in got:
        want = plain_url(given[page] if page is not None else "http://a.com/")
        assert (host, path) == want
        assert rule == plain_rule(*want, q_urls.RULES)[0] and verdict == (plain_rule(*want, q_urls.RULES)[1] or verdict) and verdict in ("allow", "block")
