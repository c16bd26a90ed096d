import random
import re

from gridclear.llm.components import connected_components
from gridclear.llm.queries import URL_RULES
from gridclear.llm.url_filter import Rule, judge_urls

PAGES = "page_id long, url string, html string, host string, rule string, node string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "x", "x") for i, (u, h) in enumerate(rows)], PAGES)


def refresh(target):
    return f'<html><META http-equiv="Refresh" content="0; url={target}"></html>'


def canonical(target):
    return f"<head><link class=a rel='canonical' href='{target}'></head>"


def verdicts(spark, rows, rules=URL_RULES, edges=None):
    got = judge_urls(pages(spark, rows), rules, edges).collect()
    return [(r.host, r.path, r.rule, r.verdict, r.by) for r in sorted(got, key=lambda r: r.page_id)]


def test_parts_and_rules(spark):
    rows = [
        ("http://A.Example.NET/en/1?x=/de/#f", None), ("http://example.net/EN/1", ""), ("https://net", None), ("https://net/", None),
        ("http://internet/", None), ("http://x.example.com/de/a", None), ("http://x.example.com/de", None), ("x.org/fr/", None), (None, None),
        ("://WWW.ORG/fr/?q#", None), ("HTTP://É.org#a://b", None), ("http://a.net://x/", None), ("", ""), ("http://example.net/en/\n", None),
    ]
    got = verdicts(spark, rows)
    assert got == [
        ("a.example.net", "/en/1", "example.net/en/", "allow", "rule"), ("example.net", "/EN/1", "net/", "block", "rule"),
        ("net", "", None, "allow", "default"), ("net", "/", "net/", "block", "rule"), ("internet", "/", None, "allow", "default"),
        ("x.example.com", "/de/a", "example.com/de/", "block", "rule"), ("x.example.com", "/de", None, "allow", "default"),
        ("", "", None, "allow", "default"), ("", "", None, "allow", "default"), ("www.org", "/fr/", "org/fr/", "allow", "rule"),
        ("É.org", "", None, "allow", "default"), ("a.net:", "//x/", None, "allow", "default"), ("", "", None, "allow", "default"),
        ("example.net", "/en/\n", "example.net/en/", "allow", "rule"),
    ]


def test_aliases_get_decisions(spark):
    rows = [
        ("http://a.example.org/x", refresh("http://b.example.org/y")),
        ("http://b.example.org/y#top", canonical("http://bad.net/z")),  # blocked two links away
        ("http://c.example.org/x", refresh("//bad.net/q")),
        ("http://c.example.org/x", "also an alias of an allowed page"),
        ("http://good.example.net/en/1", canonical("http://c.example.org/x")),  # an allow wins over the block
        ("http://d.example.org/folder/x", canonical("other")),
        ("http://d.example.org/folder/other", refresh("/de/bad")),
        ("http://e.example.com", canonical("http://e.example.com/de/")),
        ("http://e.example.com/#x", None),  # the same address as the one before
        ("http://bad.net/z", refresh("http://c.example.org/x")),
        ("http://f.example.org/", refresh("http://f.example.org/?a=1&amp;b=2")),
    ]
    got = [(v, by) for *_, v, by in verdicts(spark, rows)]
    assert got == [
        ("allow", "alias"), ("allow", "alias"), ("allow", "alias"), ("allow", "alias"), ("allow", "rule"), ("allow", "default"),
        ("allow", "default"), ("block", "alias"), ("block", "alias"), ("block", "rule"), ("allow", "default"),
    ]
    without = [r for k, r in enumerate(rows) if k != 4]
    got = [(v, by) for *_, v, by in verdicts(spark, without)]
    assert got[:4] == [("block", "alias")] * 4


def test_edges_of_a_crawl_and_empty_inputs(spark):
    edges = spark.createDataFrame([(f"http://h.org/{k}", f"http://h.org/{k + 1}") for k in range(40)] + [(None, "http://h.org/1")], "a string, b string")
    rules = [Rule("block", "h.org", "/40"), Rule("allow", "h.org", "/40")]
    assert verdicts(spark, [("http://h.org/0", None)], rules[:1], edges) == [("h.org", "/0", None, "block", "alias")]
    assert verdicts(spark, [("http://h.org/0", None)], rules, edges) == [("h.org", "/0", None, "allow", "alias")]
    assert verdicts(spark, [("http://h.org/40", None)], []) == [("h.org", "/40", None, "allow", "default")]
    assert judge_urls(spark.createDataFrame([], PAGES), URL_RULES).count() == 0


def test_components_against_union_find(spark):
    rng = random.Random(1)
    for n, m in ((30, 20), (200, 150), (60, 59)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] if m != 59 else [(k, k + 1) for k in range(59)]
        parent = list(range(n))

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
        table = spark.createDataFrame([*edges, (None, 1), (2, None)], "a long, b long")
        got = dict(connected_components(table).collect())
        assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}


def test_patterns_read_links_in_either_order():
    from gridclear.llm.url_filter import CANONICAL, CANONICAL_LATER, REFRESH

    def find(pattern, html):
        found = re.search(pattern, html)
        return found and found[1]

    assert find(CANONICAL, '<link rel="canonical" href="http://a/b">') == "http://a/b"
    assert find(CANONICAL_LATER, '<LINK href=http://a/b rel=canonical>') == "http://a/b"
    assert find(CANONICAL, '<link rel="stylesheet" href="x.css"><a href="y">') is None
    assert find(REFRESH, "<meta http-equiv=refresh content='5;URL=http://a/b'>") == "http://a/b"
    assert find(REFRESH, "<meta name=x content='5;URL=http://a/b'>") is None
