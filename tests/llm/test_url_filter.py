import re

import __spark_entry__ as entry
import pytest

from noticeloom.llm.url_filter import SOFT, STRICT, automaton, judge_urls, weight_of


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        (None, "", "", None, "allow"),
        ("no scheme/casino", "", "", None, "block"),
        ("http://A.Example.ORG/es/1?q#f", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://example.org", "example.org", "", None, "allow"),
        ("http://x.com/de/casino", "x.com", "/de/casino", "com/de/", "block"),
        ("http://x.com/fr/casino", "x.com", "/fr/casino", "com/fr/", "allow"),
        ("http://x.net/casinos", "x.net", "/casinos", None, "allow"),
        ("http://x.net/a-CASINO_b", "x.net", "/a-CASINO_b", None, "block"),
        ("http://x.net/free-free", "x.net", "/free-free", None, "allow"),
        ("http://x.net/free?q=bonus", "x.net", "/free", None, "block"),
        ("a://b://c/d", "b:", "//c/d", None, "allow"),
        ("http://x.net/" + "a/" * 20000 + "casino", "x.net", "/" + "a/" * 20000 + "casino", None, "block"),
        ("", "", "", None, "allow"),
    ],
)
def test_urls(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "x", "y"), (1, url, "x", "y")], "page_id long, url string, host string, verdict string")
    assert [tuple(r)[:5] for r in judge_urls(pages).collect()] == [(1, host, path, rule, verdict)] * 2


def test_empty_table_and_no_vocabulary(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages).count() == 0
    assert judge_urls(spark.createDataFrame([(1, "http://x.net/casino")], pages.schema), rules=[], vocabulary={}).first()["verdict"] == "allow"


def test_automaton_counts_what_patterns_count():
    found = automaton({**dict.fromkeys(STRICT, 2), **dict.fromkeys(SOFT, 1)})
    for text in ("sexsexy-sex", "xxx.xxx", "free0win", "hot-hot.bet/loan/loans", "spam"):
        want = sum(w * bool(re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", text)) for ts, w in ((STRICT, 2), (SOFT, 1)) for t in ts)
        assert weight_of(text, found) == want, text


def test_query_is_registered():
    assert "op9_url_filter" in entry.queries()
