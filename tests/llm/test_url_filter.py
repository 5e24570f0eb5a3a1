from collections import Counter

import pytest
from conftest import SF

from hitledger.llm.queries import URL_RULES
from hitledger.llm.url_filter import Rule, Tree, judge


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    after = url[url.index("://") + 3:]
    end = min([after.index(c) for c in "/?#" if c in after], default=len(after))
    host, rest = after[:end], after[end:]
    stop = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:stop]


def rule_for(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.COM/de/x?y", "https://example.com", "ftp://x.net/", "http://net/a", "http://kernel.net",
    "http://notexample.com/de/1", "x://a.example.net/en/1#z", "x://a.example.net/EN/1", "http://q.org/fr/2?/de/", "http://ÄB.org/fr/", "a://b://c/d",
    "http://h.org?u=/fr/1", "http://example.com/de", "http://e.com/" + "a/" * 3000,
]


def check(pages, got):
    assert len(got) == len(pages)
    for r in got:
        host, path = parts(r.url)
        rule = rule_for(host, path, URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None)
        assert r.verdict == (rule.verdict if rule else r.verdict) and r.verdict in ("allow", "block")


def test_sample_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    check(pages.collect(), judge(pages, URL_RULES).collect())


def test_edges(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS + URLS[4:6])] + [(None, URLS[6], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, shape string")
    got = judge(pages, URL_RULES).collect()
    check(rows, got)
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    assert judge(pages.limit(0), URL_RULES).collect() == []


@pytest.fixture(scope="module")
def tree(spark):
    """One host: /spam/ pages are labelled blocked, /news/ allowed, /misc/ has no labels; rules cover a part of each."""
    urls = [f"http://h.com/spam/{i}.html" for i in range(100)] + [f"http://h.com/news/{i}" for i in range(100)]
    urls += [f"http://h.com/misc/{i}" for i in range(100)] + [f"http://h.com/user{i}/x" for i in range(30)]
    rules = [Rule("h.com", f"/spam/{i}", "block") for i in range(5, 10)] + [Rule("h.com", f"/news/{i}", "allow") for i in range(5, 10)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r.url: r for r in judge(pages, rules, Tree()).collect()}


def test_templates_reject_what_labels_say(tree):
    assert tree["http://h.com/spam/1.html"].verdict == "block" and tree["http://h.com/spam/1.html"].rule is None
    assert tree["http://h.com/news/1"].verdict == "allow" and tree["http://h.com/misc/1"].verdict == "allow"
    assert tree["http://h.com/spam/5.html"].rule == "h.com/spam/5"


def test_segments_that_vary_are_wildcards(tree):
    assert tree["http://h.com/user7/x"].template == "/*/*"
    assert tree["http://h.com/spam/1.html"].template.startswith("/spam/")
    assert tree["http://h.com/misc/1"].template == "/*/*"


def test_similar_branches_merge(spark):
    urls = [f"http://h.com/{s}/{i}" for s in ("aa", "bb", "cc") for i in range(40)]
    rules = [Rule("h.com", f"/{s}/{i}", "block") for s in ("aa", "bb") for i in range(2, 8)] + [Rule("h.com", "/cc/1", "allow")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.url: r.template for r in judge(pages, rules).collect()}
    assert got["http://h.com/aa/1"] == got["http://h.com/bb/1"] == "/*+/*" and got["http://h.com/cc/9"] == "/cc/*"


@pytest.mark.parametrize("labelled", [5, 10, 15, 19, 20, 40])
def test_few_blocked_pages_do_not_judge_unlabelled_siblings(spark, labelled):
    urls = [f"http://h.example.com/de/{i}" for i in range(labelled)] + [f"http://h.example.com/{s}/{i}" for s in ("en", "es", "fr") for i in range(6)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = judge(pages, [Rule("example.com", "/de/", "block")]).collect()
    assert {(r.path.startswith("/de/"), r.verdict) for r in got} == {(True, "block"), (False, "allow")}


def test_stays_in_the_engine(spark):
    plan = judge(spark.read.parquet(f"{SF}/pages.parquet"), URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
