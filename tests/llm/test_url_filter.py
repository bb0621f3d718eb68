from __future__ import annotations

import re

import pytest
from llm_helpers import clashing  # noqa: F401
from pyspark.sql import functions as F

from tickloom.llm.queries import URL_RULES
from tickloom.llm.url_filter import (
    Rule,
    TreeSettings,
    filter_urls,
    host_and_path,
    paths_of_hosts,
    template_verdicts,
)


URLS = [
    "http://A.Example.ORG/es/1?x",
    "http://a.example.org/es",
    "https://example.org/en/12#top",
    "http://notexample.org/en/12",
    "http://x.com/de/3",
    "http://x.com/fr/3",
    "http://com/fr/",
    "http://xcom/fr/",
    "ftp://x.net",
    "http://?q=://b.org/",
    "http://a.org?/es/",
    "a://b.org/x://c.com/de/",
    "no scheme",
    "",
    None,
    "http://ünï.org/es/" + "x/" * 3_000,
    "http://h.net\n.org/es/",
]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def fitting(host, path, rules):
    fits = [
        r
        for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.text), default=None)


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    return clashing(df.withColumn("html", F.lit(None).cast("string")))


def test_hosts_and_paths(pages):
    host, path = host_and_path(F.col("url"))
    got = {r[0]: (r[1], r[2]) for r in pages.select("page_id", host, path).collect()}
    assert got == {i: plain(u) for i, u in enumerate(URLS)}


def test_rules_decide_first(pages):
    for r in filter_urls(pages, URL_RULES).collect():
        rule = fitting(*plain(URLS[r["id"]]), URL_RULES)
        assert r["rule"] == (rule.text if rule else None)
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")


def table(spark, rows):
    return spark.createDataFrame(rows, "host string, path string, label int")


def test_variable_segments_become_wildcards(spark):
    rows = [("h", f"/user/name{chr(97 + i)}/posts/{i}", None) for i in range(26)]
    rows += [("h", "/about", None)] * 30 + [("h", "/0123abcdef/x", None)]
    paths = paths_of_hosts(table(spark, rows), TreeSettings()).collect()
    assert {p["template"] for p in paths} == {"/user/{*}/posts/{n}", "/about", "/{h}/x"}


def test_pure_templates_are_blocked_and_like_ones_merged(spark):
    rows = [("h", f"/spam/{i}", 1) for i in range(40)] + [("h", f"/news/{i}", 0) for i in range(40)]
    rows += [("h", "/spam/77", None), ("h", "/other/1", None)]
    settings = TreeSettings()
    found = template_verdicts(paths_of_hosts(table(spark, rows), settings), settings).collect()
    verdicts = {r["template"]: r["method"] for r in found}
    assert verdicts["/spam/{n}"] == "block" and verdicts["/news/{n}"] == "allow"
    branches = {r["template"]: r["branch"] for r in found}
    assert branches["/other/{n}"].endswith("{merged}")  # nothing sets it apart


def test_deep_paths_end_in_one_tail(spark):
    paths = paths_of_hosts(table(spark, [("h", "/a" * 500, None)]), TreeSettings(levels=3))
    assert [p["template"] for p in paths.collect()] == ["/a/a/a/{tail}"]


def test_longest_rule_wins_and_no_labels_allow(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c/d"), (1, "http://a.b/c/d")], "page_id long, url string")
    rules = [Rule("b", "/", "block"), Rule("a.b", "/c", "allow")]
    assert [(r["rule"], r["verdict"]) for r in filter_urls(pages, rules).collect()] == [("a.b/c", "allow")] * 2
    assert {r["verdict"] for r in filter_urls(pages, []).collect()} == {"allow"}


def test_empty_table(pages):
    assert filter_urls(pages.limit(0), URL_RULES).collect() == []
