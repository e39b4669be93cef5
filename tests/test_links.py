"""Vetting and submission records."""

import json

import pytest
from pyspark.sql import functions as F

from linkloom.operators import links
from linkloom.operators.policy import DENIED_DOMAINS, DENIED_HOSTS, DENIED_SUFFIXES, DenyPolicy, policy_table

CASES = {
    "http://imgur.com/abc": "domain",
    "http://i.imgur.com/abc": "domain",
    "http://Imgur.com/abc": None,
    "http://notimgur.com/abc": None,
    "http://imgur.com.evil.org/": None,
    "https://video.google.com/x": "domain",
    "https://itunes.apple.com/us": "domain",
    "https://x.itunes.apple.com/us": None,
    "https://www.apple.com/us": None,
    "imgur.com/no-scheme": "domain",
    "http://user@imgur.com:80/": "domain",
    "http://site.org/a.PDF": "extension",
    "http://site.org/a.pdf?x=1": "extension",
    "http://site.org/a.pdf#p2": None,
    "http://x.ai": "extension",
    "http://site.org/x.tar.gz": "extension",
    "http://site.org/q?f=a.pdf": None,
    "http://site.org/pdf": None,
    "http://a.b": None,
    "http://a.": "length",
    "http://éé": "length",
}


def test_policy_sizes():
    assert (len(DENIED_DOMAINS) + len(DENIED_HOSTS), len(DENIED_SUFFIXES)) == (51, 65)


def test_reject_reasons(spark):
    df = spark.createDataFrame([(u,) for u in CASES], "url string")
    assert {r.url: r.reject_reason for r in links.vet_links(df).collect()} == CASES
    counts = {r.reject_reason: r.n_links for r in links.reject_reasons(links.vet_links(df)).collect()}
    assert counts["kept"] == sum(v is None for v in CASES.values())


@pytest.mark.parametrize("limit", [100_000, 5])
def test_policy_table_denies_like_the_filter(spark, monkeypatch, limit):
    monkeypatch.setattr(links, "BROADCAST_ROWS", limit)
    df = spark.createDataFrame([(u,) for u in CASES] * 3, "url string")
    want = sorted(r.url for r in links.deny_domains(df).collect())
    got = sorted(r.url for r in links.deny_domains(df, policy_table(spark)).collect())
    assert got == want


def test_suffix_without_a_dot(spark):
    df = spark.createDataFrame([("http://e.org/a/",), ("http://e.org/a",)], "url string")
    policy = DenyPolicy(domains=(), hosts=(), suffixes=("/", ".tar.gz"))
    assert [r.url for r in links.deny_extensions(df, policy).collect()] == ["http://e.org/a"]


GOOD = "http://site.org/page"
LINES = {
    json.dumps({"url": GOOD, "score": 3, "over_18": False}): "hit",
    json.dumps({"url": GOOD, "score": 2.5, "over_18": None}): "hit",
    "  " + json.dumps({"url": GOOD, "score": 3, "over_18": 0, "x": {"d": 1}}) + " ": "hit",
    json.dumps({"url": GOOD, "score": 2, "over_18": False}): "karma",
    json.dumps({"url": GOOD, "score": 2}): "karma",
    json.dumps({"url": GOOD, "score": 9, "over_18": True}): "adult",
    json.dumps({"url": GOOD, "score": 9, "over_18": "no"}): "adult",
    json.dumps({"url": GOOD, "score": 9, "over_18": ""}): "hit",
    json.dumps({"url": GOOD, "score": 9, "over_18": [1]}): "adult",
    json.dumps({"url": GOOD, "score": 9, "over_18": []}): "hit",
    json.dumps({"url": GOOD, "score": 9}): "bad_over_18",
    json.dumps({"url": GOOD, "score": "9", "over_18": False}): "bad_score",
    json.dumps({"url": GOOD, "over_18": False}): "bad_score",
    json.dumps({"url": GOOD, "score": None, "over_18": False}): "bad_score",
    json.dumps({"url": "http://imgur.com/x", "score": "9"}): "domain",
    json.dumps({"url": 123456789012, "score": 9, "over_18": False}): "bad_url",
    json.dumps({"score": 9, "over_18": False}): "bad_url",
    '{"url": "a", "url": "%s", "score": 5, "over_18": false, "d": {"k": 1, "k": 2}}' % GOOD: "hit",
    '{"url": "%s", "score": NaN, "over_18": false}' % GOOD: "karma",
    '{"url": "%s", "score": Infinity, "over_18": false}' % GOOD: "hit",
    '{"url": "%s"} trailing' % GOOD: "undecodable",
    '{"url": "%s"}{"url": "b"}' % GOOD: "undecodable",
    '{"url": "%s"}, {"url": "b"}' % GOOD: "undecodable",
    '{"url": "%s"}] [{"url": "b"}' % GOOD: "undecodable",
    '{"url": "%s", "score": 3, "over_18": false},{}] junk' % GOOD: "undecodable",
    '{"url": "%s", "score": 3, "over_18": false},{}]' % GOOD: "undecodable",
    '{"url": "%s", "score": 3, "over_18": false},{"x": 1}],[{}' % GOOD: "undecodable",
    "{'url': '%s'}" % GOOD: "undecodable",
    '{"url": "%s"' % GOOD: "undecodable",
    "": "undecodable",
    "5": "undecodable",
    "null": "undecodable",
    "[1]": "undecodable",
    '"text"': "undecodable",
}


def test_submission_lines(spark):
    df = spark.createDataFrame([("d", i, v) for i, v in enumerate(LINES)], "src_file string, line_no int, value string")
    parsed = links.parse_submissions(df).cache()
    assert {r.value: r.status for r in parsed.collect()} == LINES
    hits, rejects = links.split_rejects(parsed)
    assert {r.url for r in hits.collect()} == {GOOD}
    stats = links.submission_stats(parsed).collect()[0]
    n_hits = sum(v == "hit" for v in LINES.values())
    assert (stats.n_lines, stats.n_hits, stats.n_errors) == (len(LINES), n_hits, rejects.count())
    assert stats.percent_saved == int(100 * n_hits / len(LINES))


def test_bytes_that_are_no_utf8_are_undecodable(spark):
    line = F.concat(F.lit(b'{"url": "http://site.org/'), F.lit(b"\xff"), F.lit(b'", "score": 5, "over_18": false}'))
    df = spark.range(1).select(line.cast("string").alias("value"))
    assert links.parse_submissions(df).first().status == "undecodable"


def test_columns_keep_their_tests(spark):
    df = spark.createDataFrame([(2.5, None), (2.0, False), (3.0, True), (float("nan"), False)], "score double, over_18 boolean")
    assert [r.score for r in links.drop_over18(links.min_karma(df)).collect()] == [2.5]


def test_html_responses(spark):
    rows = [("a", 200, "text/html; charset=x"), ("b", 404, "text/html"), ("c", 200, None), ("d", 200, "image/png")]
    df = spark.createDataFrame(rows, "url string, status int, content_type string")
    assert [r.url for r in links.html_responses(df).collect()] == ["a"]


def test_index_links(spark):
    df = spark.createDataFrame([("./a",), ("./a",), ("b",)], "link string")
    assert [r.link for r in links.distinct_links(links.links_with_prefix(df)).collect()] == ["./a"]
