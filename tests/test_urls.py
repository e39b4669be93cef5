"""URL functions against the standard library."""

import html
import random
from urllib.parse import parse_qsl, unquote_plus, urlparse

import pytest
from pyspark.sql import functions as F

from linkloom.functions import urls as U
from linkloom.operators import dedup

EDGES = [
    "http://example.com/a?x=1&y=2", "http://example.com/a?y=2&x=1", "http://example.com/a?x=1&x=1&y=2",
    "http://example.com/a?x=1&y=2&z=", "http://example.com/a?x=1&amp;y=2", "HTTP://example.com/a?x=1&y=2",
    "https://example.com/a?x=1&y=2", "http://example.com/a?x=1&y=2#f", "http://example.com/a;p?x=1&y=2",
    "http://Example.com/a?x=1&y=2", "http://e.com/a%20b", "http://e.com/a+b", "http://e.com/a b",
    "http://e.com/%zz%41", "http://e.com/%41%zz", "http://e.com/%", "http://e.com/%E9", "http://e.com/%C3%A9",
    "http://e.com/é", "http://u:p@e.com:80/x", "relative/path", "", "//e.com/x", "http://e.com", "http:",
    "http://e.com/{a b}", "mailto:a@b.c;p", "http://e.com/a;b/c;d;e", "http://e.com/a;b/c", "http://e.com/;",
    "http://e.com/x?=v&k", "http://e.com/x?a==b", "http://e.com/x?a=%26b", "http://e.com/x?q#?z", "1http://e.com",
    "http://e.com/x?&section=2", "http://e.com/x?a=1;b=2", "http://e.com/?a=+b", " http://e.com/a\tb",
    "http://e.com/x#a#b", "x:y:z", ":x", "http://e.com/a b", "http://e.com//", "http:///p", "ftp://e.com/a;type=i",
]
BAD = ["http://[::1/", "http://::1]/", "http://a℀b.com/", "http://e.com／x/"]


def model(url):
    """Six parts as the standard library sees them, with decoded path and query set."""
    p = urlparse(url)
    return (p.scheme, p.netloc, unquote_plus(p.path), p.params, frozenset(parse_qsl(p.query)), p.fragment)


def random_urls(n):
    rng = random.Random(7)
    bits = ["http", "https", ":", "//", "/", "?", "#", "&", "=", ";", "+", "%20", "%4", "%C3%A9", "a", "B", "é", "x.y", "@", "1", "-"]
    return ["".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(n)]


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, url string")


def test_parts_match_the_standard_library(spark):
    values = EDGES + random_urls(1500)
    p = F.col("parts")
    df = U.with_url_parts(frame(spark, values)).select(
        "i", "parts", U.decode_path(p["path"]).alias("path"), U.canonical_query(p["query"]).alias("pairs")
    )
    for row in df.collect():
        got = row.parts
        want = model(values[row.i])
        pairs = [tuple(x) for x in row.pairs]
        assert len(pairs) == len(set(pairs))
        assert (got.scheme, got.netloc, row.path, got.params, frozenset(pairs), got.fragment) == want, values[row.i]


def test_unparsable_urls_are_rejected_with_a_reason(spark):
    good, bad = dedup.split_unparsable(frame(spark, BAD + ["http://[::1]/", "http://e.com/[x", "x"]))
    assert sorted(r.url for r in good.collect()) == ["http://[::1]/", "http://e.com/[x", "x"]
    assert {(r.url, r.reason) for r in bad.collect()} == {(u, "unparsable") for u in BAD}
    for url in BAD:
        with pytest.raises(ValueError):
            urlparse(url)


@pytest.mark.parametrize("partitions", [1, 5])
def test_dedup_keeps_the_first_of_equal_urls(spark, partitions):
    values = EDGES + random_urls(400) + EDGES
    rows = [(2016, 1 + i % 3, "f", i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "year int, month int, file string, uid bigint, url string")
    kept = dedup.dedupe_urls(df.repartition(partitions)).collect()
    seen = {}
    for year, month, file, uid, url in sorted(rows):
        plain = html.unescape(url)
        seen.setdefault(model(plain), (month, uid, plain))
    assert sorted((r.month, r.uid, r.url) for r in kept) == sorted(seen.values())
    again = dedup.dedupe_urls(spark.createDataFrame(kept, df.schema))
    assert again.count() == len(kept)


def test_host_path_mode_merges_what_full_mode_keeps(spark):
    values = ["http://e.com/a?x=1", "https://e.com/a#f", "http://e.com/b"]
    rows = [(2016, 1, "f", i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "year int, month int, file string, uid bigint, url string")
    assert dedup.dedupe_urls(df, "full").count() == 3
    assert sorted(r.uid for r in dedup.dedupe_urls(df, "host_path").collect()) == [0, 2]


def test_hosts(spark):
    cases = {
        "http://a.b.com/x": "a.b.com", "https://u:p@b.com:80?x": "b.com", "b.com/x": "b.com",
        "//c.com#f": "c.com", "http://d.com./": "d.com", "HTTP://D.com": "D.com", "ftp://e.com": "e.com",
    }
    df = frame(spark, list(cases)).select("url", U.url_host(F.col("url")).alias("h"), U.host_suffixes(U.url_host(F.col("url"))).alias("s"))
    for row in df.collect():
        assert row.h == cases[row.url]
        labels = row.h.split(".")
        assert row.s == [".".join(labels[i:]) for i in range(len(labels))]
