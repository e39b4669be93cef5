"""Hosts split by suffix rules, against a plain model."""

import random
import re

import pytest
from pyspark.sql import functions as F

from linkloom.operators.hosts import with_host_parts

RULES = [
    "com", "uk", "co.uk", "*.ck", "!www.ck", "// a comment", "", None, "jp", "kobe.jp", "*.kobe.jp",
    "!city.kobe.jp", "a.b.c.d  trailing words", "CO.uk", "co.uk",
]


def model(host, rules):
    """Longest rule by trying every tail; exceptions first."""
    words = host.split(".")
    if re.fullmatch(r"\d+(\.\d+){3}", host) and all(int(w) < 256 for w in words):
        return "", host, "", "", host
    best, exempt = 0, None
    for k in range(1, len(words) + 1):
        tail = ".".join(words[-k:]).lower()
        if "!" + tail in rules:
            exempt = k - 1
        if tail in rules or "*." + ".".join(words[len(words) - k + 1 :]).lower() in rules and k > 1:
            best = k
    size = best if exempt is None else exempt
    front, suffix = words[: len(words) - size], ".".join(words[len(words) - size :])
    domain = front[-1] if front else ""
    joined = f"{domain}.{suffix}" if domain and suffix else ""
    return ".".join(front[:-1]), domain, suffix, joined, host


@pytest.mark.parametrize("limit", [None, 0])
def test_parts_match_the_model(spark, limit):
    rng = random.Random(5)
    words = ["a", "b", "c", "d", "www", "co", "uk", "UK", "ck", "jp", "kobe", "city", "com", "x"]
    hosts = {".".join(rng.choices(words, k=rng.randint(1, 5))) for _ in range(600)}
    hosts |= {"10.0.0.1", "10.0.0.256", "1.2.3", "localhost", "a..com", "www.ck", "x.www.ck", "ck", "city.kobe.jp"}
    urls = [f"http://u@{h}:80/p?x=co.uk" for h in sorted(hosts)] + [None, "http://x.com"] + ["http://x.co.uk"] * 50
    df = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "url string, depth int").repartition(3)
    rules = spark.createDataFrame([(r,) for r in RULES], "rule string")
    got = with_host_parts(df, rules, broadcast_rows=limit)
    assert got.columns == ["url", "depth", "host_parts"]
    rows = got.collect()
    plain = {r.split()[0].lower() for r in RULES if r and not r.startswith("//")}
    assert sorted(r.depth for r in rows) == list(range(len(urls)))
    for row in rows:
        if row.url is None:
            assert row.host_parts is None
        else:
            host = re.sub(r"^http://(u@)?", "", row.url).split(":")[0]
            assert tuple(row.host_parts) == model(host, plain), row.url


def test_no_rules_and_no_rows(spark):
    rules = spark.createDataFrame([], "rule string")
    df = spark.createDataFrame([("http://a.b.com/",)], "url string")
    for limit in (None, -1):
        assert tuple(with_host_parts(df, rules, broadcast_rows=limit).first().host_parts) == (
            "a.b", "com", "", "", "a.b.com"
        )
        assert with_host_parts(df.limit(0), rules, broadcast_rows=limit).collect() == []


def test_small_lists_shuffle_no_urls(spark):
    rules = spark.createDataFrame([("com",), ("co.uk",)], "rule string")
    df = spark.range(10).select(F.concat(F.lit("http://a.com/"), "id").alias("url"))
    plan = with_host_parts(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
